from types import SimpleNamespace

import pytest

from turnout.session import SESSION_CONF, job_session, shared_folder


def session_of(master, folder):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: folder),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_lies_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one.startswith(f"{base}/x-") and one != two


def test_a_cluster_must_name_its_shared_folder():
    assert shared_folder(session_of("yarn", "hdfs:///tmp"), "x").startswith("hdfs:///tmp/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session_of("yarn", None), "x")


def test_a_local_session_may_go_without():
    assert "turnout-" in shared_folder(session_of("local[2]", None), "x")


def test_job_session_reads_text_as_utc(spark):
    session = job_session("any")
    assert {name: session.conf.get(name) for name in SESSION_CONF} == SESSION_CONF
