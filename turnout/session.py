"""The Spark session and the shared folder of a job."""

import tempfile
from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import SparkSession

# Text is UTC throughout; small shuffle partitions are merged, skewed ones split.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def job_session(app_name: str, conf: Mapping[str, str] | None = None) -> SparkSession:
    """The session of a job; master, memory and connector packages come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name that all executors can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session may go without that
    setting; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="turnout-")
    return f"{base}/{purpose}-{uuid4().hex}"
