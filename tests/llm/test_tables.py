import random
from itertools import cycle

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnout.llm import decontaminate, line_dedup, quality
from turnout.llm.decontaminate import contamination
from turnout.llm.jaccard_join import one_of_each
from turnout.llm.line_dedup import dedup_lines
from turnout.llm.substring_dedup import dedup_substrings
from turnout.llm.tables import ROW, bucketed, file_place, numbered, row_numbers, stored

SPLITS = "spark.sql.files.minPartitionNum"


@pytest.fixture
def split(spark):
    """Sets into how many splits scans are cut from now on."""
    yield lambda n: spark.conf.set(SPLITS, n)
    spark.conf.unset(SPLITS)


def written(spark, tmp_path, rows, files=2):
    """The rows in files of many row groups, which can be split."""
    path = str(tmp_path / "docs")
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(files)
    frame.write.option("parquet.block.size", 1 << 12).parquet(path)
    return spark.read.parquet(path)


def texts(n, words=60):
    rng = random.Random(3)
    return [" ".join(str(rng.randrange(10**6)) for _ in range(words)) for _ in range(n)]


@pytest.fixture(autouse=True)
def small_splits(spark):
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_numbers_do_not_depend_on_splits(spark, tmp_path, split):
    docs = written(spark, tmp_path, list(enumerate(texts(2000))))
    for frame in (docs, docs.filter("doc_id % 3 = 0").select("text", "doc_id")):
        found = []
        for n in (1, 40):
            split(n)
            rows = numbered(frame, "text", id="doc_id")
            assert n == 1 or rows.rdd.getNumPartitions() > 8
            found.append({r["_row"]: r.id for r in rows.collect()})
        assert found[0] == found[1] and len(found[0]) == frame.count()


def test_frames_of_repeated_file_rows_are_written(spark, tmp_path):
    docs = written(spark, tmp_path, [(1, "a"), (2, "b")])
    for frame in (docs.select(F.explode(F.array("text", "text")).alias("text")), docs.unionAll(docs), spark.read.parquet(*docs.inputFiles() * 2)):
        assert file_place(frame) is None
        rows = row_numbers(frame, F.col("text"))
        assert rows.select("_row").distinct().count() == 4
    assert row_numbers(docs.filter("false"), F.col("text")).count() == 0


def test_frames_of_many_files_are_written(spark, tmp_path):
    docs = written(spark, tmp_path, list(enumerate(texts(50))), files=3)
    assert docs.inputFiles() and len(docs.inputFiles()) == 3
    for most, names in ((3, True), (2, False)):
        rows = row_numbers(docs, F.col("doc_id"), most_files=most)
        assert ("docs" in str(rows.inputFiles())) == names
        found = rows.collect()
        assert len({r["_row"] for r in found}) == 50 and {r.doc_id for r in found} == set(range(50))
        assert sorted(map(tuple, found)) == sorted(map(tuple, rows.collect()))


def test_line_dedup_with_other_splits(spark, tmp_path, split, monkeypatch):
    rows = [(i, t.replace(" ", "\n")) for i, t in enumerate(texts(1000))]
    rows += [(i + 1000, rows[i][1] + "\nlast") for i in range(0, 1000, 7)]
    docs = written(spark, tmp_path, rows)
    marked = line_dedup.later_windows
    monkeypatch.setattr(line_dedup, "later_windows", lambda w: stored(marked(w), "later"))
    split(1)
    found = dedup_lines(docs)
    split(40)
    got = {r.doc_id: r.text for r in found.select("doc.doc_id", "doc.text").collect()}
    assert got == {i: t if i < 1000 else "last" for i, t in rows}


def test_substring_dedup_with_other_splits(spark, tmp_path, split):
    rows = list(enumerate(texts(1000)))
    rows += [(i + 1000, f"{rows[i][1]} last") for i in range(0, 1000, 7)]
    docs = written(spark, tmp_path, rows)
    split(1)
    found = dedup_substrings(docs)
    split(40)
    got = {r.doc_id: r.kept for r in found.collect()}
    assert got == {i: "last" if i >= 1000 else "" if i % 7 == 0 else t for i, t in rows}


def test_jaccard_with_other_splits(spark, tmp_path, split):
    rows = list(enumerate(texts(1000)))
    rows += [(i + 1000, f"{rows[i][1]} last") for i in range(0, 1000, 7)]
    docs = written(spark, tmp_path, rows)
    split(1)
    found = one_of_each(docs)
    split(40)
    assert sorted(r.doc_id for r in found.collect()) == list(range(1000))


def test_decontaminate_with_other_splits(spark, tmp_path, split, monkeypatch):
    rows = list(enumerate(texts(1000)))
    docs = written(spark, tmp_path, rows)
    items = [(str(i), rows[i][1]) for i in range(0, 1000, 50)]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    search, splits = decontaminate.search_block, cycle((1, 40))

    def search_otherwise(rows, block):
        split(next(splits))
        return stored(search(rows, block), "found")

    monkeypatch.setattr(decontaminate, "search_block", search_otherwise)
    found = contamination(docs, benchmark, most=5000)
    got = {r.doc_id: r["items"] for r in found.select("doc.doc_id", "items").collect()}
    assert got == {i: [str(i)] if i % 50 == 0 else [] for i, _ in rows}


def test_columns_with_dots_and_quotes_stay(spark, tmp_path):
    """The operators that carry whole rows take any column names."""
    words = " ".join(f"w{i}" for i in range(30))
    frame = spark.createDataFrame([(1, words, 7, 8), (2, words, 9, 0)], "doc_id long, text string, x int, y int")
    docs = frame.withColumnsRenamed({"x": "a.b", "y": "c`d"})
    items = spark.createDataFrame([(1, words)], "item_id long, text string")
    weights = quality.train([b"good words", b"bad"], np.array([1, 0]))
    for found in (
        dedup_lines(docs), contamination(docs, items), contamination(docs, items, most=1),
        quality.score_quality(docs, weights),
    ):
        rows = found.select("doc.*").collect()
        assert sorted(r["a.b"] for r in rows) == [7, 9] and rows[0].__fields__ == docs.columns
    assert [r["c`d"] for r in one_of_each(docs).collect()] == [8]


def test_buckets_leave_no_table(spark):
    rows = bucketed(spark.range(100).withColumnRenamed("id", ROW), ROW)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("buckets_")]
    assert rows.join(rows.withColumn("n", F.lit(1)), ROW).count() == 100
    assert "Exchange" not in rows.groupBy(ROW).count()._jdf.queryExecution().executedPlan().toString()
