import os
import random
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import brute
import checks.queries as checked
from turnout.functions.schema import COUNT_TABLE_DDL, DETAIL_COLUMNS, KEYS
from turnout.operators.newest import newest_batch
from turnout.plans.messages import counts_of, detail_of
from turnout.sources.messages import feed_lines, file_messages
from turnout.sources.results import (
    catalog_newest_batch,
    count_table,
    detail_table,
    marked_newest_batch,
)
from turnout.sources.state import state_counts, state_partitions
from turnout.streaming.progress import ProgressLog, progress_table
from turnout.streaming.queries import (
    await_all,
    await_batch,
    session_conf,
    start_console,
    start_counts,
    start_detail,
    start_split_detail,
)
from turnout.streaming.sinks import catalog_sink, console_sink, fan_out, table_sink


class Feed:
    """A folder where text files land one after the other."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, folder / "feed", 0
        self.folder.mkdir()

    def land(self, texts):
        path = self.folder / f"{self.files:04}.txt"
        path.write_text("".join(text + "\n" for text in texts))
        os.utime(path, (1_700_000_000 + self.files,) * 2)
        self.files += 1

    def stream(self, **options):
        return feed_lines(self.spark, str(self.folder), **options)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def rows(frame):
    return {tuple(row) for row in frame.select(*KEYS, "response_count", "batch_id").collect()}


def random_batches(seed, batches=4, size=400):
    rng = random.Random(seed)
    return [
        [
            brute.message(
                rng.choice(["hot", "hot", f"g{rng.randrange(60)}", None]),
                rng.choice(["yes", "no", "waitlist", None]),
                group_city=rng.choice(["x", None]),
            )
            for _ in range(size)
        ]
        for _ in range(batches)
    ]


def test_one_file_per_trigger_gives_the_changelog(spark, feed, tmp_path):
    batches = random_batches(1)
    for texts in batches:
        feed.land(texts)
    path = str(tmp_path / "counts")
    raw = feed.stream(maxFilesPerTrigger=1)
    await_all([start_counts(raw, [table_sink(path)], str(tmp_path / "cp"), interval=None)])
    table = count_table(spark, path)
    assert rows(table) == brute.changelog(batches)
    assert {r[-1] for r in rows(newest_batch(table))} == {3}


@pytest.mark.parametrize("cuts", [(), (1, 2, 700)])
def test_last_totals_do_not_depend_on_the_batches(spark, feed, tmp_path, cuts):
    texts = [text for batch in random_batches(7, batches=2) for text in batch]
    for start, end in zip((0, *cuts), (*cuts, len(texts))):
        feed.land(texts[start:end])
    path = str(tmp_path / "counts")
    raw = feed.stream(maxFilesPerTrigger=1)
    await_all([start_counts(raw, [table_sink(path)], str(tmp_path / "cp"), interval=None)])
    last = {}
    for *key, total, batch_id in sorted(rows(count_table(spark, path)), key=lambda r: r[-1]):
        last[tuple(key)] = total
    assert last == brute.counts(texts)


def test_restart_goes_on_with_totals_and_ids(spark, feed, tmp_path):
    batches = random_batches(2, batches=3)
    path, checkpoint = str(tmp_path / "counts"), str(tmp_path / "cp")
    for texts in batches:
        feed.land(texts)
        for _ in range(2):  # the second run finds nothing new
            await_all(
                [start_counts(feed.stream(), [table_sink(path)], checkpoint, interval=None)]
            )
    assert rows(count_table(spark, path)) == brute.changelog(batches)


def test_batch_that_fails_half_way_is_not_counted_twice(spark, feed, tmp_path):
    batches = random_batches(3, batches=2)
    one, two, checkpoint = (str(tmp_path / name) for name in ("one", "two", "cp"))
    broken = []

    def fail_once(batch, batch_id):
        if batch_id == 1 and not broken:
            broken.append(batch_id)
            raise RuntimeError("sink is away")

    sinks = [table_sink(one), fail_once, table_sink(two)]
    feed.land(batches[0])
    feed.land(batches[1])
    with pytest.raises(StreamingQueryException, match="sink is away"):
        raw = feed.stream(maxFilesPerTrigger=1)
        await_all([start_counts(raw, sinks, checkpoint, interval=None)])
    assert {r[-1] for r in rows(count_table(spark, two))} == {0}
    raw = feed.stream(maxFilesPerTrigger=1)
    await_all([start_counts(raw, sinks, checkpoint, interval=None)])
    assert broken == [1]
    for path in (one, two):
        found = count_table(spark, path)
        assert rows(found) == brute.changelog(batches)
        assert found.count() == len(brute.changelog(batches))


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "counts")
    frame = spark.createDataFrame(
        [("a", "us", None, "c", "1", "2", "yes", n, 0) for n in range(9)], COUNT_TABLE_DDL
    ).drop("batch_id")
    sink = table_sink(path)
    for batch_id in (0, 1, 1, 0, 1):
        sink(frame.repartition(3 + batch_id), batch_id)
    counts = count_table(spark, path).groupBy("batch_id").count().collect()
    assert {tuple(r) for r in counts} == {(0, 9), (1, 9)}


def test_detail_rows_keep_topics_and_bad_messages(spark, feed, tmp_path):
    good = (
        '{"rsvp_id":1,"response":"yes","venue":null,"group":{"group_name":"g","group_topics":'
        '[{"urlkey":"a","topic_name":"A"},{"urlkey":"b","topic_name":"B"}]}}'
    )
    feed.land([good, "broken"])
    feed.land([good])
    path = str(tmp_path / "detail")
    raw = feed.stream(maxFilesPerTrigger=1)
    await_all([start_detail(raw, [table_sink(path)], str(tmp_path / "cp"), interval=None)])
    table = detail_table(spark, path)
    assert table.columns == [*DETAIL_COLUMNS, "batch_id"]
    found = sorted(table.collect(), key=lambda r: (r.batch_id, r.group_name or ""))
    assert [(r.batch_id, r.group_name) for r in found] == [(0, None), (0, "g"), (1, "g")]
    assert [tuple(t) for t in found[1].group_topics] == [("a", "A"), ("b", "B")]
    assert all(value is None for value in found[0][:-1])


def test_even_files(spark, feed, tmp_path):
    texts = [brute.message(f"g{i}") for i in range(40)]
    for text in texts:
        feed.land([text])
    tables = {False: tmp_path / "as-read", True: tmp_path / "even"}
    with session_conf(spark, {"spark.sql.files.openCostInBytes": str(128 << 20)}):
        for even, path in tables.items():
            sink = table_sink(str(path), even_files=even)
            await_all([start_detail(feed.stream(), [sink], f"{path}-cp", interval=None)])
            names = {r.group_name for r in detail_table(spark, str(path)).collect()}
            assert names == {f"g{i}" for i in range(40)}
    files = {even: len(list(path.glob("*/*.parquet"))) for even, path in tables.items()}
    assert files[False] == 40 and files[True] < 10


def test_detail_as_json_documents(spark, feed, tmp_path):
    feed.land([brute.message("g", "yes", group_topics=[{"urlkey": "a", "topic_name": "A"}])])
    path = str(tmp_path / "documents")
    sinks = [table_sink(path, "json"), console_sink()]
    await_all([start_detail(feed.stream(), sinks, str(tmp_path / "cp"), interval=None)])
    found = detail_table(spark, path, "json").collect()
    assert [(r.group_name, r.group_topics[0].urlkey, r.batch_id) for r in found] == [("g", "a", 0)]


def test_console_within_a_fan_out_prints_whole_values(spark, feed, tmp_path, capfd):
    name = "n" * 60
    feed.land([brute.message(name, "yes")] + [brute.message(f"g{i}") for i in range(300)])
    path = str(tmp_path / "counts")
    sinks = [console_sink(rows=1000), table_sink(path)]
    await_all([start_counts(feed.stream(), sinks, str(tmp_path / "cp"), interval=None)])
    out = capfd.readouterr().out
    assert "Batch: 0" in out and name in out
    assert count_table(spark, path).count() == 301


@pytest.mark.parametrize("rows_of,groups", [(counts_of, 2), (detail_of, None)])
def test_console_as_its_own_query(feed, tmp_path, rows_of, groups):
    feed.land([brute.message("a", "yes")] * 3 + [brute.message("b", "no")])
    query = start_console(rows_of(feed.stream()), str(tmp_path / "cp"), interval=None)
    await_all([query])
    progress = query.lastProgress
    assert "ConsoleTable" in progress.sink.description and progress.numInputRows == 4
    assert [s.numRowsUpdated for s in progress.stateOperators] == ([groups] if groups else [])


def test_small_batches_leave_few_files(spark, feed, tmp_path):
    feed.land([brute.message(f"g{i}") for i in range(500)])
    few, many = tmp_path / "few", tmp_path / "many"
    for folder, size in ((few, 1_000_000), (many, 100)):
        await_all(
            [
                start_counts(
                    feed.stream(),
                    [table_sink(str(folder))],
                    f"{folder}-cp",
                    interval=None,
                    rows_per_task=size,
                )
            ]
        )
        assert count_table(spark, str(folder)).count() == 500
    assert len(list(few.glob("batch_id=0/*.parquet"))) == 1
    assert len(list(many.glob("batch_id=0/*.parquet"))) == 5


def test_catalog_table(spark, feed, tmp_path):
    batches = random_batches(4, batches=12, size=40)
    for texts in batches:
        feed.land(texts)
    table = "counts_in_catalog"
    sink = catalog_sink(table, COUNT_TABLE_DDL)
    raw = feed.stream(maxFilesPerTrigger=1)
    await_all([start_counts(raw, [sink], str(tmp_path / "cp"), interval=None)])
    assert rows(spark.table(table)) == brute.changelog(batches)
    newest = catalog_newest_batch(spark, table)
    # 11 is newer than 9, though "9" is the larger text.
    assert rows(newest) == {r for r in brute.changelog(batches) if r[-1] == 11}
    assert rows(newest) == rows(newest_batch(spark.table(table)))


def test_marked_table_reads_one_folder(spark, feed, tmp_path):
    batches = random_batches(6, batches=11, size=30)
    path, checkpoint = tmp_path / "counts", str(tmp_path / "cp")
    for number, texts in enumerate(batches):
        feed.land(texts)
        if number in (0, 10):
            raw = feed.stream(maxFilesPerTrigger=1)
            sink = table_sink(str(path), mark_newest=True)
            await_all([start_counts(raw, [sink], checkpoint, interval=None)])
            newest = marked_newest_batch(spark, str(path))
            expected = {r for r in brute.changelog(batches) if r[-1] == number}
            assert rows(newest) == expected
            assert all(f"batch_id={number}/" in name for name in newest.inputFiles())
    # The notes are not rows of the table.
    assert rows(count_table(spark, str(path))) == brute.changelog(batches)
    assert sorted(p.name for p in (path / "_newest").iterdir()) == ["place=0", "place=1"]
    # While one note is being replaced, the other one counts.
    for note in (path / "_newest" / "place=0").iterdir():
        note.unlink()
    assert {r[-1] for r in rows(marked_newest_batch(spark, str(path)))} == {9}


def test_batch_replayed_after_its_note(spark, tmp_path):
    frame = spark.createDataFrame(
        [("a", "us", None, "c", "1", "2", "yes", n, 0) for n in range(9)], COUNT_TABLE_DDL
    ).drop("batch_id")
    sink = table_sink(str(tmp_path / "counts"), mark_newest=True)
    for batch_id in (0, 1, 2, 2):
        sink(frame, batch_id)
    newest = marked_newest_batch(spark, str(tmp_path / "counts"))
    assert newest.count() == 9 and newest.first().batch_id == 2


def test_empty_batch_is_not_the_newest(spark, feed, tmp_path):
    feed.land([brute.message("a", "yes")])
    feed.land([])
    table, path = "counts_with_empty_batch", str(tmp_path / "counts")
    sinks = [catalog_sink(table, COUNT_TABLE_DDL), table_sink(path)]
    query = start_counts(
        feed.stream(maxFilesPerTrigger=1), sinks, str(tmp_path / "cp"), interval=None
    )
    await_all([query])
    assert query.lastProgress.batchId == 1
    for newest in (catalog_newest_batch(spark, table), newest_batch(count_table(spark, path))):
        assert [(r.group_name, r.batch_id) for r in newest.collect()] == [("a", 0)]


def test_a_batch_replayed_into_the_catalog_replaces_itself(spark):
    frame = spark.createDataFrame(
        [("a", "us", None, "c", "1", "2", "yes", n, 0) for n in range(9)], COUNT_TABLE_DDL
    ).drop("batch_id")
    sink = catalog_sink("replayed", COUNT_TABLE_DDL)
    for batch_id in (0, 1, 1, 0, 2):
        sink(frame, batch_id)
    found = spark.table("replayed").groupBy("batch_id").count().collect()
    assert {tuple(r) for r in found} == {(0, 9), (1, 9), (2, 9)}


def test_failure_of_one_query_stops_the_other(spark, feed, tmp_path):
    feed.land([brute.message()])

    def fail(batch, batch_id):
        raise RuntimeError("no such store")

    path = str(tmp_path / "counts")
    forever = start_counts(
        feed.stream(), [table_sink(path)], str(tmp_path / "a"), interval="1 second"
    )
    failing = start_detail(feed.stream(), [fail], str(tmp_path / "b"), interval="1 second")
    with pytest.raises(StreamingQueryException, match="no such store"):
        await_all([forever, failing])
    assert not forever.isActive and not failing.isActive


def test_waits_for_all_queries(spark, feed, tmp_path):
    feed.land([brute.message()])
    queries = [
        start_detail(feed.stream(), [table_sink(str(tmp_path / "d"))], str(tmp_path / "a"),
                     interval=None, name="detail"),
        start_counts(feed.stream(), [table_sink(str(tmp_path / "c"))], str(tmp_path / "b"),
                     interval=None, name="counts"),
    ]
    assert [query.name for query in queries] == ["detail", "counts"]
    await_all(queries)
    assert count_table(spark, str(tmp_path / "c")).count() == 1
    assert detail_table(spark, str(tmp_path / "d")).count() == 1


def test_state_partitions_are_set_for_the_query_only(spark, feed, tmp_path):
    feed.land([brute.message(f"g{i}") for i in range(50)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    query = start_counts(
        feed.stream(),
        [table_sink(str(tmp_path / "c"))],
        str(tmp_path / "cp"),
        interval=None,
        state_partitions=3,
    )
    await_all([query])
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    operator = query.lastProgress.stateOperators[0]
    assert operator.numShufflePartitions == 3 and operator.numRowsTotal == 50
    assert any("rocksdb" in name for name in operator.customMetrics)


def test_session_conf_is_put_back_after_an_error(spark):
    name = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    before = spark.conf.get(name, None)
    with pytest.raises(ValueError):
        with session_conf(spark, {name: "true"}):
            assert spark.conf.get(name) == "true"
            raise ValueError
    assert spark.conf.get(name, None) == before


def test_streamed_files_with_record_time(spark, tmp_path):
    texts = [brute.message("g", "yes"), brute.message("g", "no")]
    data = [(bytearray(t.encode()),) for t in texts]
    frame = spark.createDataFrame(data, "value BINARY")
    folder = str(tmp_path / "messages")
    frame.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp")).write.parquet(folder)
    stream = file_messages(spark, folder)
    assert stream.isStreaming and stream.columns == ["value", "timestamp"]
    batch = file_messages(spark, folder, streaming=False)
    assert not batch.isStreaming and counts_of(batch).count() == 2


def test_fan_out_unpersists_after_an_error(spark):
    frame = spark.range(10)

    def fail(batch, batch_id):
        assert batch.count() == 10
        raise RuntimeError

    with pytest.raises(RuntimeError):
        fan_out(fail)(frame, 0)
    assert not frame.is_cached


def test_timed_batches_give_the_changelog(spark, feed, tmp_path):
    batches = random_batches(11, batches=4, size=200)
    path, stamps = str(tmp_path / "counts"), []
    feed.land(batches[0])
    query = start_counts(feed.stream(), [table_sink(path)], str(tmp_path / "cp"), interval="1 second")
    try:
        for i, texts in enumerate(batches):
            if i:
                feed.land(texts)  # between two ticks
            assert await_batch(query, i, 120)
            stamps.append(query.lastProgress["timestamp"])
        assert not await_batch(query, len(batches), 1.5)  # nothing landed: ticks pass without a batch
    finally:
        query.stop()
    assert rows(count_table(spark, path)) == brute.changelog(batches)
    started = [datetime.fromisoformat(s) for s in stamps]
    gaps = [(b - a).total_seconds() for a, b in zip(started, started[1:])]
    assert all(gap >= 0.9 for gap in gaps)  # one tick at least apart
    assert await_batch(query, 3, 1) and not await_batch(query, 9, 1)


def test_failed_query_is_raised_while_waiting(spark, feed, tmp_path):
    def fail(batch, batch_id):
        raise RuntimeError("sink is away")

    feed.land(random_batches(1, batches=1, size=5)[0])
    query = start_detail(feed.stream(), [fail], str(tmp_path / "cp"), interval="1 second")
    with pytest.raises(StreamingQueryException, match="sink is away"):
        await_batch(query, 0, 60)


def test_state_holds_the_totals_of_each_batch(spark, feed, tmp_path):
    batches = random_batches(13, batches=3, size=150)
    for texts in batches:
        feed.land(texts)
    cp = str(tmp_path / "cp")
    raw, sink = feed.stream(maxFilesPerTrigger=1), table_sink(str(tmp_path / "counts"))
    await_all([start_counts(raw, [sink], cp, interval=None, state_partitions=3)])
    for n in (1, 2, 3):
        found = state_counts(spark, cp, None if n == 3 else n - 1)
        expected = brute.counts([t for batch in batches[:n] for t in batch])
        assert {tuple(r)[:-1]: r.response_count for r in found.collect()} == expected
    parts = state_partitions(spark, cp).collect()
    assert sum(r.n_groups for r in parts) == len(brute.counts([t for b in batches for t in b]))
    assert {r.partition_id for r in parts} <= {0, 1, 2}


def test_progress_has_one_row_per_batch(spark, feed, tmp_path):
    batches = random_batches(17, batches=3, size=90)
    for texts in batches:
        feed.land(texts)
    log = ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    try:
        counts = start_counts(
            feed.stream(maxFilesPerTrigger=1), [table_sink(str(tmp_path / "counts"))],
            str(tmp_path / "cp"), interval=None, name="counted", state_partitions=2,
        )
        detail = start_detail(
            feed.stream(), [table_sink(str(tmp_path / "detail"))], str(tmp_path / "cp2"), interval=None
        )
        await_all([counts, detail])
        assert log.wait(counts) and log.wait(detail)
    finally:
        spark.streams.removeListener(log)
    table = progress_table(spark, log.path)
    found = {r.batch_id: r for r in table.filter("name = 'counted'").collect()}
    changes = brute.changelog(batches)
    assert sorted(found) == [0, 1, 2]
    for n, r in found.items():
        assert r.input_rows == 90 and r.run_id == str(counts.runId) and r.query_id == str(counts.id)
        assert r.state_updated_rows == sum(c[-1] == n for c in changes)
        assert r.state_rows == len({c[:-2] for c in changes if c[-1] <= n}) and r.state_partitions == 2
        assert r.duration_ms > 0 and r.state_memory_bytes > 0
    plain = table.filter("name IS NULL").collect()
    assert [(r.input_rows, r.state_rows) for r in plain] == [(270, None)]
    assert not log.wait(type("Query", (), {"runId": "none"})(), 0.2)


def test_split_stream_sends_each_message_to_one_side(spark, feed, tmp_path):
    good = [t for batch in random_batches(19, batches=2, size=30) for t in batch]
    bad = ["hello", '{"response":"yes",', '{"response":"yes","venue":"abc"}', "[1]"]
    feed.land(good[:30] + bad[:2])
    feed.land(good[30:] + bad[2:])
    detail, other = str(tmp_path / "detail"), str(tmp_path / "other")
    query = start_split_detail(
        feed.stream(maxFilesPerTrigger=1), [table_sink(detail)], table_sink(other),
        str(tmp_path / "cp"), interval=None,
    )
    await_all([query])
    found = detail_table(spark, detail)
    assert found.count() == 60 and {r.batch_id for r in found.collect()} == {0, 1}
    assert found.drop("batch_id").exceptAll(detail_of(feed_lines(spark, str(feed.folder), streaming=False))).isEmpty()
    rejected = spark.read.parquet(other).collect()
    assert sorted((r.batch_id, r.value) for r in rejected) == sorted(zip((0, 0, 1, 1), bad))


def test_filled_tables_without_a_note_are_not_empty(spark, tmp_path):
    path = str(tmp_path / "counts")
    frame = spark.createDataFrame([("a", "us", None, "c", "1", "2", "yes", 3, 0)], COUNT_TABLE_DDL)
    frame = frame.drop("batch_id")
    assert marked_newest_batch(spark, path).collect() == []  # there is no table yet
    sink = table_sink(path)
    for batch_id in (0, 4, 2):
        sink(frame, batch_id)
    assert [r.batch_id for r in marked_newest_batch(spark, path).collect()] == [4]
    json_path = str(tmp_path / "json")
    table_sink(json_path, "json")(frame, 7)
    assert [r.batch_id for r in marked_newest_batch(spark, json_path, "json").collect()] == [7]

    spark.sql(f"CREATE TABLE unmarked_counts ({COUNT_TABLE_DDL}) USING parquet PARTITIONED BY (batch_id)")
    try:
        assert catalog_newest_batch(spark, "unmarked_counts").collect() == []
        rows_ = frame.selectExpr("*", "explode(array(5L, 9L)) AS batch_id")
        rows_.write.insertInto("unmarked_counts")
        assert [r.batch_id for r in catalog_newest_batch(spark, "unmarked_counts").collect()] == [9]
        catalog_sink("unmarked_counts", COUNT_TABLE_DDL)(frame, 10)
        assert [r.batch_id for r in catalog_newest_batch(spark, "unmarked_counts").collect()] == [10]
    finally:
        spark.sql("DROP TABLE unmarked_counts")


def test_slices_land_whole_and_in_files_that_many_tasks_read(spark, tmp_path, monkeypatch):
    n = 400
    tables = {
        "region": "SELECT 0 AS r_regionkey, 'R' AS r_name",
        "nation": "SELECT 1 AS n_nationkey, 'N' AS n_name, 0 AS n_regionkey",
        "customer": "SELECT id AS c_custkey, 'c' AS c_name, 1 AS c_nationkey, 'm' AS c_mktsegment "
        "FROM range(5)",
        "events": "SELECT id AS event_id, timestamp_ntz'2024-01-01 00:00:00' AS ts, "
        f"id % 5 AS user_id, 'view' AS event_type, 0D AS value, '{{}}' AS props FROM range({n})",
    }
    for name, sql in tables.items():
        spark.sql(sql).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    folders = {name: str(tmp_path / name) for name in ("staged", "landing")}
    monkeypatch.setattr(checked, "shared_folder", lambda _, purpose: folders[purpose])
    monkeypatch.setattr(checked, "ROWS_PER_FILE", 20, raising=False)
    landing = folders["landing"]
    for i in checked.landed_slices(spark, str(tmp_path), landing):
        rows = spark.read.parquet(landing).selectExpr("CAST(value AS STRING) AS value")
        ids = [int(r.value.split('"rsvp_id":')[1].split(",")[0]) for r in rows.collect()]
        assert sorted(ids) == list(range(n * (i + 1) // checked.SLICES))
        staged = spark.read.parquet(f"{folders['staged']}/batch_id={i}")
        files = staged.groupBy(F.input_file_name()).count().collect()
        assert sum(r["count"] for r in files) == n // checked.SLICES
        # One file of a slice is read by one task.
        assert max(r["count"] for r in files) <= 20
