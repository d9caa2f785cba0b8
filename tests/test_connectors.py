import json

import pytest

import brute
import connectors
from turnout.functions.schema import COUNT_TABLE_DDL, DETAIL_COLUMNS
from turnout.jobs import dashboard, publish, respond
from turnout.operators.newest import newest_batch
from turnout.plans.messages import counts_of
from turnout.sources.messages import topic_messages
from turnout.sources.results import (
    count_table,
    database_newest_batch,
    database_newest_shares,
    database_query,
    detail_table,
    key_share_sql,
    top_groups_sql,
)
from turnout.streaming.queries import await_all, start_counts, start_detail, start_publish
from turnout.streaming.sinks import database_sink, document_sink, table_sink, topic_sink


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    connectors.register(spark)


def publish_texts(spark, folder, texts):
    """Put messages into the topic."""
    path = folder / "texts"
    path.mkdir(exist_ok=True)
    number = len(list(path.iterdir()))
    (path / f"{number}.txt").write_text("".join(t + "\n" for t in texts))
    query = start_publish(
        spark.readStream.text(str(path)),
        "server:9092",
        "messages",
        table_sink(str(folder / "rejected")),
        str(folder / "publish-cp"),
        interval=None,
        connector="test_topic",
        store=str(folder / "topic"),
    )
    await_all([query])


def test_feed_to_topic_stream(spark, tmp_path):
    texts = [brute.message("a", "yes"), '{"any": ["thing"]}', "broken"]
    publish_texts(spark, tmp_path, texts)
    rows, options = connectors.stored(tmp_path / "topic")
    assert sorted(r["value"] for r in rows) == sorted(texts[:2])
    assert all(list(r) == ["value"] for r in rows)
    assert options[0]["kafka.bootstrap.servers"] == "server:9092"
    assert options[0]["topic"] == "messages"


def test_topic_sink_encodes_rows(spark, tmp_path):
    frame = spark.createDataFrame([("a", None, 3)], "g STRING, s STRING, n BIGINT")
    sink = topic_sink("server:9092", "out", connector="test_topic", store=str(tmp_path / "topic"))
    sink(frame, 0)
    rows, _ = connectors.stored(tmp_path / "topic")
    assert [json.loads(r["value"]) for r in rows] == [{"g": "a", "s": None, "n": 3}]


def test_topic_scan_as_batch(spark, tmp_path):
    publish_texts(spark, tmp_path, [brute.message("a", "yes")] * 3)
    raw = topic_messages(
        spark,
        "server:9092",
        "messages",
        streaming=False,
        connector="test_topic",
        store=str(tmp_path / "topic"),
    )
    assert raw.columns == ["value", "timestamp"] and dict(raw.dtypes)["value"] == "binary"
    assert [r.response_count for r in counts_of(raw).collect()] == [3]
    _, options = connectors.stored(tmp_path / "topic-read")
    lower = {name.lower(): value for name, value in options[0].items()}
    assert lower["startingoffsets"] == "earliest" and lower["subscribe"] == "messages"


@pytest.mark.parametrize("given,expected", [(None, "latest"), ("earliest", "earliest")])
def test_topic_stream_to_changelog(spark, tmp_path, given, expected):
    batches = [
        [brute.message("a", "yes"), brute.message("a", "yes"), brute.message("b", "no")],
        [brute.message("a", "yes")],
    ]
    path = str(tmp_path / "counts")
    for texts in batches:
        publish_texts(spark, tmp_path, texts)
        raw = topic_messages(
            spark,
            "server:9092",
            "messages",
            starting_offsets=given,
            connector="test_topic",
            store=str(tmp_path / "topic"),
            maxOffsetsPerTrigger="100",
        )
        await_all([start_counts(raw, [table_sink(path)], str(tmp_path / "cp"), interval=None)])
    _, options = connectors.stored(tmp_path / "topic-read")
    lower = {name.lower(): value for name, value in options[0].items()}
    assert lower["startingoffsets"] == expected and lower["maxoffsetspertrigger"] == "100"
    assert lower["kafka.bootstrap.servers"] == "server:9092"
    table = count_table(spark, path)
    found = {(r.group_name, r.response_count, r.batch_id) for r in table.collect()}
    assert found == {("a", 2, 0), ("b", 1, 0), ("a", 3, 1)}


def test_documents_keep_nested_fields(spark, tmp_path):
    text = brute.message("g", "yes", group_topics=[{"urlkey": "a", "topic_name": "A"}])
    publish_texts(spark, tmp_path, [text])
    raw = topic_messages(spark, "s", "t", connector="test_topic", store=str(tmp_path / "topic"))
    store = str(tmp_path / "documents")
    sink = document_sink("test_store", store=store, database="d", collection="c")
    await_all([start_detail(raw, [sink], str(tmp_path / "cp"), interval=None)])
    rows, options = connectors.stored(tmp_path / "documents")
    assert [list(r) for r in rows] == [[*DETAIL_COLUMNS, "batch_id"]]
    assert rows[0]["group_topics"] == [{"urlkey": "a", "topic_name": "A"}]
    assert rows[0]["batch_id"] == 0
    assert (options[0]["database"], options[0]["collection"]) == ("d", "c")


def test_repeated_database_batch_reads_back_once(spark, tmp_path):
    frame = spark.createDataFrame(
        [(f"g{n}", "us", None, "c", "1", "2", "yes", n) for n in range(20)],
        COUNT_TABLE_DDL.replace(", batch_id BIGINT", ""),
    )
    store = str(tmp_path / "database")
    sink = database_sink(
        "jdbc:any", "counts", connections=4, connector="test_store", store=store, user="u"
    )
    sink(frame, 7)
    sink(frame, 7)
    rows, options = connectors.stored(tmp_path / "database")
    assert len(rows) == 40
    lower = {name.lower(): value for name, value in options[0].items()}
    assert lower["url"] == "jdbc:any" and lower["dbtable"] == "counts"
    assert lower["numpartitions"] == "4" and lower["user"] == "u"

    back = database_newest_batch(
        spark, "jdbc:any", "counts", connector="test_store", store=store, ddl=COUNT_TABLE_DDL
    )
    assert sorted(r.response_count for r in back.collect()) == list(range(20))
    _, options = connectors.stored(tmp_path / "database-read")
    assert "WHERE batch_id = (SELECT max(batch_id) FROM counts)" in options[0]["dbtable"]


def test_shares_of_the_newest_batch_are_disjoint_and_complete(spark, tmp_path):
    columns = COUNT_TABLE_DDL.replace("STRING", "VARCHAR")
    store = tmp_path / "database"
    store.mkdir()
    names = [f.split()[0] for f in COUNT_TABLE_DDL.split(", ")]
    rows = [
        (f"g{i % 40}", "us", None if i % 3 else "s", f"c{i}", "1", None, "yes", i, batch)
        for batch in (3, 4)
        for i in range(200)
    ]
    rows += [(None,) * 7 + (1, 4)] + rows[-30:]  # all keys NULL; a batch that was written again
    text = "".join(json.dumps(dict(zip(names, row))) + "\n" for row in rows)
    (store / "0.rows").write_text(text)
    options = {"store": str(store), "columns": columns, "ddl": COUNT_TABLE_DDL}
    hash_sql = "hash(concat_ws(',', {keys}))"
    back = database_newest_shares(
        spark, "jdbc:any", "counts", 5, connector="test_sql", hash_sql=hash_sql, **options
    )
    found = [tuple(r) for r in back.collect()]
    assert sorted(found, key=repr) == sorted(set(rows[200:]), key=repr)
    _, sent = connectors.stored(tmp_path / "database-read")
    tables = sorted({o["dbtable"] for o in sent if "dbtable" in o})
    assert len(tables) == 5 and all("batch_id = 4 AND" in t for t in tables)
    parts = []
    for share in range(5):
        where = key_share_sql(5, share, hash_sql)
        part = spark.read.format("test_sql").options(**options)
        part = part.option("dbtable", f"(SELECT * FROM counts WHERE batch_id = 4 AND {where}) x")
        parts.append([tuple(r) for r in part.load().collect()])
    assert sorted(sum(parts, []), key=repr) == sorted(rows[200:], key=repr)  # each row in one share
    assert sum(map(bool, parts)) > 1
    assert not any(set(a) & set(b) for i, a in enumerate(parts) for b in parts[:i])
    (store / "0.rows").write_text("")
    empty = database_newest_shares(
        spark, "jdbc:any", "counts", 2, connector="test_sql", hash_sql=hash_sql, **options
    )
    assert empty.collect() == []


def test_database_query_is_sent_as_it_is(spark, tmp_path):
    store = str(tmp_path / "database")
    (tmp_path / "database").mkdir()
    (tmp_path / "database" / "x.rows").write_text('{"group_name": "a", "n": 3}\n')
    sql = "SELECT group_name, response_count AS n FROM counts ORDER BY 2 DESC LIMIT 10"
    ddl = "group_name STRING, n BIGINT"
    frame = database_query(spark, "jdbc:any", sql, connector="test_store", store=store, ddl=ddl)
    assert [tuple(r) for r in frame.collect()] == [("a", 3)]
    _, options = connectors.stored(tmp_path / "database-read")
    assert options[0]["query"] == sql


def test_the_three_programs(spark, tmp_path, capsys):
    """Feed to topic, topic to all stores, stores to the dashboard."""
    feed = tmp_path / "feed"
    feed.mkdir()
    topic, documents, database = (str(tmp_path / n) for n in ("topic", "documents", "database"))
    batches = [
        [brute.message("a", "yes")] * 2 + [brute.message("b", "no")],
        [brute.message("b", "no"), brute.message("c", "waitlist"), "broken"],
    ]
    for number, texts in enumerate(batches):
        (feed / f"{number}.txt").write_text("".join(t + "\n" for t in texts))
        publish.main(
            ["--feed", str(feed), "--servers", "s", "--topic", "t", "--connector", "test_topic",
             "--rejected", str(tmp_path / "rejected"),
             "--checkpoint", str(tmp_path / "publish"), "--topic-option", f"store={topic}",
             "--feed-option", "maxFilesPerTrigger=10", "--once"]
        )
        respond.main(
            ["--topic", "t", "--servers", "s", "--topic-connector", "test_topic",
             "--source-option", f"store={topic}", "--checkpoint", str(tmp_path / "respond"),
             "--detail-path", str(tmp_path / "detail"),
             "--document-connector", "test_store", "--document-option", f"store={documents}",
             "--count-path", str(tmp_path / "counts"), "--count-table", "program_counts",
             "--database-url", "jdbc:any", "--database-table", "counts",
             "--database-connector", "test_store", "--database-option", f"store={database}",
             "--console", "--console-rows", "7", "--state-partitions", "4", "--once"]
        )
    printed = capsys.readouterr().out
    assert "group_topics: array" in printed and "response_count: long" in printed
    assert "Batch: 1" in printed

    rejected = spark.read.parquet(str(tmp_path / "rejected")).collect()
    assert [(r.value, r.batch_id) for r in rejected] == [("broken", 1)]

    newest = {("b", "no", 2), ("c", "waitlist", 1)}
    for table in (count_table(spark, str(tmp_path / "counts")), spark.table("program_counts")):
        found = newest_batch(table).collect()
        assert {(r.group_name, r.response, r.response_count) for r in found} == newest
    assert len(connectors.stored(tmp_path / "database")[0]) == 4
    assert len(connectors.stored(tmp_path / "documents")[0]) == 5
    assert detail_table(spark, str(tmp_path / "detail")).count() == 5

    for source, expected in (
        (["--count-path", str(tmp_path / "counts")], "refreshed_at"),
        (["--count-table", "program_counts", "--json"], '"response_count":2,"batch_id":1}'),
    ):
        dashboard.main(source)
        printed = capsys.readouterr().out
        assert "yes_response_count" in printed and "waitlist" in printed
        assert expected in printed


def test_the_dashboard_on_a_database(spark, tmp_path, capsys):
    store = str(tmp_path / "database")
    frame = spark.createDataFrame(
        [("only", "us", None, "c", "1", "2", "yes", 5)],
        COUNT_TABLE_DDL.replace(", batch_id BIGINT", ""),
    )
    database_sink("jdbc:any", "counts", connector="test_store", store=store)(frame, 0)
    dashboard.main(
        ["--database-url", "jdbc:any", "--database-table", "counts",
         "--database-connector", "test_store", "--database-option", f"store={store}",
         "--database-option", f"ddl={COUNT_TABLE_DDL}"]
    )
    assert "only" in capsys.readouterr().out
    _, options = connectors.stored(tmp_path / "database-read")
    # One read gives all shapes.
    assert [o["query"] for o in options] == [top_groups_sql("counts")]


def test_the_dashboard_before_the_first_batch(spark, tmp_path, capsys):
    dashboard.main(["--count-path", str(tmp_path / "none")])
    spark.sql(f"CREATE TABLE no_counts ({COUNT_TABLE_DDL}) USING parquet PARTITIONED BY (batch_id)")
    dashboard.main(["--count-table", "no_counts"])
    printed = capsys.readouterr().out
    assert printed.count("yes_response_count") == 2 and printed.count("refreshed_at") == 2


def test_top_groups_sql_tells_groups_apart_by_bytes(spark):
    columns = ", ".join(
        f"{name} {kind} COLLATE UTF8_LCASE" if kind == "STRING" else f"{name} {kind}"
        for name, kind in (c.split() for c in COUNT_TABLE_DDL.split(", "))
    )
    row = ("us", None, "c", "1", "2", "yes")
    rows = [("Go Club", *row, 5, 1), ("go club", *row, 5, 1), ("Go Club", *row, 5, 1)]
    frame = spark.createDataFrame([*rows, ("old", *row, 9, 0)], COUNT_TABLE_DDL)
    spark.sql(f"CREATE TABLE collated ({columns}) USING parquet")
    frame.write.insertInto("collated")
    found = sorted((r.group_name, r[-2]) for r in spark.sql(top_groups_sql("collated")).collect())
    assert found == [("Go Club", 5), ("go club", 5)]


@pytest.mark.parametrize(
    "main,argv",
    [
        (respond.main, ["--topic", "t", "--checkpoint", "c"]),
        (respond.main, ["--feed", "f", "--checkpoint", "c", "--database-url", "u"]),
        (respond.main, ["--feed", "f", "--files", "g", "--checkpoint", "c"]),
        (respond.main, ["--feed", "f", "--checkpoint", "c", "--source-option", "novalue"]),
        (dashboard.main, ["--database-url", "u"]),
        (publish.main, ["--feed", "f"]),
    ],
)
def test_wrong_arguments(main, argv):
    with pytest.raises(SystemExit):
        main(argv)
