"""One query per operator, over messages derived from the test tables."""

from collections.abc import Callable, Iterator, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from checks.feed import SLICES, messages
from turnout.functions.schema import COUNT_TABLE_DDL, KEYS
from turnout.operators.counts import count_changelog, current_counts
from turnout.operators.messages import (
    clean_messages,
    encode_records,
    feed_records,
    flatten_detail,
    group_keys,
    parse_messages,
    split_messages,
)
from turnout.operators.newest import (
    bar_series,
    grid,
    head_rows,
    json_records,
    max_batch,
    newest_batch,
    top_groups,
    yes_no_counts,
)
from turnout.operators.unknown import unknown_fields, unknown_paths, variant_fields
from turnout.plans.dashboard import dashboard_of
from turnout.plans.messages import counts_of, detail_of
from turnout.session import shared_folder
from turnout.sources.messages import feed_lines, file_messages
from turnout.sources.results import (
    NEWEST,
    catalog_newest_batch,
    count_table,
    detail_table,
    marked_newest_batch,
    top_groups_sql,
)
from turnout.sources.state import state_counts
from turnout.streaming.progress import ProgressLog, progress_table
from turnout.streaming.queries import (
    await_all,
    await_batch,
    start_counts,
    start_detail,
    start_publish,
    start_split_detail,
)
from turnout.streaming.sinks import Sink, catalog_sink, table_sink

# Messages in a staged file, some megabytes: small enough to share a slice out evenly.
ROWS_PER_FILE = 25_000

Query = Callable[[SparkSession, str], DataFrame]


def scalar_detail(detail: DataFrame) -> DataFrame:
    """Detail rows with the whole array of topics as JSON text, for comparison by value."""
    return detail.withColumn("group_topics", topics_text("group_topics"))


def topics_text(topics: str) -> Column:
    return F.to_json(topics, {"ignoreNullFields": "false"})


def leaves(parsed: DataFrame) -> DataFrame:
    """Every leaf of the message fields, the topics as JSON text."""
    columns = []
    for field in parsed.schema:
        if isinstance(field.dataType, StructType):
            columns += [f"{field.name}.{name}" for name in field.dataType.names]
        else:
            columns.append(field.name)
    flat = parsed.select(*columns).withColumn("group_topics", topics_text("group_topics"))
    return flat.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_changelog(group_keys(messages(spark, sf_dir), "batch_id"))


def changelog_folder(spark: SparkSession, sf_dir: str) -> str:
    """The changelog as a file table with a note of its newest batch, as a stream leaves it."""
    path = shared_folder(spark, "changelog")
    # Rebalance: the rows of a batch go to few files, and a large batch to several tasks.
    rows = changelog(spark, sf_dir).hint("rebalance", "batch_id")
    rows.write.partitionBy("batch_id").parquet(path)
    newest = spark.range(SLICES - 1, SLICES, 1, 1)
    newest.write.json(f"{path}/{NEWEST}/place=0")
    return path


def stored_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_table(spark, changelog_folder(spark, sf_dir))


def newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest batch by its note: one folder is listed and read."""
    return marked_newest_batch(spark, changelog_folder(spark, sf_dir))


def refresh_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of the dashboard, refreshed when the last event came."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return dashboard_of(newest(spark, sf_dir), time=events.agg(F.max("ts")).scalar()).rows


def landed_lines(spark: SparkSession, sf_dir: str) -> str:
    """All messages as text files, one message per line."""
    path = shared_folder(spark, "lines")
    messages(spark, sf_dir).select(F.col("value").cast("string")).write.text(path)
    return path


def counting(spark: SparkSession) -> Callable[..., StreamingQuery]:
    """``start_counts`` with one part of the state per core."""
    return partial(start_counts, state_partitions=spark.sparkContext.defaultParallelism)


def landed_slices(spark: SparkSession, sf_dir: str, landing: str) -> Iterator[int]:
    """Land one slice of the messages after the other as files, each when the next is asked for.

    Each task that makes messages writes its own files of each slice, so that no slice lies in
    fewer files than there are tasks, and none is shuffled once more. A file of Parquet is read by
    one task, so large files would leave cores without work.
    """
    staged = shared_folder(spark, "staged")
    rows = messages(spark, sf_dir).select("batch_id", "value", "timestamp")
    writer = rows.write.option("maxRecordsPerFile", ROWS_PER_FILE)
    writer.partitionBy("batch_id").parquet(staged)
    for i in range(SLICES):
        part = spark.read.schema(rows.schema).parquet(staged).filter(F.col("batch_id") == i)
        part.select("value", "timestamp").write.mode("append").parquet(landing)
        yield i


def stream_slices(
    spark: SparkSession,
    sf_dir: str,
    start: Callable[..., StreamingQuery],
    *sinks: Sink,
    log: ProgressLog | None = None,
) -> str:
    """Run a streaming query over the messages, one slice after the other; its checkpoint.

    Each slice lands as files before the query is started again on the same checkpoint,
    so micro-batch ``i`` reads slice ``i``, whole, on any file system.
    """
    landing, checkpoint = shared_folder(spark, "landing"), shared_folder(spark, "checkpoint")
    for _ in landed_slices(spark, sf_dir, landing):
        query = start(file_messages(spark, landing), sinks, checkpoint, interval=None)
        await_all([query])
        if log is not None:
            log.wait(query)
    return checkpoint


def stream_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "counts")
    sink = table_sink(path)
    stream_slices(spark, sf_dir, counting(spark), sink)
    return count_table(spark, path)


def marked_latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "counts")
    stream_slices(spark, sf_dir, counting(spark), table_sink(path, mark_newest=True))
    return marked_newest_batch(spark, path)


def stream_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "detail")
    stream_slices(spark, sf_dir, start_detail, table_sink(path))
    return scalar_detail(detail_table(spark, path))


def stream_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details as JSON documents, topics nested in them."""
    path = shared_folder(spark, "documents")
    stream_slices(spark, sf_dir, start_detail, table_sink(path, "json"))
    return scalar_detail(detail_table(spark, path, "json"))


def stream_two_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog from each of two tables that one query feeds."""
    paths = {name: shared_folder(spark, name) for name in ("first", "second")}
    stream_slices(spark, sf_dir, counting(spark), *map(table_sink, paths.values()))
    first, second = (
        count_table(spark, path).withColumn("copy", F.lit(name)) for name, path in paths.items()
    )
    return first.unionAll(second)


def stream_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog from a table to which each batch was written twice."""
    path = shared_folder(spark, "replayed")
    sink = table_sink(path)
    stream_slices(spark, sf_dir, counting(spark), sink, sink)
    return count_table(spark, path)


def streamed_catalog_table(spark: SparkSession, sf_dir: str) -> str:
    path = shared_folder(spark, "catalog")
    table = "turnout_" + path[-32:]
    spark.sql(
        f"CREATE TABLE {table} ({COUNT_TABLE_DDL}) USING parquet "
        f"PARTITIONED BY (batch_id) LOCATION '{path}'"
    )
    sink = catalog_sink(table, COUNT_TABLE_DDL)
    stream_slices(spark, sf_dir, counting(spark), sink)
    return table


def throttled_stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last totals of a stream over six files that takes two at a time, and the batches made."""
    path, lines = shared_folder(spark, "counts"), shared_folder(spark, "lines")
    text = messages(spark, sf_dir).select(F.col("value").cast("string"))
    text.repartition(6).write.text(lines)
    raw = feed_lines(spark, lines, maxFilesPerTrigger=2)
    checkpoint = shared_folder(spark, "checkpoint")
    await_all([counting(spark)(raw, [table_sink(path)], checkpoint, interval=None)])
    table = count_table(spark, path)
    batches = table.agg(F.count_distinct("batch_id")).scalar()
    # Totals only grow, so the largest one of a group is its last.
    totals = table.groupBy(*KEYS).agg(F.max("response_count").alias("response_count"))
    return totals.withColumn("batches", batches)


def publish_feed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Publish the feed by a stream, with files in place of the topic; the folders of what was
    published and of what was rejected."""
    published, rejected = shared_folder(spark, "published"), shared_folder(spark, "rejected")
    query = start_publish(
        feed_lines(spark, landed_lines(spark, sf_dir)),
        "",
        "",
        table_sink(rejected),
        shared_folder(spark, "checkpoint"),
        interval=None,
        connector="parquet",
        path=published,
    )
    await_all([query])
    return published, rejected


def stream_to_topic_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the messages that a stream published."""
    published, _ = publish_feed(spark, sf_dir)
    lines = spark.read.schema("value BINARY").parquet(published)
    return counts_of(lines.withColumn("timestamp", F.lit(None).cast("timestamp")))


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a publishing stream rejected, by the event of each line, and how many lines it took."""
    published, rejected = publish_feed(spark, sf_dir)
    lines = spark.read.schema("value STRING, batch_id BIGINT").parquet(rejected)
    number = F.regexp_extract("value", '"rsvp_id":([0-9]+)', 1).cast("bigint")
    good = spark.read.schema("value BINARY").parquet(published)
    total = good.agg(F.count("*")).scalar() + lines.agg(F.count("*")).scalar()
    return lines.select(number.alias("event_id"), total.alias("lines"))


def stream_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog of one query that runs every second, while slices land between its ticks."""
    landing, path = shared_folder(spark, "landing"), shared_folder(spark, "counts")
    query = None
    for i in landed_slices(spark, sf_dir, landing):
        if query is None:
            raw = file_messages(spark, landing)
            checkpoint = shared_folder(spark, "checkpoint")
            query = counting(spark)(raw, [table_sink(path)], checkpoint, interval="1 second")
        if not await_batch(query, i, 600):
            query.stop()
            raise TimeoutError(f"batch {i} is not done")
    query.stop()
    return count_table(spark, path)


def streamed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals read from the state of a streaming query, not from its sink."""
    sink = table_sink(shared_folder(spark, "counts"))
    return state_counts(spark, stream_slices(spark, sf_dir, counting(spark), sink))


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per micro-batch: messages read, groups changed and groups kept, as the query reported them."""
    log = ProgressLog(spark, shared_folder(spark, "progress"))
    spark.streams.addListener(log)
    try:
        sink = table_sink(shared_folder(spark, "counts"))
        stream_slices(spark, sf_dir, counting(spark), sink, log=log)
    finally:
        spark.streams.removeListener(log)
    return progress_table(spark, log.path).select(
        "batch_id",
        F.col("input_rows").alias("messages"),
        F.col("state_updated_rows").alias("changed_groups"),
        F.col("state_rows").alias("n_groups"),
    )


def split_stream(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Run the detail query with its split; the folders of details and of malformed messages."""
    detail, malformed = shared_folder(spark, "detail"), shared_folder(spark, "malformed")

    def start(raw: DataFrame, sinks: Sequence[Sink], checkpoint: str, **options) -> StreamingQuery:
        return start_split_detail(raw, sinks, table_sink(malformed), checkpoint, **options)

    stream_slices(spark, sf_dir, start, table_sink(detail))
    return detail, malformed


def stream_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream split off, by event and batch, and how many rows both sides have together."""
    detail, malformed = split_stream(spark, sf_dir)
    ddl = "value STRING, timestamp TIMESTAMP, batch_id BIGINT"
    rows = spark.read.schema(ddl).parquet(malformed)
    number = F.regexp_extract("value", '"rsvp_id":([0-9]+)', 1).cast("bigint")
    total = detail_table(spark, detail).agg(F.count("*")).scalar() + rows.agg(F.count("*")).scalar()
    return rows.select(number.alias("event_id"), "batch_id", total.alias("messages"))


def chosen_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed columns of fields that the declared schema does not know."""
    fields = {
        "event_id": ("$.rsvp_id", "bigint"),
        "k": ("$.props.k", "int"),
        "score": ("$.score", "double"),
        "second_mark": ("$.marks[1]", "int"),
        "owner": ("$.group.owner", "bigint"),
    }
    return variant_fields(messages(spark, sf_dir, unknown=True), fields)


def any_case_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars where the groups of one city answer in capitals."""
    loud = F.when(F.col("group_city") == "City_1", F.upper("response"))
    rows = newest(spark, sf_dir).withColumn("response", F.coalesce(loud, "response"))
    return yes_no_counts(rows, collation="UTF8_LCASE")


def published_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail rows of messages that were parsed, encoded and parsed once more."""
    records = encode_records(parse_messages(messages(spark, sf_dir)).drop("timestamp"))
    return detail_of(records.withColumn("timestamp", F.lit(None).cast("timestamp")))


QUERIES: dict[str, Query] = {
    "parse_messages": lambda spark, sf_dir: leaves(parse_messages(messages(spark, sf_dir))),
    "flatten_detail": lambda spark, sf_dir: scalar_detail(
        flatten_detail(parse_messages(messages(spark, sf_dir)))
    ),
    "response_counts": lambda spark, sf_dir: counts_of(messages(spark, sf_dir)),
    "response_changelog": changelog,
    "max_batch": lambda spark, sf_dir: max_batch(stored_changelog(spark, sf_dir)),
    "latest_batch": lambda spark, sf_dir: newest_batch(stored_changelog(spark, sf_dir)),
    "top_groups": lambda spark, sf_dir: top_groups(newest(spark, sf_dir)),
    "sql_top_groups": lambda spark, sf_dir: spark.sql(
        top_groups_sql("{counts}"), counts=stored_changelog(spark, sf_dir)
    ),
    "yes_no_counts": lambda spark, sf_dir: yes_no_counts(newest(spark, sf_dir)),
    "display_table": lambda spark, sf_dir: grid(top_groups(newest(spark, sf_dir))),
    "chart_series": lambda spark, sf_dir: bar_series(yes_no_counts(newest(spark, sf_dir))),
    "head_rows": lambda spark, sf_dir: head_rows(newest(spark, sf_dir)),
    "json_records": lambda spark, sf_dir: json_records(top_groups(newest(spark, sf_dir))),
    "refresh_stamp": refresh_stamp,
    "encode_records": lambda spark, sf_dir: encode_records(
        detail_of(messages(spark, sf_dir))
    ).select(F.col("value").cast("string").alias("record")),
    "publish_roundtrip": lambda spark, sf_dir: scalar_detail(published_again(spark, sf_dir)),
    "text_feed_counts": lambda spark, sf_dir: counts_of(
        feed_lines(spark, landed_lines(spark, sf_dir), streaming=False)
    ),
    "feed_records": lambda spark, sf_dir: counts_of(
        feed_records(feed_lines(spark, landed_lines(spark, sf_dir), streaming=False))
    ),
    "stream_changelog": stream_changelog,
    "stream_detail": stream_detail,
    "stream_latest_batch": lambda spark, sf_dir: newest_batch(stream_changelog(spark, sf_dir)),
    "marked_latest_batch": marked_latest_batch,
    "stream_documents": stream_documents,
    "stream_two_tables": stream_two_tables,
    "stream_replayed": stream_replayed,
    "catalog_changelog": lambda spark, sf_dir: spark.table(
        streamed_catalog_table(spark, sf_dir)
    ),
    "catalog_latest_batch": lambda spark, sf_dir: catalog_newest_batch(
        spark, streamed_catalog_table(spark, sf_dir)
    ),
    "throttled_stream_counts": throttled_stream_counts,
    "stream_to_topic_files": stream_to_topic_files,
    "rejected_lines": rejected_lines,
    "variant_fields": chosen_fields,
    "unknown_fields": lambda spark, sf_dir: unknown_paths(
        unknown_fields(messages(spark, sf_dir, unknown=True))
    ),
    "clean_detail": lambda spark, sf_dir: scalar_detail(
        flatten_detail(clean_messages(split_messages(messages(spark, sf_dir))))
    ),
    "stream_clean_detail": lambda spark, sf_dir: scalar_detail(
        detail_table(spark, split_stream(spark, sf_dir)[0])
    ),
    "stream_malformed": stream_malformed,
    "state_counts": streamed_state,
    "stream_progress": stream_progress,
    "current_counts": lambda spark, sf_dir: current_counts(stored_changelog(spark, sf_dir)),
    "current_top_groups": lambda spark, sf_dir: top_groups(
        current_counts(stored_changelog(spark, sf_dir))
    ),
    "yes_no_any_case": any_case_counts,
    "stream_timed": stream_timed,
}
