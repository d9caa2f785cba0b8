"""Read messages, keep their details and the running response counts per group."""

from argparse import ArgumentParser, Namespace
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from turnout.functions.schema import COUNT_TABLE_DDL, DETAIL_TABLE_DDL
from turnout.jobs.options import add_option, add_trigger, interval
from turnout.plans.messages import counts_of, detail_of
from turnout.session import job_session
from turnout.sources.messages import feed_lines, file_messages, topic_messages
from turnout.streaming.progress import ProgressLog
from turnout.streaming.queries import (
    ROWS_PER_TASK,
    await_all,
    start_counts,
    start_detail,
    start_split_detail,
)
from turnout.streaming.sinks import (
    Sink,
    catalog_sink,
    console_sink,
    database_sink,
    document_sink,
    table_sink,
)


def arguments() -> ArgumentParser:
    parser = ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--topic")
    source.add_argument("--files", help="folder of files with value and timestamp")
    source.add_argument("--feed", help="folder of text files, one JSON message per line")
    parser.add_argument("--servers", help="servers of the topic")
    parser.add_argument("--starting-offsets", help="where a new stream starts in the topic")
    parser.add_argument("--topic-connector", default="kafka")
    add_option(parser, "--source-option", "the message reader")

    parser.add_argument("--checkpoint", required=True, help="folder for both checkpoints")
    parser.add_argument("--detail-path", help="folder of the detail table")
    parser.add_argument("--detail-table", help="catalog table for details")
    parser.add_argument(
        "--even-files", action="store_true", help="shuffle details into files of even size"
    )
    parser.add_argument("--document-connector", default="mongodb")
    add_option(parser, "--document-option", "the document writer; turns it on")
    parser.add_argument(
        "--malformed-path", help="folder for messages that do not parse; details get the others"
    )
    parser.add_argument("--progress-path", help="folder for the progress of each micro-batch")
    parser.add_argument("--count-path", help="folder of the count table")
    parser.add_argument("--count-table", help="catalog table for counts")
    parser.add_argument("--database-url")
    parser.add_argument("--database-table")
    parser.add_argument("--database-connector", default="jdbc")
    add_option(parser, "--database-option", "the database writer")
    parser.add_argument("--database-connections", type=int, default=8)
    parser.add_argument("--console", action="store_true", help="also print the counts")
    parser.add_argument("--console-rows", type=int, default=20)
    parser.add_argument("--rows-per-task", type=int, default=ROWS_PER_TASK)
    parser.add_argument(
        "--state-partitions", type=int, help="frozen by the first start; required on a cluster"
    )
    add_trigger(parser)
    return parser


def messages(spark: SparkSession, args: Namespace) -> DataFrame:
    options = dict(args.source_option)
    if args.files:
        return file_messages(spark, args.files, **options)
    if args.feed:
        return feed_lines(spark, args.feed, **options)
    return topic_messages(
        spark,
        args.servers,
        args.topic,
        starting_offsets=args.starting_offsets,
        connector=args.topic_connector,
        **options,
    )


def detail_sinks(args: Namespace) -> list[Sink]:
    sinks = []
    if args.detail_path:
        sinks.append(table_sink(args.detail_path, even_files=args.even_files))
    if args.detail_table:
        sinks.append(
            catalog_sink(args.detail_table, DETAIL_TABLE_DDL, even_files=args.even_files)
        )
    if args.document_option:
        sinks.append(document_sink(args.document_connector, **dict(args.document_option)))
    return sinks


def count_sinks(args: Namespace) -> list[Sink]:
    sinks = []
    if args.count_path:
        sinks.append(table_sink(args.count_path, mark_newest=True))
    if args.count_table:
        sinks.append(catalog_sink(args.count_table, COUNT_TABLE_DDL))
    if args.database_url:
        sinks.append(
            database_sink(
                args.database_url,
                args.database_table,
                connections=args.database_connections,
                connector=args.database_connector,
                **dict(args.database_option),
            )
        )
    if args.console:
        sinks.append(console_sink(args.console_rows))
    return sinks


def main(argv: Sequence[str] | None = None) -> None:
    parser = arguments()
    args = parser.parse_args(argv)
    if args.topic and not args.servers:
        parser.error("--topic needs --servers")
    if bool(args.database_url) != bool(args.database_table):
        parser.error("--database-url and --database-table go together")
    spark = job_session("respond", {"spark.scheduler.mode": "FAIR"})
    if args.state_partitions is None and not spark.sparkContext.master.startswith("local"):
        parser.error("on a cluster, choose --state-partitions for the groups to come")
    raw = messages(spark, args)
    for frame in (raw, detail_of(raw), counts_of(raw)):
        frame.printSchema()

    queries, log = [], None
    if args.progress_path:
        log = ProgressLog(spark, args.progress_path)
        spark.streams.addListener(log)
    # A pool for each query: a long batch of details does not hold up the counts.
    if sinks := detail_sinks(args):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", "detail")
        checkpoint, when = f"{args.checkpoint}/detail", interval(args)
        if args.malformed_path:
            other = table_sink(args.malformed_path)
            query = start_split_detail(raw, sinks, other, checkpoint, interval=when, name="detail")
        else:
            query = start_detail(raw, sinks, checkpoint, interval=when, name="detail")
        queries.append(query)
    if sinks := count_sinks(args):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", "counts")
        queries.append(
            start_counts(
                raw,
                sinks,
                f"{args.checkpoint}/counts",
                interval=interval(args),
                name="counts",
                state_partitions=args.state_partitions,
                rows_per_task=args.rows_per_task,
            )
        )
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    if not queries:
        parser.error("name at least one place for details or counts")
    try:
        await_all(queries)
    finally:
        if log is not None:
            for query in queries:
                log.wait(query)
            spark.streams.removeListener(log)


if __name__ == "__main__":
    main()
