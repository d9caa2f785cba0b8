"""Sinks: functions of one micro-batch and its id, for ``foreachBatch``."""

from collections.abc import Callable
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from turnout.operators.messages import encode_records, good_lines
from turnout.sources.results import NEWEST, NEWEST_PROPERTY, newest_note

Sink = Callable[[DataFrame, int], None]


def with_batch_id(batch: DataFrame, batch_id: int) -> DataFrame:
    return batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def in_even_files(batch: DataFrame, even_files: bool) -> DataFrame:
    """Shuffle the batch, if asked to, so that AQE merges and splits its tasks by size."""
    return batch.hint("rebalance") if even_files else batch


def table_sink(
    path: str,
    file_format: str = "parquet",
    *,
    even_files: bool = False,
    mark_newest: bool = False,
) -> Sink:
    """Append to files, one partition per batch. A batch written again replaces itself.

    ``even_files`` is for detail rows that come in many small or a few large tasks.
    ``mark_newest`` notes the id of the batch for ``marked_newest_batch``, after its rows
    are there. The note goes to the place of two that does not hold the last one, so a
    reader always finds one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            with_batch_id(in_even_files(batch, even_files), batch_id)
            .write.format(file_format)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .save(path)
        )
        if mark_newest:
            spark = batch.sparkSession
            last = newest_note(spark, path)
            place = 1 - last.place if last else 0
            note = spark.range(batch_id, batch_id + 1, 1, 1)
            note.write.mode("overwrite").json(f"{path}/{NEWEST}/place={place}")

    return write


def catalog_sink(
    table: str, ddl: str, file_format: str = "parquet", *, even_files: bool = False
) -> Sink:
    """Like :func:`table_sink`, into a catalog table of the columns ``ddl``.

    The id of the batch becomes a property of the table once its rows are there, so a reader
    finds the files of that batch alone; use it where batches are many.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING {file_format} "
            "PARTITIONED BY (batch_id)"
        )
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (batch_id = {int(batch_id)}) "
            "SELECT * FROM {batch}",
            batch=in_even_files(batch, even_files),
        )
        note = f"'{NEWEST_PROPERTY}' = '{int(batch_id)}'"
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({note})")

    return write


def document_sink(connector: str = "mongodb", **options: str) -> Sink:
    """Append documents through a connector, nested fields kept.

    At least once: a batch that is written again after a failure adds its rows again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            with_batch_id(batch, batch_id)
            .write.format(connector)
            .mode("append")
            .options(**options)
            .save()
        )

    return write


def database_sink(
    url: str, table: str, *, connections: int = 8, connector: str = "jdbc", **options: str
) -> Sink:
    """Append to a database table over at most ``connections`` connections.

    At least once: ``database_newest_batch`` removes what a repeated batch adds.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            with_batch_id(batch, batch_id)
            .write.format(connector)
            .mode("append")
            .option("url", url)
            .option("dbtable", table)
            .option("numPartitions", connections)
            .options(**options)
            .save()
        )

    return write


def lines_sink(servers: str, topic: str, connector: str = "kafka", **options: str) -> Sink:
    """Publish judged feed lines that are JSON as they are. At least once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            good_lines(batch)
            .write.format(connector)
            .mode("append")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .options(**options)
            .save()
        )

    return write


def topic_sink(servers: str, topic: str, connector: str = "kafka", **options: str) -> Sink:
    """Publish each row as one JSON message without a key. At least once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            encode_records(batch)
            .write.format(connector)
            .mode("append")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .options(**options)
            .save()
        )

    return write


def console_sink(rows: int = 20, truncate: bool = False) -> Sink:
    """Print the first rows of the batch. It reads only these: use it within a fan-out."""

    def write(batch: DataFrame, batch_id: int) -> None:
        print(f"Batch: {batch_id}")
        batch.show(rows, truncate=truncate)

    return write


def fan_out(*sinks: Sink, rows_per_task: int | None = None) -> Sink:
    """One sink that gives a batch to several, computing it once.

    The batch is persisted and counted first: it is computed in full parallel and all of
    its state is committed, whatever part of the rows a sink reads. By its row count, the
    sinks then get it in fewer partitions of at most about ``rows_per_task`` rows, so that
    a small batch does not leave one file or open one connection per part of the state.
    An empty batch is not passed on.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = batch.count()
            if rows == 0:
                return
            parts = batch
            if rows_per_task is not None:
                parts = batch.coalesce(ceil(rows / rows_per_task))
            for sink in sinks:
                sink(parts, batch_id)
        finally:
            batch.unpersist()

    return write
