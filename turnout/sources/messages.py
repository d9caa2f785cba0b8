"""Message sources. Each gives ``value`` and ``timestamp``, as a stream or as a batch.

The rate of a stream is bounded with the reader's own options: ``maxOffsetsPerTrigger``
for a topic, ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` for files.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    *,
    streaming: bool = True,
    starting_offsets: str | None = None,
    connector: str = "kafka",
    **options: str,
) -> DataFrame:
    """Messages of a topic.

    A new stream starts at ``latest`` unless told otherwise; on a restart the checkpoint
    decides. A batch starts at ``earliest``, as it cannot start at ``latest``.
    """
    if starting_offsets is None:
        starting_offsets = "latest" if streaming else "earliest"
    reader = spark.readStream if streaming else spark.read
    rows = (
        reader.format(connector)
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
    )
    return rows.select("value", "timestamp")


def file_messages(
    spark: SparkSession,
    path: str,
    *,
    streaming: bool = True,
    file_format: str = "parquet",
    **options: str | int,
) -> DataFrame:
    """Messages kept as files with the columns ``value`` and ``timestamp``."""
    reader = spark.readStream if streaming else spark.read
    return (
        reader.format(file_format)
        .schema("value BINARY, timestamp TIMESTAMP")
        .options(**options)
        .load(path)
    )


def feed_lines(
    spark: SparkSession, path: str, *, streaming: bool = True, **options: str | int
) -> DataFrame:
    """A landed feed: text files with one JSON message per line.

    The modification time of the file stands for the time of the message.
    """
    reader = spark.readStream if streaming else spark.read
    return (
        reader.format("text")
        .options(**options)
        .load(path)
        .select("value", F.col("_metadata.file_modification_time").alias("timestamp"))
    )
