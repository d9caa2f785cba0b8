"""The running totals that a counting query keeps, read back from its checkpoint."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout.functions.schema import KEYS


def state_counts(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """``response_counts`` of all messages up to the newest micro-batch, or up to ``batch_id``, from
    the state of ``start_counts``.

    One task per part of the state; no message and no row of the count table is read. The query may
    run meanwhile. Batches go back as far as the checkpoint keeps them
    (``spark.sql.streaming.minBatchesToRetain``).
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    # The state's own names: the keys of the grouping, and one field for its one aggregate.
    total = state.schema["value"].dataType.names[0]
    columns = [F.col(f"key.{name}").alias(name) for name in KEYS]
    return state.select(*columns, F.col(f"value.{total}").alias("response_count"))


def state_partitions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Groups in each part of the state: ``partition_id`` and ``n_groups``."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.groupBy("partition_id").agg(F.count("*").alias("n_groups"))
