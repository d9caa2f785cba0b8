"""Response counts per group."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnout.functions.schema import KEYS


def response_counts(keys: DataFrame) -> DataFrame:
    """Rows per group with a response. A NULL key is a key; a NULL response counts 0.

    Spark counts within each task before the shuffle, so a group that holds a large part
    of the rows sends one row per task, not its rows. On a stream the result is the
    running total, kept in the state store.
    """
    return keys.groupBy(*KEYS).agg(F.count("response").alias("response_count"))


def count_changelog(keys: DataFrame) -> DataFrame:
    """What a stream in update mode writes, from a batch frame that has ``batch_id``.

    One row per group and batch that touched it, with the running total. The window runs
    over counted rows: a group has at most one row per batch in it.
    """
    per_batch = keys.groupBy(*KEYS, "batch_id").agg(F.count("response").alias("in_batch"))
    so_far = (
        Window.partitionBy(*KEYS)
        .orderBy("batch_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return per_batch.select(
        *KEYS, F.sum("in_batch").over(so_far).alias("response_count"), "batch_id"
    )


def current_counts(table: DataFrame) -> DataFrame:
    """The last total of each group in a table of changes, and the batch that brought it.

    A total is chosen by its batch, not by its size, so it is also right where totals start again.
    Counted within each task first: a group sends one row per task. A batch that was written
    again changes nothing.
    """
    last = F.max_by("response_count", "batch_id").alias("response_count")
    return table.groupBy(*KEYS).agg(last, F.max("batch_id").alias("batch_id"))
