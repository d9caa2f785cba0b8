"""Queries over the newest micro-batch of the count table.

The table holds changes: the newest batch has the groups that changed last, with their
running totals. Equal counts are ordered by the keys, so a cut is always the same.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnout.functions.json_text import record_text
from turnout.functions.schema import KEYS

# The columns of the table on the dashboard, in name order.
GRID_COLUMNS = (
    "batch_id",
    "group_city",
    "group_country",
    "group_lat",
    "group_lon",
    "group_state",
    "response",
    "response_count",
)

# Response that goes to each bar.
BARS = {"yes_response_count": "yes", "no_response_count": "no"}


def max_batch(table: DataFrame) -> DataFrame:
    """The id of the newest batch, as one row; NULL if the table is empty."""
    return table.agg(F.max("batch_id").alias("max_batch_id"))


def newest_batch(table: DataFrame) -> DataFrame:
    """All rows of the newest batch.

    The id is a scalar subquery: on a table partitioned by ``batch_id`` it prunes the
    scan to one partition. A semi join would read the whole table.
    """
    return table.filter(F.col("batch_id") == max_batch(table).scalar())


def ranking() -> list[Column]:
    return [F.desc("response_count"), *(F.asc_nulls_last(name) for name in KEYS)]


def top_groups(newest: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` rows with the largest counts, all columns."""
    return newest.orderBy(*ranking()).limit(n)


def yes_no_counts(newest: DataFrame, n: int = 10, collation: str | None = None) -> DataFrame:
    """The same rows as :func:`top_groups`, with the count under its response.

    Responses are compared by their bytes, or under a ``collation``: with UTF8_LCASE, ``YES`` is
    counted as ``yes``. It changes no key and no order.
    """
    response_of = F.col("response")
    if collation is not None:
        response_of = F.collate(response_of, collation)
    bars = [
        F.when(response_of == response, F.col("response_count")).otherwise(0).alias(name)
        for name, response in BARS.items()
    ]
    return top_groups(newest, n).select("group_name", *bars)


def grid(rows: DataFrame) -> DataFrame:
    return rows.select(*GRID_COLUMNS)


def bar_series(bars: DataFrame) -> DataFrame:
    """One row per group and bar: ``group_name``, ``series``, ``y``."""
    return bars.unpivot("group_name", list(BARS), "series", "y")


def head_rows(newest: DataFrame, n: int = 5) -> DataFrame:
    return top_groups(newest, n)


def json_records(rows: DataFrame) -> DataFrame:
    """Each row as JSON text, NULLs written out."""
    return rows.select(record_text().alias("record"))


def with_refresh_time(rows: DataFrame, time: Column | None = None) -> DataFrame:
    """The rows and the time of the refresh as text: now, or the given timestamp."""
    time = F.current_timestamp() if time is None else time
    return rows.withColumn("refreshed_at", F.date_format(time, "yyyy-MM-dd HH:mm:ss"))
