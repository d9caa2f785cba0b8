"""From raw messages to the rows of the two result tables."""

from pyspark.sql import DataFrame

from turnout.operators.counts import response_counts
from turnout.operators.messages import flatten_detail, group_keys, parse_messages


def detail_of(raw: DataFrame) -> DataFrame:
    """The 22 detail columns of each message."""
    return flatten_detail(parse_messages(raw))


def counts_of(raw: DataFrame) -> DataFrame:
    """The response count of each group."""
    return response_counts(group_keys(raw))
