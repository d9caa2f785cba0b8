"""Raw message rows to typed rows, and typed rows back to messages.

All functions work on batch and on streaming frames and need no shuffle.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.functions.json_text import (
    if_bad,
    is_json,
    key_columns,
    key_struct,
    marked_struct,
    message_struct,
    parsed_cleanly,
    record_text,
    without_mark,
)
from turnout.functions.schema import DETAIL_FIELDS


def message_text(raw: DataFrame, *carry: str) -> DataFrame:
    """``value`` as text (it is binary from a topic) and ``timestamp`` as timestamp."""
    return raw.select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        *carry,
    )


def parse_messages(raw: DataFrame, *carry: str) -> DataFrame:
    """The nine message fields, ``timestamp`` and the columns of ``raw`` named in ``carry``.

    No row is dropped: a malformed message becomes a row of NULLs, or keeps what was read
    before the fault.
    """
    return (
        message_text(raw, *carry)
        .select(message_struct(F.col("value")).alias("message"), "timestamp", *carry)
        .select("message.*", "timestamp", *carry)
    )


def flatten_detail(parsed: DataFrame, *carry: str) -> DataFrame:
    """The 22 detail columns, then ``carry``; the topics stay one array column."""
    return parsed.select(*DETAIL_FIELDS, *carry)


def group_keys(raw: DataFrame, *carry: str) -> DataFrame:
    """The seven group keys, equal to those of ``flatten_detail(parse_messages(raw))``,
    and the columns of ``raw`` named in ``carry``.

    Only the key fields are parsed. Where that parser meets malformed text, the row is
    parsed again with the whole schema, so that detail and counts agree on every message.
    """
    return (
        raw.select(F.col("value").cast("string").alias("value"), *carry)
        .select("value", key_struct(F.col("value")).alias("keys"), *carry)
        .select("keys", if_bad("keys", message_struct(F.col("value"))).alias("whole"), *carry)
        .select(*key_columns("keys", "whole"), *carry)
    )


def encode_records(frame: DataFrame) -> DataFrame:
    """Each row as one JSON message in a binary ``value`` column, without a key."""
    return frame.select(record_text().cast("binary").alias("value"))


def judged_lines(lines: DataFrame) -> DataFrame:
    """Feed lines as text, and ``is_json``: whether the whole line is JSON."""
    text = F.col("value").cast("string")
    return lines.select(text.alias("value"), is_json(text).alias("is_json"))


def good_lines(judged: DataFrame) -> DataFrame:
    """Judged lines that are JSON, unchanged, as a binary ``value`` column."""
    return judged.filter("is_json").select(F.col("value").cast("binary").alias("value"))


def bad_lines(judged: DataFrame) -> DataFrame:
    """The other judged lines, as text; with ``good_lines`` they are all lines."""
    return judged.filter("not is_json").select("value")


def feed_records(lines: DataFrame) -> DataFrame:
    """``good_lines`` of feed lines."""
    return good_lines(judged_lines(lines))


def rejected_lines(lines: DataFrame) -> DataFrame:
    """``bad_lines`` of feed lines."""
    return bad_lines(judged_lines(lines))


def split_messages(raw: DataFrame, *carry: str) -> DataFrame:
    """Each message parsed once: ``message``, ``is_clean``, its text ``value``, ``timestamp`` and the
    columns of ``raw`` named in ``carry``.

    Clean messages parse as the whole schema declares. Others are cut off, are no object, have a
    field of another shape, or are empty or NULL; what could be read of them is in ``message``.
    """
    # As the one element of an array that is exploded, so that no filter on the message is moved
    # below the parser, where it, and each field that is read, would parse the text again.
    parsed = F.explode(F.array(marked_struct(F.col("value")))).alias("message")
    return (
        message_text(raw, *carry)
        .select(parsed, "value", "timestamp", *carry)
        .select(
            without_mark("message").alias("message"),
            parsed_cleanly("message").alias("is_clean"),
            "value",
            "timestamp",
            *carry,
        )
    )


def clean_messages(split: DataFrame, *carry: str) -> DataFrame:
    """What ``parse_messages`` gives of the clean messages."""
    return split.filter("is_clean").select("message.*", "timestamp", *carry)


def malformed_messages(split: DataFrame, *carry: str) -> DataFrame:
    """Text and time of the other messages; with ``clean_messages`` they are all."""
    return split.filter("not is_clean").select("value", "timestamp", *carry)
