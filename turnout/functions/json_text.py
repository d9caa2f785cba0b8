"""JSON text to typed columns and back."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnout.functions.schema import KEY_FIELDS, KEY_MESSAGE_DDL, MESSAGE_DDL, leaf

_BAD = "_turnout_bad_text"


def message_struct(text: Column, ddl: str = MESSAGE_DDL) -> Column:
    """Parse one message. Malformed text gives NULL fields; unknown fields are ignored."""
    return F.from_json(text, ddl)


def key_struct(text: Column) -> Column:
    """Parse only the key fields and mark text that did not parse cleanly.

    A parser with fewer fields skips more of the text, so on malformed text it may keep
    other fields than the whole-message parser: pair it with :func:`key_columns`. On
    well-formed text both agree, with Spark's default of partial results for JSON.
    """
    return marked_struct(text, KEY_MESSAGE_DDL)


def marked_struct(text: Column, ddl: str = MESSAGE_DDL) -> Column:
    """Parse one message as :func:`message_struct` does, and keep text that did not parse cleanly
    in a last field."""
    return F.from_json(text, f"{ddl}, {_BAD} STRING", {"columnNameOfCorruptRecord": _BAD})


def parsed_cleanly(struct: str) -> Column:
    """Whether the struct column of :func:`marked_struct` is of a whole message. Empty text and NULL
    are none."""
    return F.col(struct).isNotNull() & F.col(f"{struct}.{_BAD}").isNull()


def without_mark(struct: str) -> Column:
    return F.col(struct).dropFields(_BAD)


def if_bad(keys: str, value: Column) -> Column:
    """``value`` where the struct column ``keys`` was parsed from malformed text, or NULL."""
    return F.when(F.col(f"{keys}.{_BAD}").isNotNull(), value)


def key_columns(keys: str, whole: str) -> list[Column]:
    """Key columns from ``keys``, or from ``whole`` where the text was malformed."""
    clean = F.col(f"{keys}.{_BAD}").isNull()
    return [
        F.when(clean, F.col(f"{keys}.{path}")).otherwise(F.col(f"{whole}.{path}")).alias(leaf(path))
        for path in KEY_FIELDS
    ]


def is_json(text: Column) -> Column:
    """True where the whole text is one JSON value, nested up to 1,000 levels.

    Spark's readers stop after the first value. Here the text is the only element of an array
    and the only member of an object: text that ends early must close the array or the object,
    and no text closes both. Digits beyond the fortieth of a run decide nothing, and
    readers refuse numbers of over 1,000, so they are left out. Spark's readers also take text in
    single quotes, which strict ones refuse: such a quote outside of strings is looked for.
    """
    strings = r'"(?:[^"\\]|\\.)*+"'
    outside = F.when(F.contains(text, F.lit("'")), F.regexp_replace(text, strings, ""))
    quoted = F.coalesce(F.contains(outside, F.lit("'")), F.lit(False))
    short = F.regexp_replace(text, "([0-9]{40})[0-9]+", "$1")
    element = F.json_array_length(F.concat(F.lit("["), short, F.lit("]")))
    members = F.json_object_keys(F.concat(F.lit('{"x":'), short, F.lit("}")))
    return F.coalesce(~quoted & (element == 1) & (F.size(members) == 1), F.lit(False))


def record_text(*columns: str, keep_nulls: bool = True) -> Column:
    """One JSON object per row, UTF-8 text, fields in column order."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return F.to_json(F.struct(*(columns or ("*",))), options)
