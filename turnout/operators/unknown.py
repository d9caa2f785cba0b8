"""Fields of messages that the declared schema does not know, read as VARIANT.

All functions work on batch and on streaming frames and need no shuffle. Text that is no JSON, and
an object with a repeated key, is no variant: it has no fields here.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from turnout.functions.schema import MESSAGE_DDL

_MAP = "map<string, variant>"


def variant_messages(raw: DataFrame, *carry: str) -> DataFrame:
    """Each message as one VARIANT column ``message``, NULL where it is none."""
    text = F.col("value").cast("string")
    return raw.select(F.try_parse_json(text).alias("message"), *carry)


def variant_fields(raw: DataFrame, fields: Mapping[str, tuple[str, str]], *carry: str) -> DataFrame:
    """Columns of chosen fields: ``fields`` has the path (``$.a.b[0]``) and the type of each.

    NULL where a message has no such field, or a value that is not of the type.
    """
    columns = [
        F.try_variant_get("message", path, kind).alias(name) for name, (path, kind) in fields.items()
    ]
    return variant_messages(raw, *carry).select(*columns, *carry)


def _objects(values: Column) -> Column:
    """The objects among an array of variants, as maps."""
    maps = F.transform(values, lambda v: F.try_variant_get(v, "$", _MAP))
    return F.filter(maps, lambda m: m.isNotNull())


def _below(kind: DataType) -> StructType | None:
    """The struct that a field holds, or the elements of its array."""
    while isinstance(kind, ArrayType):
        kind = kind.elementType
    return kind if isinstance(kind, StructType) else None


def _unknown(objects: Column, schema: StructType, path: str) -> list[Column]:
    """Arrays of (path, value) for the unknown fields of the objects and of those within them."""
    known = schema.names
    found = F.flatten(
        F.transform(
            objects,
            lambda m: F.transform(
                F.filter(F.map_entries(m), lambda e: ~e["key"].isin(known)),
                lambda e: F.struct(F.concat(F.lit(path), e["key"]).alias("path"), e["value"].alias("value")),
            ),
        )
    )
    columns = [found]
    for field in schema:
        inner = _below(field.dataType)
        if inner is None:
            continue
        name = field.name
        values = F.transform(objects, lambda m: F.try_element_at(m, F.lit(name)))
        if isinstance(field.dataType, ArrayType):
            arrays = F.transform(values, lambda v: F.try_variant_get(v, "$", "array<variant>"))
            values = F.flatten(F.filter(arrays, lambda a: a.isNotNull()))
            name += "[]"
        columns += _unknown(_objects(values), inner, f"{path}{name}.")
    return columns


def unknown_fields(raw: DataFrame, *carry: str, ddl: str = MESSAGE_DDL) -> DataFrame:
    """One row per field that ``ddl`` does not know: ``path``, ``kind`` (its type) and ``value``, its
    JSON text, and the columns of ``raw`` named in ``carry``.

    Fields at the top, within declared structs and within the elements of declared arrays
    (``group.group_topics[].x``) are found. What lies within an unknown field is part of its value.
    """
    schema = StructType.fromDDL(ddl)
    objects = _objects(F.array("message"))
    found = F.concat(*_unknown(objects, schema, ""))
    rows = variant_messages(raw, *carry).select(F.explode(found).alias("field"), *carry)
    return rows.select(
        F.col("field.path").alias("path"),
        F.schema_of_variant("field.value").alias("kind"),
        F.to_json("field.value").alias("value"),
        *carry,
    )


def unknown_paths(fields: DataFrame) -> DataFrame:
    """How many times each unknown path came with each type; decimals of all widths are one."""
    kind = F.regexp_replace("kind", r"DECIMAL\([0-9]+,[0-9]+\)", "DECIMAL")
    return fields.groupBy("path", kind.alias("kind")).agg(F.count("*").alias("fields"))
