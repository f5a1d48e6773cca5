"""A hash of a row that keeps nulls, separators and value borders apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.functions.names import column


def row_hash(columns: Sequence[str]) -> Column:
    """md5 over the columns, taken in name order.

    Joining values with commas and hashing the text to 32 bits would give ('a', null, 'b') and
    ('a', 'b', null) the same value; here each value is written with its length and null as ``~``.
    """
    parts = []
    for name in sorted(columns):
        text = column(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.md5(F.concat_ws("|", *parts))


def row_digest(fields: Sequence[T.StructField]) -> Column:
    """128 bits over the fields, in name order: rows that differ have different digests.

    Unlike a cast to text it keeps apart instants that read alike in the session's time zone, and nested values
    whose parts hold the signs that separate them. Equal values may have different digests (0.0 and -0.0).
    """
    parts = []
    for field in sorted(fields, key=lambda f: f.name):
        value = column(field.name)
        if isinstance(field.dataType, T.TimestampType):
            value = F.unix_micros(value)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false", "timeZone": "UTC", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
            value = F.when(column(field.name).isNotNull(), value)
        elif isinstance(field.dataType, T.BinaryType):
            value = F.hex(value)
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.unhex(F.md5(F.concat_ws("|", *parts)))


def blank_digest(n: int) -> Column:
    """:func:`row_digest` of ``n`` nulls."""
    return F.unhex(F.md5(F.lit("|".join("~" * n))))
