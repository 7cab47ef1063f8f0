"""Broadcast only behind a checked size bound.

``fits(df)`` counts the rows (for a stored table that is a matter of file footers) and, if
they are few, measures the bytes of their values.  No row reaches the driver and no
session setting changes, so checks may run in several threads.  A side that passes is
broadcast; one that does not is joined by a shuffle, which AQE may still turn into a
broadcast at run time if its measured size allows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default bounds for broadcasting a lookup side, in rows and in bytes of their values.
BROADCAST_MAX_ROWS = 100_000
BROADCAST_MAX_BYTES = 64 << 20


def _width(field: T.StructField) -> Column:
    """Bytes of a column's value (16 for those of fixed width; nested ones by their text)."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return F.lit(16)


def fits(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows of at most ``max_bytes`` bytes in all."""
    if df.count() > max_rows:
        return False
    if not any(isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)) for f in df.schema):
        return True
    total = df.agg(F.sum(reduce(lambda a, b: a + b, [_width(f).cast("long") for f in df.schema])).alias("b")).first()["b"]
    return (total or 0) <= max_bytes


def lookup_join(left: DataFrame, right: DataFrame, on, how: str = "left",
                max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join ``left`` to a lookup table, broadcasting it when its size is proven small."""
    if fits(right, max_rows):
        return left.join(F.broadcast(right), on, how)
    return left.join(right, on, how)
