"""Incremental models: high-water scans and the three ways to fold a delta into a target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.load import append_rows, upsert_latest
from tidemark.operators.sizing import BROADCAST_MAX_ROWS, fits

Keys = str | Sequence[str]


def high_water(target: DataFrame, column: str = "dwh_load_date") -> DataFrame:
    """One-row DataFrame with the target's greatest ``column`` (NULL when empty)."""
    return target.select(F.max(column).alias("high_water"))


def after_high_water(source: DataFrame, target: DataFrame | None, column: str = "dwh_load_date", *,
                     eager: bool = True, mark=None) -> DataFrame:
    """Source rows strictly above the target's high-water mark.

    ``eager=True`` reads the mark first (one aggregation job returning one
    value) and filters on it as a literal: the filter reaches the Parquet
    scan's row-group statistics and partition pruning, and every retry uses
    the same mark.  ``eager=False`` keeps it an uncorrelated scalar subquery
    inside the plan (also pushed to the scan).  An empty (or missing) target
    loads everything.  A ``mark`` already known to the caller (e.g. read from
    the newest partition of a log table) is used as is.
    """
    if mark is not None:
        return source.filter(F.col(column) > _literal(mark, source.schema[column].dataType))
    if target is None:
        return source
    if eager:
        mark = target.agg(F.max(column).alias("m")).first()["m"]
        if mark is None:
            return source
        return source.filter(F.col(column) > _literal(mark, target.schema[column].dataType))
    mark = target.select(F.max(column)).scalar()
    return source.filter(mark.isNull() | (F.col(column) > mark))


def _literal(value, dtype) -> F.Column:
    """A literal of the column's exact type (wall-clock timestamps go through text, never a time zone)."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(dtype)
    return F.lit(value).cast(dtype)


def merge_by_key(target: DataFrame | None, source: DataFrame, key: Keys,
                 column: str = "dwh_load_date") -> DataFrame:
    """Incremental *merge*: rows above the high-water mark replace rows with the same key."""
    delta = after_high_water(source, target, column)
    return upsert_latest(target, delta, key)


def append_new(target: DataFrame | None, source: DataFrame, column: str = "dwh_load_date") -> DataFrame:
    """Incremental *append*: rows above the high-water mark are appended (keys unchecked)."""
    return append_rows(target, after_high_water(source, target, column))


def replace_by_key(target: DataFrame | None, batch: DataFrame, key: Keys, *,
                   max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Incremental *delete+insert*: every target row whose key is in the batch is replaced
    by all batch rows of that key (batch duplicates are kept)."""
    keys = [key] if isinstance(key, str) else list(key)
    if target is None:
        return batch
    bk = batch.select(*keys).distinct()
    bk = F.broadcast(bk) if fits(bk, max_broadcast_rows) else bk
    return target.join(bk, keys, "left_anti").select(*target.columns).unionByName(batch.select(*target.columns))
