"""Bronze loads: stamp, key enforcement, upsert (latest wins) and insert-if-absent (first wins).

A target is a DataFrame (``None`` = empty); each operator returns the *new*
target, which the caller writes to a fresh version folder
(:func:`tidemark.sources.tables.publish`).  Nothing overwrites a path being read.

The batch is the small side of every load.  Its keys are broadcast when their
count is proven small (:func:`tidemark.operators.sizing.fits`), so the large
target is streamed once, without a shuffle; otherwise both sides shuffle on the
key.  Keys are unique on both sides, so no key can be skewed.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sizing import BROADCAST_MAX_ROWS, fits

Keys = str | Sequence[str]
_EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)


class DuplicateKeyError(ValueError):
    """A batch or snapshot source holds a key twice, or a NULL key."""


def _keys(k: Keys) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def utc(run_ts: _dt.datetime) -> _dt.datetime:
    """The run clock as an aware UTC instant; a naive clock is read as UTC, whatever the machine's zone."""
    return run_ts.replace(tzinfo=_dt.timezone.utc) if run_ts.tzinfo is None else run_ts.astimezone(_dt.timezone.utc)


def clock(run_ts: _dt.datetime) -> Column:
    """The run clock as a timestamp literal that no time zone moves."""
    micros = (utc(run_ts) - _EPOCH) // _dt.timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros).cast("long"))


def from_micros(micros: int | None) -> _dt.datetime | None:
    """The aware UTC instant of ``unix_micros`` (None stays None)."""
    return None if micros is None else _EPOCH + _dt.timedelta(microseconds=micros)


def stamp_load(df: DataFrame, run_ts, column: str = "dwh_load_date") -> DataFrame:
    """Add the load stamp: one value for the whole load (a clock or a column)."""
    return df.withColumn(column, run_ts if isinstance(run_ts, Column) else clock(run_ts))


def duplicate_keys(df: DataFrame, key: Keys) -> DataFrame:
    """Keys seen more than once, and the NULL key if present (with their counts)."""
    keys = _keys(key)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter((F.col("n") > 1) | null_key))


def require_unique(df: DataFrame, key: Keys, what: str = "batch") -> DataFrame:
    """Raise :class:`DuplicateKeyError` if ``df`` has a duplicate or NULL key; return ``df``."""
    bad = duplicate_keys(df, key).take(1)
    if bad:
        raise DuplicateKeyError(f"{what}: key {_keys(key)} not unique or NULL, e.g. {bad[0].asDict()}")
    return df


def inspect_batch(batch: DataFrame, key: Keys, length_cols: Sequence[str] = ()) -> tuple[int, dict | None, dict]:
    """One aggregation job over the batch: number of keys, first duplicate or NULL
    key (or None), and the longest text of each of ``length_cols``."""
    keys = _keys(key)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    per_key = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                       *[F.max(F.char_length(c)).alias(f"_len{i}") for i, c in enumerate(length_cols)])
    bad = F.when((F.col("n") > 1) | null_key, F.struct(*[F.col(k) for k in keys], F.col("n")))
    row = per_key.agg(F.count(F.lit(1)).alias("keys"), F.first(bad, ignorenulls=True).alias("bad"),
                      *[F.max(f"_len{i}").alias(f"_len{i}") for i in range(len(length_cols))]).first()
    lengths = {c: row[f"_len{i}"] for i, c in enumerate(length_cols)}
    return row["keys"], (row["bad"].asDict() if row["bad"] is not None else None), lengths


def text_lengths(batch: DataFrame, columns: Sequence[str]) -> dict[str, int | None]:
    """The longest text of each column, in one aggregation that moves one row a task."""
    row = batch.agg(*[F.max(F.char_length(c)).alias(f"_len{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"_len{i}"] for i, c in enumerate(columns)}


def _checked_keys(batch: DataFrame, keys: list[str], check_unique: bool, max_rows: int,
                  small: bool | None = None) -> tuple[DataFrame, bool]:
    """The batch keys, broadcast when their count is proven small, and whether it is; raises on a bad key.

    Uniqueness and size come from one aggregation job when both are needed;
    ``small`` passes a size already established by the caller.
    """
    k = batch.select(*keys)
    if small is not None and not check_unique:
        return (F.broadcast(k) if small else k), small
    if check_unique:
        n_keys, bad, _ = inspect_batch(batch, keys)
        if bad is not None:
            raise DuplicateKeyError(f"batch: key {keys} not unique or NULL, e.g. {bad}")
        small = n_keys <= max_rows
    else:
        small = fits(k, max_rows)
    return (F.broadcast(k) if small else k), small


def upsert_latest(target: DataFrame | None, batch: DataFrame, key: Keys, *,
                  check_unique: bool = True, max_broadcast_rows: int = BROADCAST_MAX_ROWS,
                  small_batch: bool | None = None) -> DataFrame:
    """INSERT ... ON CONFLICT (key) DO UPDATE: batch rows replace stored rows with the same key."""
    keys = _keys(key)
    if target is None:
        if check_unique:
            require_unique(batch, keys)
        return batch
    probe, _ = _checked_keys(batch, keys, check_unique, max_broadcast_rows, small_batch)
    kept = target.join(probe, keys, "left_anti")
    return kept.select(*target.columns).unionByName(batch.select(*target.columns))


def insert_absent(target: DataFrame | None, batch: DataFrame, key: Keys, *,
                  check_unique: bool = True, max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """INSERT ... ON CONFLICT (key) DO NOTHING: stored rows win; new keys are appended."""
    return append_rows(target, new_rows(target, batch, key, check_unique=check_unique,
                                        max_broadcast_rows=max_broadcast_rows))


def new_rows(target: DataFrame | None, batch: DataFrame, key: Keys, *, check_unique: bool = True,
             max_broadcast_rows: int = BROADCAST_MAX_ROWS, small_batch: bool | None = None) -> DataFrame:
    """Batch rows whose key the target does not hold yet (the part an append writes).

    The target is only probed for keys, scanned once on its key column: few batch keys are
    broadcast to it; a large batch is joined with the target's keys directly, in one shuffle.
    """
    keys = _keys(key)
    if target is None:
        if check_unique:
            require_unique(batch, keys)
        return batch
    probe, small = _checked_keys(batch, keys, check_unique, max_broadcast_rows, small_batch)
    present = target.select(*keys)
    if small:
        present = present.join(probe, keys, "left_semi")
    return batch.join(present, keys, "left_anti").select(*batch.columns)


def append_rows(target: DataFrame | None, rows: DataFrame) -> DataFrame:
    """Incremental append: the target plus new rows (no key check)."""
    if target is None:
        return rows
    return target.unionByName(rows.select(*target.columns))
