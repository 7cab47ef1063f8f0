"""Latest state per key, overlays, state replay and eligibility.

``latest_by_key`` is an aggregation (``max_by`` over a struct), not a window:
it aggregates map-side before the shuffle, so a key with a billion change
events sends one row per map task, not a billion.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.scan import SEG, plan_segments
from tidemark.sources.tables import materialize

Keys = str | Sequence[str]


def _keys(k: Keys) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_by_key(df: DataFrame, key: Keys, order, *, tiebreak: Sequence = (),
                  nulls_first: bool = True) -> DataFrame:
    """One row per key: the row with the greatest ``order``.

    ``nulls_first=True`` follows ``ORDER BY order DESC`` of Postgres (NULL
    sorts first, so a NULL ``order`` wins).  Ties go to the greatest
    ``tiebreak`` values; give a unique tiebreak for a deterministic pick.
    """
    keys = _keys(key)
    o = _col(order)
    rank = [o.isNull() if nulls_first else o.isNotNull(), o, *[_col(t) for t in tiebreak]]
    cols = list(df.columns)
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*cols), F.struct(*rank)).alias("_row"))
            .select(*[F.col(f"_row.{c}").alias(c) for c in cols]))


def overlay_latest(base: DataFrame, latest: DataFrame, key: Keys,
                   columns: Mapping[str, str]) -> DataFrame:
    """``base`` LEFT JOIN ``latest`` on key; each ``base_col`` becomes
    COALESCE(latest[latest_col], base_col) for ``columns = {base_col: latest_col}``."""
    keys = _keys(key)
    lat = latest.select(*keys, *[F.col(lc).alias(f"_new_{bc}") for bc, lc in columns.items()])
    joined = base.join(lat, keys, "left")
    out = [F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c)
           for c in base.columns]
    return joined.select(*out)


def state_as_of(base: DataFrame, key: Keys, before, *, additions: DataFrame | None = None,
                changes: DataFrame | None = None, batch_col: str = "batch_date",
                change_columns: Mapping[str, str] | None = None,
                addition_order: Sequence[str] = (), change_order: Sequence[str] = ()) -> DataFrame:
    """Entity state folded from all batches strictly before ``before``.

    ``base`` rows (the seed) are replaced by ``additions`` rows of later batches
    (latest batch wins, then the greatest ``addition_order``); then the latest
    change of an earlier batch (ties: greatest ``change_order``) overwrites
    ``change_columns`` (``{entity_col: change_col}``) unless the entity row came
    from a later batch.  A change in the same batch as the row applies, as
    changes are folded after the batch's new rows.
    """
    keys = _keys(key)
    cutoff = before if isinstance(before, Column) else F.lit(before)
    cols = list(base.columns)
    btype = _batch_type(additions, changes, batch_col)
    order_names = [f"_ao{i}" for i in range(len(addition_order))]
    rows = base.select(*cols, F.lit(None).cast(btype).alias(batch_col),
                       *[F.lit(None).cast(additions.schema[c].dataType).alias(n)
                         for c, n in zip(addition_order, order_names)])
    if additions is not None:
        rows = rows.unionByName(additions.filter(F.col(batch_col) < cutoff).select(
            *cols, batch_col, *[F.col(c).alias(n) for c, n in zip(addition_order, order_names)]))
    current = latest_by_key(rows, keys, batch_col, tiebreak=order_names, nulls_first=False).drop(*order_names)
    if changes is None or not change_columns:
        return current.drop(batch_col)
    ch = changes.filter(F.col(batch_col) < cutoff)
    last = latest_by_key(ch, keys, batch_col, tiebreak=list(change_order), nulls_first=False)
    last = last.select(*keys, F.col(batch_col).alias("_cb"),
                       *[F.col(cc).alias(f"_new_{ec}") for ec, cc in change_columns.items()])
    joined = current.join(last, keys, "left")
    applies = F.col("_cb").isNotNull() & (F.col(batch_col).isNull() | (F.col("_cb") >= F.col(batch_col)))
    out = [F.when(applies, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in change_columns else F.col(c)
           for c in cols]
    return joined.select(*out)


def _batch_type(additions, changes, batch_col):
    for df in (additions, changes):
        if df is not None and batch_col in df.columns:
            return df.schema[batch_col].dataType
    return "date"


def eligible(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, *,
             child_filter: Column | None = None, parent_filter: Column | None = None) -> DataFrame:
    """Child rows (optionally filtered) whose parent exists and passes ``parent_filter`` (semi join)."""
    c = child if child_filter is None else child.filter(child_filter)
    p = parent if parent_filter is None else parent.filter(parent_filter)
    p = p.select(F.col(parent_key).alias("_pk"))
    return c.join(p, c[child_key] == p["_pk"], "left_semi")


def number_within_key(df: DataFrame, key: Keys, order: Sequence[str], *, out: str = "ordinal",
                      count_out: str | None = "group_size", method: str = "scan", **seg_opts) -> DataFrame:
    """Ordinal (1..n) of each row within its key in ``order``, and the key's row count.

    The per-key listing the reference builds in memory ("cards of an account")
    is expressed as numbered rows instead of a collected array, so no group is
    ever held in one row.  Hot keys are cut into segments: a row's ordinal is
    its number inside the segment plus the row count of earlier segments, and
    the key's count is the sum over its segments (a bounded table).  Cold keys
    get both from the one window over the key, without any join.

    ``method="sort"`` handles keys whose rows share the first order value (the
    scan cannot cut those): a global range sort over key and all order
    columns (the range partitioner splits a hot key wherever its order
    values differ), global row indexes from per-partition counts, and each
    key's first index from a partial aggregation joined back.  One more
    shuffle and a write than the scan.
    """
    keys = _keys(key)
    if method == "sort":
        return _number_by_sort(df, keys, order, out, count_out)
    if method != "scan":
        raise ValueError(f"unknown method {method!r}")
    segs = plan_segments(df, keys, order[0], **seg_opts)
    rows = segs.assign(df)
    w = Window.partitionBy(*keys, SEG).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    whole = Window.partitionBy(*keys, SEG)
    rows = rows.withColumn("_local", F.row_number().over(w).cast("long")) \
               .withColumn("_segn", F.count(F.lit(1)).over(whole))
    if segs.splits is None:
        rows = rows.withColumn(out, F.col("_local")).withColumn("_total", F.col("_segn"))
    else:
        hot = rows.join(segs.splits.select(*keys), keys, "left_semi")
        seg_sizes = hot.groupBy(*keys, SEG).agg(F.count(F.lit(1)).alias("_sz"))
        before = Window.partitionBy(*keys).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
        every = Window.partitionBy(*keys)
        # One row per hot segment, stored so that its size decides the join.
        offsets = materialize(seg_sizes.select(*keys, SEG, F.coalesce(F.sum("_sz").over(before), F.lit(0)).alias("_off"),
                                   F.sum("_sz").over(every).alias("_keyn")), "segment-offsets")
        rows = (rows.join(offsets, [*keys, SEG], "left")
                .withColumn(out, F.col("_local") + F.coalesce(F.col("_off"), F.lit(0)))
                .withColumn("_total", F.coalesce(F.col("_keyn"), F.col("_segn"))))
    if count_out:
        rows = rows.withColumn(count_out, F.col("_total").cast("long"))
    return rows.drop("_local", "_segn", "_off", "_keyn", "_total", SEG)


def _number_by_sort(df: DataFrame, keys: list[str], order: Sequence[str], out: str,
                    count_out: str | None) -> DataFrame:
    cols = list(df.columns)
    indexed = next_ids(df, -1, [*keys, *order], out="_g")            # global index 0, 1, 2, ...
    bounds = indexed.groupBy(*keys).agg(F.min("_g").alias("_start"), F.count(F.lit(1)).alias("_size"))
    from tidemark.operators.sizing import fits
    bounds = F.broadcast(bounds) if fits(bounds) else bounds
    joined = indexed.join(bounds, keys, "left")
    extra = [(F.col("_g") - F.col("_start") + 1).alias(out)]
    if count_out:
        extra.append(F.col("_size").alias(count_out))
    return joined.select(*cols, *extra)


def next_ids(df: DataFrame, start: Column | int, order: Sequence[str], *, out: str = "new_id") -> DataFrame:
    """Consecutive numbers ``start + 1, start + 2, ...`` in ``order`` over the whole DataFrame.

    No single-partition window: rows are range-sorted, each row is tagged with
    its sorted partition and position, and that result is written once to the
    shared checkpoint folder (so recomputation cannot reshuffle it); the
    per-partition counts give each partition's offset, and a row's number is
    offset + its position inside the partition.
    """
    ranked = materialize(df.orderBy(*[F.col(c).asc_nulls_first() for c in order])
                         .withColumn("_p", F.spark_partition_id())
                         .withColumn("_mid", F.monotonically_increasing_id()), "next-ids")
    parts = ranked.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: a bounded table (partition count), broadcast back.
    offsets = parts.select("_p", "_m0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    base = start if isinstance(start, Column) else F.lit(start)
    return (ranked.join(F.broadcast(offsets), "_p")
            .withColumn(out, (base + F.col("_off") + (F.col("_mid") - F.col("_m0")) + 1).cast("long"))
            .drop("_p", "_mid", "_m0", "_off"))
