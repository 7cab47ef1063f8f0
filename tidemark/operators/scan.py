"""Skew-safe per-key scans ("last non-NULL value so far" in a key's order).

A window partitioned by key runs each key in one task, so a key holding a
third of all rows would be one task holding a third of the data.  Here a key
whose row count exceeds ``rows_per_segment`` is *hot* and is cut into
contiguous segments of its order column:

1. per-key counts on a Bernoulli sample (one column-pruned aggregation whose
   shuffle shrinks with the sampling fraction) name the candidates, however
   many there are; exact counts, bounds and quantiles follow for those only;
2. for those keys only, ``percentile_approx`` gives quantile bands of the
   order position: about one band per segment a key needs (a power of two,
   at most 1,024); beyond that each band is subdivided evenly, so the number
   of segments follows the key's rows.
   Segment ids are monotone in the order position, so equal positions always
   share a segment (rows with one identical position cannot be split);
3. the window runs per ``(key, segment)``;
4. each segment's last non-NULL value (a partial aggregation) is carried into
   later segments through a table with one row per hot segment.

Cold keys keep segment 0 and need no carry.  Candidates, splits and carries are
written once to the shared checkpoint folder: every stage, and any recomputation
after a lost executor, sees the same segments, and as their size is known Spark
broadcasts them only while that is below its broadcast threshold.  Whether
sampled detection notices a key near the threshold changes how even the tasks
are, never the result: the carry makes each segment see exactly what a single
window would.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.tables import materialize

SEG = "_seg"
POS = "_pos"

# Defaults: rows one task should hold per key segment, quantile bands per hot key
# (at least and at most), and how many rows of a key at the threshold a sample shows.
ROWS_PER_SEGMENT = 4_000_000
BANDS = 1
MAX_BANDS = 1_024
SAMPLE_ROWS = 10_000


def order_position(df: DataFrame, col: str, skip: Column | None = None) -> Column:
    """A long that never decreases with ``col`` (for cutting segments).

    For text, ``skip`` is the number of leading bytes all compared values share.
    """
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        # Values beyond long, infinities and NaN (the greatest) stay at the ends.
        inside = F.least(F.greatest(c.cast("double"), F.lit(-9.2e18)), F.lit(9.2e18))
        return F.floor(inside).cast("long")
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        # 63 bits (7 bytes and the top 7 bits of the 8th) after the shared
        # beginning, as a big-endian number: never decreases in Spark's
        # (byte-wise) string order.  It only routes rows to segments; values
        # sharing those bits stay in one segment and are compared whole.
        raw = c.cast("binary")
        if skip is not None:
            raw = F.substring(raw, skip + 1, F.lit(8))
        head = F.conv(F.rpad(F.hex(F.substring(raw, 1, 7)), 14, "0"), 16, 10).cast("long")
        eighth = F.coalesce(F.conv(F.hex(F.substring(raw, 8, 1)), 16, 10).cast("long"), F.lit(0))
        return head * F.lit(128) + F.floor(eighth / 2).cast("long")
    raise TypeError(f"cannot segment on {col} of type {dtype.simpleString()}")


def _count_upto(sorted_array: str, value: str) -> Column:
    """How many elements of a sorted array (of at most ``MAX_BANDS``) are <= ``value``."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(MAX_BANDS.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        F.coalesce(F.get(sorted_array, n + step - 1) <= F.col(value), F.lit(False)), n + step).otherwise(n))


@dataclass
class Segments:
    """Segment plan for one (keys, order column); ``splits`` is None when no key is hot."""

    keys: list[str]
    order_col: str
    splits: DataFrame | None
    per_segment: int = ROWS_PER_SEGMENT

    def assign(self, df: DataFrame, null_key_spread: int = 0) -> DataFrame:
        """Add ``_seg`` (0 for cold keys) to ``df``; ``df`` must carry the keys and order column.

        With ``null_key_spread > 0`` rows with a NULL key (which match nothing)
        get negative segments from a hash of the row, so they spread over many
        tasks instead of forming one NULL group.
        """
        out = self._assign(df)
        if null_key_spread > 0:
            null_key = F.lit(False)
            for k in self.keys:
                null_key = null_key | F.col(k).isNull()
            spread = -1 - F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(null_key_spread))
            out = out.withColumn(SEG, F.when(null_key, spread.cast("int")).otherwise(F.col(SEG)))
        return out

    def _assign(self, df: DataFrame) -> DataFrame:
        if self.splits is None:
            return df.withColumn(SEG, F.lit(0))
        joined = df.join(self.splits, self.keys, "left")
        joined = joined.withColumn(POS, order_position(df, self.order_col, F.coalesce(F.col("_skip"), F.lit(0))))
        # band = number of inner quantiles <= position (they are sorted: found by halving,
        # for hot keys only), then an even cut inside the band.
        joined = joined.withColumn("_band", F.when(F.col("_q").isNotNull() & F.col(POS).isNotNull(), _count_upto("_q", POS)))
        lo = F.element_at(F.col("_b"), F.col("_band") + 1)
        hi = F.element_at(F.col("_b"), F.col("_band") + 2)
        width = F.greatest(hi - lo + 1, F.lit(1))
        sub = F.least(F.floor((F.greatest(F.col(POS) - lo, F.lit(0))) * F.col("_m") / width), F.col("_m") - 1)
        seg = F.when(F.col("_m").isNull() | F.col(POS).isNull(), F.lit(0)).otherwise(
            (F.col("_band") * F.col("_m") + sub).cast("int"))
        return joined.withColumn(SEG, seg).drop(POS, "_band", "_q", "_b", "_m", "_nseg", "_skip")


def plan_segments(df: DataFrame, keys: list[str], order_col: str, *,
                  rows_per_segment: int = ROWS_PER_SEGMENT, bands: int = BANDS, max_bands: int = MAX_BANDS,
                  accuracy: int = 4_000, sample_rows: int = SAMPLE_ROWS,
                  hot_keys: bool | DataFrame = True,
                  detect_on: DataFrame | Callable[[float], DataFrame] | None = None) -> Segments:
    """Find hot keys of ``df`` and cut each into segments of its ``order_col``.

    ``hot_keys=True`` detects them in two column-pruned passes: per-key counts
    on a Bernoulli sample (fraction ``sample_rows / rows_per_segment``, so a
    key at the threshold still shows about ``sample_rows`` rows, while the
    shuffle of per-key counts shrinks by the same fraction) pick candidates;
    then exact counts, bounds and quantiles are computed for the candidates
    only.  ``False`` disables splitting (every key in one task); a DataFrame
    of key values names the candidates, all of them.  ``detect_on`` is what the
    candidates are looked for in, where that is cheaper to read than ``df`` and
    holds the rows that can make a key hot; a function gives a sample of these for a fraction.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if hot_keys is False:
        return Segments(keys, order_col, None)
    named = lambda rows: rows.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))
    if isinstance(hot_keys, DataFrame):
        candidates, threshold = hot_keys.select(*keys).distinct(), -1
    else:
        threshold = rows_per_segment
        fraction = min(1.0, sample_rows / rows_per_segment)
        if callable(detect_on):
            seen = named(detect_on(fraction)).select(*keys)
        else:
            base = named(df if detect_on is None else detect_on).select(*keys)
            seen = base.sample(False, fraction, seed=17) if fraction < 1.0 else base
        # Half the expected sampled count as the bar: keys near the threshold
        # are checked exactly below rather than missed.
        bar = threshold * fraction * (0.5 if fraction < 1.0 else 1.0)
        candidates = (seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("_est"))
                      .filter(F.col("_est") > bar).select(*keys))
    candidates = _stored(candidates, "hot-keys")
    if candidates is None:
        return Segments(keys, order_col, None)
    own = named(df).select(*keys, F.col(order_col)).join(candidates, keys)
    skip = F.lit(0)
    if isinstance(df.schema[order_col].dataType, (T.StringType, T.BinaryType)):
        raw = F.col(order_col).cast("binary")
        ends = own.groupBy(*keys).agg(F.min(raw).alias("_lo"), F.max(raw).alias("_hi"))
        same = F.transform(F.sequence(F.lit(1), F.greatest(F.length("_lo"), F.length("_hi"), F.lit(1))), lambda i:
                           F.substring("_lo", i, F.lit(1)).eqNullSafe(F.substring("_hi", i, F.lit(1))))
        differ = F.array_position(same, False).cast("int")      # 0: they are equal
        shared = ends.select(*keys, F.coalesce(F.when(differ > 0, differ - 1).otherwise(F.length("_lo")), F.lit(0)).alias("_skip"))
        own, skip = own.join(_stored(shared, "hot-prefixes") or shared, keys), F.col("_skip")
    own = own.withColumns({"_skip": skip, POS: order_position(df, order_col, skip)})
    # Exact statistics for the candidates only: count, bounds, fine quantiles.
    fine = [i / max_bands for i in range(1, max_bands)]
    stats = (own.groupBy(*keys, "_skip")
             .agg(F.count(F.lit(1)).alias("_n"), F.min(POS).alias("_lo"), F.max(POS).alias("_hi"),
                  F.percentile_approx(POS, fine, accuracy).alias("_fq"))
             .filter(F.col("_n") > threshold))
    # Per key: one quantile band per needed segment (a power of two between
    # ``bands`` and ``max_bands``, so bands are every step-th fine quantile);
    # only beyond max_bands is each band cut evenly into ``_m`` parts.
    wanted = F.greatest(F.ceil(F.col("_n") / F.lit(rows_per_segment)), F.lit(1))
    k_bands = F.least(F.lit(max_bands), F.greatest(F.lit(bands), F.pow(F.lit(2), F.ceil(F.log2(wanted))))).cast("int")
    splits = (stats.withColumn("_k", k_bands)
              .withColumn("_step", (F.lit(max_bands) / F.col("_k")).cast("int"))
              .withColumn("_inner", F.coalesce(F.expr("filter(_fq, (x, i) -> (i + 1) % _step = 0)"),
                                               F.array().cast("array<bigint>")))
              .select(*keys, "_skip",
                      F.array_sort("_inner").alias("_q"),
                      F.concat(F.array(F.col("_lo")), F.array_sort("_inner"), F.array(F.col("_hi"))).alias("_b"),
                      F.ceil(F.col("_n") / (F.lit(rows_per_segment) * F.col("_k"))).cast("int").alias("_m"),
                      F.col("_k")))
    splits = splits.withColumn("_nseg", (F.col("_k") * F.col("_m")).cast("int")).drop("_k")
    return Segments(keys, order_col, _stored(splits, "segments"), rows_per_segment)


def _stored(small: DataFrame, name: str) -> DataFrame | None:
    """Write a planning table once to the shared folder; None when it is empty."""
    stored = materialize(small, name)
    return None if stored.isEmpty() else stored


def _orders(order_cols: list[str], reverse: bool) -> list[Column]:
    if reverse:
        return [F.col(c).desc_nulls_last() for c in order_cols]
    return [F.col(c).asc_nulls_first() for c in order_cols]


def _lead(value: str, partition: list[str], order_cols: list[str], reverse: bool) -> Column:
    """The next non-NULL ``value`` after a row (the DataFrame API has no IGNORE NULLS for lead)."""
    way = "DESC NULLS LAST" if reverse else "ASC NULLS FIRST"
    return F.expr(f"lead(`{value}`) IGNORE NULLS OVER (PARTITION BY {', '.join(f'`{c}`' for c in partition)} "
                  f"ORDER BY {', '.join(f'`{c}` {way}' for c in order_cols)})")


def scan(df: DataFrame, segments: Segments, order_cols: list[str], *,
         last: Sequence[tuple[str, str]] = (), last_before: Sequence[tuple[str, str]] = (),
         first_of_key: Sequence[tuple[str, str]] = (), next_after: Sequence[tuple[str, str]] = (),
         reverse: bool = False, salt: str | None = None) -> DataFrame:
    """Per-key scan outputs computed by one window operator (one sort) per call.

    * ``last``: ``(value, out)`` -> last non-NULL ``value`` up to and including the row;
    * ``last_before``: the same, excluding the row itself;
    * ``first_of_key``: the first non-NULL ``value`` of the whole key;
    * ``next_after``: the first non-NULL ``value`` strictly after the row
      (``LEAD ... IGNORE NULLS`` in the same ordering: no second sort, no growing frame).

    "Last"/"first" follow ``order_cols`` (or its reverse).  ``df`` must carry
    ``_seg`` (:meth:`Segments.assign`); ``order_cols`` must order the rows of a
    key totally (add a unique tie-break) so every task picks the same row.
    ``salt`` names a column that further splits a segment's window (see
    :func:`salt_readers`); rows that carry values must then be present in
    every salt of their segment.
    """
    keys = segments.keys
    spec = Window.partitionBy(*keys, SEG, *([salt] if salt else [])).orderBy(*_orders(order_cols, reverse))
    upto = spec.rowsBetween(Window.unboundedPreceding, 0)
    before = spec.rowsBetween(Window.unboundedPreceding, -1)
    whole = spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = {}
    for value, out in last:
        local[out] = F.last(F.col(value), ignorenulls=True).over(upto)
    for value, out in last_before:
        local[out] = F.last(F.col(value), ignorenulls=True).over(before)
    for value, out in first_of_key:
        local[out] = F.first(F.col(value), ignorenulls=True).over(whole)
    for value, out in next_after:
        local[out] = _lead(value, [*keys, SEG, *([salt] if salt else [])], order_cols, reverse)
    if segments.splits is None:
        return df.withColumns(local)
    tmp = {out: f"_local_{out}" for out in local}
    rows = df.withColumns({tmp[o]: e for o, e in local.items()})
    carry = _carry_table(df, segments, order_cols, reverse,
                         [*last, *last_before], list(first_of_key), list(next_after))
    rows = rows.join(carry, [*keys, SEG], "left")
    outs = {}
    for _, out in [*last, *last_before]:
        outs[out] = F.coalesce(F.col(tmp[out]), F.col(f"_carry_{out}"))
    for _, out in first_of_key:
        outs[out] = F.coalesce(F.col(f"_carry_{out}"), F.col(tmp[out]))
    for _, out in next_after:
        outs[out] = F.coalesce(F.col(tmp[out]), F.col(f"_carry_{out}"))
    drop = list(tmp.values()) + [f"_carry_{o}" for o in local]
    return rows.withColumns(outs).drop(*drop)


def salt_readers(df: DataFrame, segments: Segments, is_reader: Column, row_hash: Column) -> DataFrame:
    """Split oversized hot segments whose rows share positions (ties cannot be cut).

    Rows for which ``is_reader`` holds only read carried values (facts in a
    lookup); they are counted per hot (key, segment) in one aggregation over
    the hot keys (a bounded table), and a segment with more than
    ``per_segment`` readers gets ``R = ceil(readers / per_segment)`` salts:
    each reader goes to salt ``pmod(row_hash, R)``, every other row of that
    segment is copied into all ``R`` salts.  Adds column ``_salt``.
    """
    keys = segments.keys
    if segments.splits is None:
        return df.withColumn("_salt", F.lit(0))
    readers = (df.filter(is_reader).join(segments.splits.select(*keys), keys, "left_semi")
               .groupBy(*keys, SEG).agg(F.count(F.lit(1)).alias("_readers")))
    salts = (readers.select(*keys, SEG, F.ceil(F.col("_readers") / F.lit(segments.per_segment))
                            .cast("int").alias("_nsalt"))
             .filter(F.col("_nsalt") > 1))
    salts = _stored(salts, "salts")
    if salts is None:
        return df.withColumn("_salt", F.lit(0))
    joined = df.join(salts, [*keys, SEG], "left")
    n = F.coalesce(F.col("_nsalt"), F.lit(1))
    # One pass: a reader gets one salt, any other row one copy per salt.
    choices = F.when(is_reader, F.array(F.pmod(row_hash, n).cast("int"))).otherwise(F.sequence(F.lit(0), n - 1))
    return joined.withColumn("_salt", F.explode(choices)).drop("_nsalt")


def fill_last(df: DataFrame, segments: Segments, value: str, out: str, order_cols: list[str], *,
              inclusive: bool = True, reverse: bool = False) -> DataFrame:
    """For each row, the last non-NULL ``value`` among rows of its key before it in order.

    ``inclusive`` counts the row itself; ``reverse`` scans from the end (the
    first non-NULL value *after* the row).  See :func:`scan`.
    """
    if inclusive:
        return scan(df, segments, order_cols, last=[(value, out)], reverse=reverse)
    return scan(df, segments, order_cols, last_before=[(value, out)], reverse=reverse)


def _carry_table(df: DataFrame, segments: Segments, order_cols: list[str], reverse: bool,
                 carried: list[tuple[str, str]], firsts: list[tuple[str, str]],
                 nexts: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """(hot key, segment) -> values carried in from other segments of the key.

    ``_carry_<out>`` of a ``carried`` output is the last non-NULL value of all
    earlier segments; of a ``firsts`` output, the key's first non-NULL value;
    of a ``nexts`` output, the first non-NULL value of all later segments.
    One row per hot segment (a bounded table); built from one partial
    aggregation over the hot keys' rows.
    """
    keys = segments.keys
    ordering = F.struct(*[F.col(c) for c in order_cols])
    last_pick = F.min_by if reverse else F.max_by
    first_pick = F.max_by if reverse else F.min_by
    # Only rows that carry a value matter.  Where an input branch holds a
    # literal NULL value (facts in a lookup, change points in a merge) the
    # optimizer drops that whole branch from this pass.
    carries = F.lit(False)
    for value, _ in [*carried, *firsts, *nexts]:
        carries = carries | F.col(value).isNotNull()
    hot_rows = df.filter(carries).join(segments.splits.select(*keys), keys, "left_semi")
    aggs = []
    for value, out in carried:
        aggs.append(last_pick(F.col(value), F.when(F.col(value).isNotNull(), ordering)).alias(f"_l_{out}"))
    for value, out in [*firsts, *nexts]:
        aggs.append(first_pick(F.col(value), F.when(F.col(value).isNotNull(), ordering)).alias(f"_f_{out}"))
    per_seg = hot_rows.groupBy(*keys, SEG).agg(*aggs)
    all_segs = segments.splits.select(*keys, F.explode(F.sequence(F.lit(0), F.col("_nseg") - 1)).alias(SEG))
    seg_order = F.col(SEG).desc() if reverse else F.col(SEG).asc()
    w_before = Window.partitionBy(*keys).orderBy(seg_order).rowsBetween(Window.unboundedPreceding, -1)
    w_whole = Window.partitionBy(*keys).orderBy(seg_order).rowsBetween(Window.unboundedPreceding,
                                                                        Window.unboundedFollowing)
    cols = [F.last(f"_l_{out}", ignorenulls=True).over(w_before).alias(f"_carry_{out}") for _, out in carried]
    cols += [F.first(f"_f_{out}", ignorenulls=True).over(w_whole).alias(f"_carry_{out}") for _, out in firsts]
    cols += [_lead(f"_f_{out}", keys, [SEG], reverse).alias(f"_carry_{out}") for _, out in nexts]
    return materialize(all_segs.join(per_seg, [*keys, SEG], "left").select(*keys, SEG, *cols), "carry")
