"""Version histories: SCD2 check snapshots, replay, timeline merge and as-of lookup.

A *history* is a DataFrame of versions ``(key..., valid_from, valid_to, attrs...)``
where ``valid_to`` NULL means open and versions of one key do not overlap.

The per-key work (previous version, next change point, version in force) runs as
one sort per ``(key, segment)`` through :mod:`tidemark.operators.scan`, so it
is linear after the sort and a hot key is split over many tasks.  The literal
join forms of the as-of lookup and of the timeline merge are kept
(``method="join"``) for small inputs and as cross-checks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import scd_id as _scd_id
from tidemark.operators.load import require_unique
from tidemark.operators.scan import SEG, fill_last, plan_segments, salt_readers, scan
from tidemark.sources.tables import materialize

Keys = str | Sequence[str]


def _keys(k: Keys) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _any_null(cols: Sequence[str]) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def _null_safe_equal(a: Sequence[Column], b: Sequence[Column]) -> Column:
    cond = F.lit(True)
    for x, y in zip(a, b):
        cond = cond & x.eqNullSafe(y)
    return cond


# --------------------------------------------------------------------------- H1
SNAPSHOT_COLUMNS = ("scd_id", "updated_at", "valid_from", "valid_to")


def snapshot_check(target: DataFrame | None, source: DataFrame, key: Keys, check_cols: Sequence[str],
                   run_ts, *, check_unique: bool = True) -> DataFrame:
    """One run of an SCD2 *check* snapshot.

    ``source`` is the current state (one row per key).  Against the open
    versions of ``target``: a new key opens a version; a key whose
    ``check_cols`` differ (NULL-safe) closes its open version at ``run_ts`` and
    opens a new one; an unchanged key keeps its open version untouched (stale
    non-checked columns included); a key missing from ``source`` stays open.
    Closed versions pass through unchanged.  ``target=None`` is an empty
    snapshot.  Output columns: source columns + scd_id, updated_at, valid_from,
    valid_to.  Re-running with the same source and a later clock adds nothing.
    """
    if target is None:
        return snapshot_step(None, source, key, check_cols, run_ts, check_unique=check_unique)
    cols = list(source.columns) + list(SNAPSHOT_COLUMNS)
    closed = target.filter(F.col("valid_to").isNotNull()).select(*cols)
    opened = target.filter(F.col("valid_to").isNull()).select(*cols)
    return closed.unionByName(snapshot_step(opened, source, key, check_cols, run_ts, check_unique=check_unique))


def snapshot_step(open_versions: DataFrame | None, source: DataFrame, key: Keys, check_cols: Sequence[str],
                  run_ts, *, check_unique: bool = True) -> DataFrame:
    """The part of a snapshot run that touches open versions.

    Returns every previously open version (closed at ``run_ts`` when its key
    changed, else as it was) plus the versions opened by this run.  Closed
    history is not an input: a job stores it append-only and rewrites only the
    open set (one full outer join of open versions with the source on the key,
    which is unique on both sides).
    """
    keys = _keys(key)
    run = _lit(run_ts)
    if check_unique:
        require_unique(source, keys, what="snapshot source")
    data_cols = list(source.columns)
    out_cols = data_cols + list(SNAPSHOT_COLUMNS)
    null_end = F.lit(None).cast(run_type(source, run))
    key_text = F.concat_ws("|", *[F.col(k) for k in keys]) if len(keys) > 1 else F.col(keys[0])
    if open_versions is None:
        return source.select(*data_cols, _scd_id(key_text, run).alias("scd_id"), run.alias("updated_at"),
                             run.alias("valid_from"), null_end.alias("valid_to"))
    o = open_versions.select(*keys, F.struct(*out_cols).alias("_o"))
    s = source.select(*keys, F.struct(*data_cols).alias("_s"))
    both = o.join(s, keys, "full")
    same = _null_safe_equal([F.col(f"_o.{c}") for c in check_cols], [F.col(f"_s.{c}") for c in check_cols])
    has_o, has_s = F.col("_o").isNotNull(), F.col("_s").isNotNull()
    is_change = has_o & has_s & ~same
    s_key = F.concat_ws("|", *[F.col(f"_s.{k}") for k in keys]) if len(keys) > 1 else F.col(f"_s.{keys[0]}")
    old_version = F.when(has_o, F.struct(*[F.col(f"_o.{c}").alias(c) for c in out_cols if c != "valid_to"],
                                         F.when(is_change, run).otherwise(F.col("_o.valid_to")).alias("valid_to")))
    old_version = F.when(has_o, F.struct(*[old_version[c].alias(c) for c in out_cols]))
    new_version = F.when(has_s & (~has_o | is_change),
                         F.struct(*[F.col(f"_s.{c}").alias(c) for c in data_cols],
                                  _scd_id(s_key, run).alias("scd_id"), run.alias("updated_at"),
                                  run.alias("valid_from"), null_end.alias("valid_to")))
    return (both.select(F.explode(F.array_compact(F.array(old_version, new_version))).alias("_v"))
            .select("_v.*"))


def run_type(df: DataFrame, run: Column) -> str:
    """Spark type name of the run clock column (to type the NULL ``valid_to``)."""
    return df.sparkSession.range(1).select(run.alias("r")).schema["r"].dataType.simpleString()


# --------------------------------------------------------------------------- overlap guard
class OverlappingVersionsError(ValueError):
    """Versions of one key overlap, so "the version in force" is ambiguous."""


def overlapping_versions(versions: DataFrame, key: Keys, *, valid_from: str = "valid_from",
                         valid_to: str = "valid_to", **seg_opts) -> DataFrame:
    """Versions that start before the previous version of their key has ended.

    In valid_from order, a version overlaps when some earlier version is still
    open (NULL end) or ends after it starts.  Computed as a running maximum of
    earlier ends in the same skew-safe per-key scan; NULL ends count as +inf.
    """
    keys = _keys(key)
    v = versions.filter(~_any_null(keys) & F.col(valid_from).isNotNull())
    v = v.withColumn("_tb", F.xxhash64(*[F.col(c) for c in v.columns]))
    segs = plan_segments(v, keys, valid_from, **seg_opts)
    rows = segs.assign(v)
    # The end of the earlier version that ends last; an open earlier version wins.
    end_rank = F.struct(F.col(valid_to).isNull().alias("open"), F.col(valid_to).alias("end"))
    rows = rows.withColumn("_end", end_rank)
    order = [valid_from, "_tb"]
    w = (Window.partitionBy(*keys, SEG).orderBy(*[F.col(c).asc_nulls_first() for c in order])
         .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_prev_end", F.max("_end").over(w))
    if segs.splits is not None:
        hot = rows.join(segs.splits.select(*keys), keys, "left_semi")
        per_seg = hot.groupBy(*keys, SEG).agg(F.max("_end").alias("_m"))
        all_segs = segs.splits.select(*keys, F.explode(F.sequence(F.lit(0), F.col("_nseg") - 1)).alias(SEG))
        before = Window.partitionBy(*keys).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
        carry = materialize(all_segs.join(per_seg, [*keys, SEG], "left").select(
            *keys, SEG, F.max("_m").over(before).alias("_carry_end")), "carry")
        rows = (rows.join(carry, [*keys, SEG], "left")
                .withColumn("_prev_end", F.greatest("_prev_end", "_carry_end")))
    prev = F.col("_prev_end")
    overlaps = prev.isNotNull() & (prev["open"] | (prev["end"] > F.col(valid_from)))
    return rows.filter(overlaps).select(*versions.columns)


def require_disjoint(versions: DataFrame, key: Keys, *, valid_from: str = "valid_from",
                     valid_to: str = "valid_to", **seg_opts) -> DataFrame:
    """Raise :class:`OverlappingVersionsError` when versions of a key overlap; return ``versions``."""
    bad = overlapping_versions(versions, key, valid_from=valid_from, valid_to=valid_to, **seg_opts).take(1)
    if bad:
        raise OverlappingVersionsError(f"versions overlap for key {_keys(key)}, e.g. {bad[0].asDict()}")
    return versions


# --------------------------------------------------------------------------- H6
def replay_snapshots(observations: DataFrame, key: Keys, run_col: str, check_cols: Sequence[str], *,
                     order: Sequence[str] | None = None, **seg_opts) -> DataFrame:
    """Backfill a check snapshot over many runs at once.

    ``observations`` holds states seen at runs (``run_col``); when a key has
    several rows in one run the greatest by ``order`` wins (without ``order``,
    the greatest state, so the pick never depends on row order).  A run opens a
    version when it is the key's first run or its ``check_cols`` differ
    (NULL-safe) from the previous run's; its ``valid_to`` is the next opening
    run.  Equal to running :func:`snapshot_check` run by run.
    Output: key, check_cols, valid_from, valid_to.
    """
    keys = _keys(key)
    state = F.struct(*[F.col(c) for c in check_cols])
    ranking = F.struct(*[F.col(c) for c in (order or check_cols)])
    per_run = (observations.groupBy(*keys, run_col)
               .agg(F.max_by(state, ranking).alias("_st")))
    per_run = per_run.filter(~_any_null(keys) & F.col(run_col).isNotNull())
    segs = plan_segments(per_run, keys, run_col, **seg_opts)
    rows = segs.assign(per_run)
    rows = fill_last(rows, segs, "_st", "_prev", [run_col], inclusive=False)
    same = _null_safe_equal([F.col(f"_st.{c}") for c in check_cols], [F.col(f"_prev.{c}") for c in check_cols])
    kept = rows.filter(F.col("_prev").isNull() | ~same).withColumn("_run", F.col(run_col))
    kept = scan(kept, segs, [run_col], next_after=[("_run", "_next")])
    return kept.select(*keys, *[F.col(f"_st.{c}").alias(c) for c in check_cols],
                       F.col(run_col).alias("valid_from"), F.col("_next").alias("valid_to"))


# --------------------------------------------------------------------------- H2
def merge_timelines(histories: Sequence[tuple[DataFrame, Sequence[str]]], key: Keys, *,
                    valid_from: str = "valid_from", valid_to: str = "valid_to", check_overlap: bool = False,
                    method: str = "scan", **seg_opts) -> DataFrame:
    """Merge independently timed histories of one key into a single timeline.

    Change points are the distinct ``valid_from`` values of all histories; at
    each point every history contributes the attributes of its version in force
    (``valid_from <= point < valid_to``, open end allowed), or NULLs when none
    is.  A point's ``valid_to`` is the next change point of the key (NULL for
    the last).  Output: key, valid_from, valid_to, then each history's columns
    in the given order.  Keys must be non-NULL.

    ``method="scan"`` sorts change points and versions together once per
    (key, segment); ``method="join"`` is the literal form (change points joined
    to every history with a range condition, then LEAD), one join per history
    and a per-key window, for small inputs and as a cross-check.
    """
    keys = _keys(key)
    if check_overlap:
        for df, _ in histories:
            require_disjoint(df, keys, valid_from=valid_from, valid_to=valid_to)
    points = None
    for df, _ in histories:
        p = df.select(*keys, F.col(valid_from).alias("_t"))
        points = p if points is None else points.unionByName(p)
    points = points.filter(~_any_null(keys) & F.col("_t").isNotNull()).distinct()
    if method == "join":
        return _merge_join(points, histories, keys, valid_from, valid_to)
    if method != "scan":
        raise ValueError(f"unknown method {method!r}")
    points = (points
              .select(*keys, "_t", F.lit(1).alias("_kind"), F.lit(0).cast("long").alias("_tb"),
                      F.col("_t").alias("_pt")))
    union = points
    for i, (df, cols) in enumerate(histories):
        payload = F.struct(*[F.col(c) for c in cols], F.col(valid_to).alias("_vt"))
        v = (df.filter(~_any_null(keys) & F.col(valid_from).isNotNull())
             .select(*keys, F.col(valid_from).alias("_t"), F.lit(0).alias("_kind"),
                     F.xxhash64(payload).alias("_tb"), payload.alias(f"_h{i}")))
        union = union.unionByName(v, allowMissingColumns=True)
    order = ["_t", "_kind", "_tb"]
    segs = plan_segments(union, keys, "_t", **seg_opts)
    rows = segs.assign(union)
    rows = scan(rows, segs, order, last=[(f"_h{i}", f"_s{i}") for i in range(len(histories))],
                next_after=[("_pt", "_next")])
    rows = rows.filter(F.col("_kind") == 1)
    out = [*keys, F.col("_t").alias("valid_from"), F.col("_next").alias("valid_to")]
    for i, (_, cols) in enumerate(histories):
        s = F.col(f"_s{i}")
        in_force = s.isNotNull() & (s["_vt"].isNull() | (F.col("_t") < s["_vt"]))
        out += [F.when(in_force, s[c]).alias(c) for c in cols]
    return rows.select(*out)


def _merge_join(points, histories, keys, valid_from, valid_to):
    out = points
    for i, (df, cols) in enumerate(histories):
        h = df.select(*[F.col(k).alias(f"_hk{j}") for j, k in enumerate(keys)],
                      F.col(valid_from).alias(f"_vf{i}"), F.col(valid_to).alias(f"_vt{i}"),
                      *[F.col(c).alias(f"_c{i}_{c}") for c in cols])
        cond = (F.col(f"_vf{i}") <= F.col("_t")) & (F.col(f"_vt{i}").isNull() | (F.col("_t") < F.col(f"_vt{i}")))
        for j, k in enumerate(keys):
            cond = (out[k] == F.col(f"_hk{j}")) & cond
        out = out.join(h, cond, "left").drop(*[f"_hk{j}" for j in range(len(keys))], f"_vf{i}", f"_vt{i}")
    w = Window.partitionBy(*keys).orderBy("_t")
    cols = [*keys, F.col("_t").alias("valid_from"), F.lead("_t").over(w).alias("valid_to")]
    for i, (_, hc) in enumerate(histories):
        cols += [F.col(f"_c{i}_{c}").alias(c) for c in hc]
    return out.select(*cols)


# --------------------------------------------------------------------------- H3
def lookup_version(facts: DataFrame, versions: DataFrame, key: Keys, ts: str, *,
                   version_key: Keys | None = None, valid_from: str = "valid_from",
                   valid_to: str = "valid_to", columns: Sequence[str] | None = None,
                   backdate_first: bool = True, method: str = "scan", check_overlap: bool = False,
                   **seg_opts) -> DataFrame:
    """Attach to each fact the version of its key in force at ``ts``.

    A version is in force when ``valid_from <= ts`` and (``valid_to`` is NULL or
    ``ts < valid_to``).  With ``backdate_first`` the earliest version of each key
    has no lower bound, so facts before the first version still resolve.  Facts
    with a NULL key or NULL ``ts`` get no version; every fact is returned once.
    ``columns`` (default: all version columns but the key) are appended to the
    fact columns.  Versions of one key must not overlap (the join form would
    repeat the fact once per overlapping version); ``check_overlap=True``
    verifies it first (:func:`require_disjoint`).  ``method="scan"`` sorts facts and versions together per
    (key, segment); ``method="join"`` is the equi + range left join.
    ``sample_facts`` may give, for a fraction, the keys of a sample of the facts, where that is
    cheaper than sampling ``facts`` itself (it only finds hot keys).
    """
    fk = _keys(key)
    vk = _keys(version_key) if version_key is not None else fk
    if columns is None:
        columns = [c for c in versions.columns if c not in vk]
    columns = list(columns)
    if check_overlap:
        require_disjoint(versions, vk, valid_from=valid_from, valid_to=valid_to)
    vers = versions.filter(~_any_null(vk) & F.col(valid_from).isNotNull())
    if method == "join":
        return _lookup_join(facts, vers, fk, vk, ts, valid_from, valid_to, columns, backdate_first)
    if method != "scan":
        raise ValueError(f"unknown method {method!r}")
    return _lookup_scan(facts, vers, fk, vk, ts, valid_from, valid_to, columns, backdate_first, seg_opts)


def _lookup_join(facts, vers, fk, vk, ts, valid_from, valid_to, columns, backdate_first):
    if backdate_first:
        firsts = vers.groupBy(*vk).agg(F.min(valid_from).alias("_first"))
        vers = (vers.join(firsts, vk, "left")
                .withColumn("_lower", F.when(F.col(valid_from) == F.col("_first"), F.lit(None))
                            .otherwise(F.col(valid_from))))
    else:
        vers = vers.withColumn("_lower", F.col(valid_from))
    v = vers.select(*[F.col(k).alias(f"_vk{i}") for i, k in enumerate(vk)],
                    F.col("_lower").alias("_vlo"), F.col(valid_to).alias("_vhi"),
                    *[F.col(c).alias(f"_vc{i}") for i, c in enumerate(columns)])
    t = F.col(ts)
    cond = t.isNotNull() & (F.col("_vlo").isNull() | (t >= F.col("_vlo"))) & \
        (F.col("_vhi").isNull() | (t < F.col("_vhi")))
    for i, k in enumerate(fk):
        cond = (facts[k] == F.col(f"_vk{i}")) & cond
    joined = facts.join(v, cond, "left")
    return joined.select(*[facts[c] for c in facts.columns],
                         *[F.col(f"_vc{i}").alias(c) for i, c in enumerate(columns)])


# Rows with a NULL key are spread over this many segments (they match nothing).
NULL_KEY_SPREAD = 4096


def _lookup_scan(facts, vers, fk, vk, ts, valid_from, valid_to, columns, backdate_first, seg_opts):
    """Facts and versions sorted together per (key, segment) in one shuffle.

    A fact takes the last version at or before it (versions sort before facts
    at equal instants) if the fact is still before that version's end.  With
    back-dating, a fact that precedes every version of its key takes the key's
    first version (first non-NULL version of the whole key, same sort).
    """
    fact_cols = facts.columns
    carried = [c for c in fact_cols if c not in (*fk, ts)]      # the key and the instant travel once
    key_names = [f"_k{i}" for i in range(len(fk))]
    payload = F.struct(*[F.col(c).alias(c) for c in columns], F.col(valid_to).alias("_vt"))
    f_rows = facts.select(*[F.col(k).alias(n) for k, n in zip(fk, key_names)],
                          F.col(ts).alias("_t"), F.lit(1).alias("_kind"),
                          F.lit(0).cast("long").alias("_tb"),
                          F.struct(*(carried or [F.lit(True).alias("_fact")])).alias("_fact"))
    v_rows = vers.select(*[F.col(k).alias(n) for k, n in zip(vk, key_names)],
                         F.col(valid_from).alias("_t"), F.lit(0).alias("_kind"),
                         F.xxhash64(payload).alias("_tb"), payload.alias("_ver"))
    union = f_rows.unionByName(v_rows, allowMissingColumns=True)
    # Keys are hot by their facts (a version costs no more than a fact): looking for
    # them there spares building the versions a first time for the sample.
    given = seg_opts.pop("sample_facts", None)
    sampled = None if given is None else lambda fraction: given(fraction).select(
        *[F.col(k).alias(n) for k, n in zip(fk, key_names)])
    segs = plan_segments(union, key_names, "_t", **{"detect_on": f_rows if sampled is None else sampled, **seg_opts})
    rows = segs.assign(union, null_key_spread=NULL_KEY_SPREAD)
    # Facts only read versions: where one hot segment still holds too many
    # facts (e.g. many facts at one instant), they are salted and the
    # segment's versions are copied into each salt.
    rows = salt_readers(rows, segs, F.col("_kind") == 1, F.xxhash64("_t", "_fact"))
    order = ["_t", "_kind", "_tb"]
    if backdate_first:
        rows = scan(rows, segs, order, last=[("_ver", "_prev")], first_of_key=[("_ver", "_first")], salt="_salt")
    else:
        rows = scan(rows, segs, order, last=[("_ver", "_prev")], salt="_salt")
    prev, t = F.col("_prev"), F.col("_t")
    in_force = prev.isNotNull() & (prev["_vt"].isNull() | (t < prev["_vt"]))
    version = F.when(t.isNotNull() & in_force, prev)
    if backdate_first:
        first = F.col("_first")
        before_first = prev.isNull() & first.isNotNull() & (first["_vt"].isNull() | (t < first["_vt"]))
        version = version.when(t.isNotNull() & before_first, first)
    return (rows.filter(F.col("_kind") == 1)
            .select(*key_names, "_t", "_fact", version.alias("_v"))
            .select(*[F.col(key_names[fk.index(c)] if c in fk else "_t" if c == ts else f"_fact.{c}").alias(c) for c in fact_cols],
                    *[F.col(f"_v.{c}").alias(c) for c in columns]))


__all__ = ["SNAPSHOT_COLUMNS", "OverlappingVersionsError", "lookup_version", "merge_timelines",
           "overlapping_versions", "replay_snapshots", "require_disjoint", "snapshot_check", "snapshot_step",
           "SEG"]
