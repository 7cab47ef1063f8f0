"""Data-quality checks that warn or stop a run.

``run_checks`` returns a small DataFrame ``(table, column, check, failures)``
with one row per check.  Row-level checks of one table (not NULL, accepted
values, length, row rules) are counted in a single aggregation pass; every
``unique`` check is one partial aggregation.  All ``relationships`` checks over keys of
text or whole numbers are one pass: each child is scanned once, its foreign keys are laid
under each other as (parent, key), counted (so a hot key travels as one row per map task)
and anti-joined once, where the counts are, with the keys of all parents, each parent
column scanned once; a ``unique`` check of such a parent column counts the keys that
moved for the join.  Other key types have a join of their own.  Only the result table,
one row per check, ever reaches the driver (``enforce``).
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("tidemark.quality")

ROW_LEVEL = ("not_null", "accepted_values", "max_length", "rule")


@dataclass(frozen=True)
class Check:
    table: str
    kind: str
    columns: tuple[str, ...] = ()
    values: tuple = ()
    to_table: str | None = None
    to_column: str | None = None
    condition: str | None = None      # SQL predicate that is TRUE on a failing row (kind="rule")
    name: str | None = None
    limit: int | None = None
    severity: str = "error"

    @property
    def label(self) -> str:
        return self.name or self.kind

    @property
    def column(self) -> str:
        return ",".join(self.columns)


class QualityError(RuntimeError):
    """Raised by :func:`enforce` when an error-severity check fails."""


def not_null(table: str, column: str, **kw) -> Check:
    return Check(table, "not_null", (column,), **kw)


def unique(table: str, *columns: str, **kw) -> Check:
    return Check(table, "unique", tuple(columns), **kw)


def accepted_values(table: str, column: str, values: Sequence, **kw) -> Check:
    return Check(table, "accepted_values", (column,), values=tuple(values), **kw)


def relationships(table: str, column: str, to_table: str, to_column: str, **kw) -> Check:
    return Check(table, "relationships", (column,), to_table=to_table, to_column=to_column, **kw)


def rule(table: str, name: str, failing_condition: str, columns: Sequence[str] = (), **kw) -> Check:
    """A row rule: rows where ``failing_condition`` is TRUE fail (a singular test)."""
    return Check(table, "rule", tuple(columns), condition=failing_condition, name=name, **kw)


def max_length(table: str, column: str, limit: int = 255, **kw) -> Check:
    return Check(table, "max_length", (column,), limit=limit, **kw)


def failing_condition(check: Check) -> Column:
    """Predicate TRUE on the failing rows of a row-level check (NULL never fails
    accepted_values or max_length)."""
    if check.kind == "not_null":
        return F.col(check.columns[0]).isNull()
    if check.kind == "accepted_values":
        c = F.col(check.columns[0])
        return c.isNotNull() & ~c.isin(*check.values)
    if check.kind == "max_length":
        c = F.col(check.columns[0])
        return c.isNotNull() & (F.char_length(c) > F.lit(check.limit))
    if check.kind == "rule":
        return F.coalesce(F.expr(check.condition), F.lit(False))
    raise ValueError(f"{check.kind} is not a row-level check")


def failing_rows(tables: Mapping[str, DataFrame], check: Check,
                 unique_scope: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows (or keys) a check reports.  ``unique_scope`` may name, per table,
    the rows a uniqueness check must cover (e.g. new rows plus older rows with
    the same keys) instead of the table."""
    df = tables[check.table]
    if check.kind == "unique" and unique_scope and check.table in unique_scope:
        df = unique_scope[check.table]
    if check.kind in ROW_LEVEL:
        return df.filter(failing_condition(check))
    if check.kind == "unique":
        nn = F.lit(True)
        for c in check.columns:
            nn = nn & F.col(c).isNotNull()
        return (df.filter(nn).groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n_records"))
                .filter(F.col("n_records") > 1))
    if check.kind == "relationships":
        c = check.columns[0]
        parent = tables[check.to_table].select(F.col(check.to_column).alias(c)).filter(F.col(c).isNotNull())
        return df.filter(F.col(c).isNotNull()).join(parent, c, "left_anti")
    raise ValueError(f"unknown check kind {check.kind!r}")


def _result(check: Check, failures: Column) -> list[Column]:
    return [F.lit(check.table).alias("table"), F.lit(check.column).alias("column"),
            F.lit(check.label).alias("check"), failures.cast("long").alias("failures")]


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check],
               unique_scope: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """All checks -> DataFrame(table, column, check, failures), one row per check."""
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for ch in checks:
        if ch.kind in ROW_LEVEL:
            by_table.setdefault(ch.table, []).append(ch)
    for table, group in by_table.items():
        # One pass over the table for all its row-level checks.
        counts = tables[table].agg(*[F.count_if(failing_condition(ch)).alias(f"c{i}") for i, ch in enumerate(group)])
        rows = F.array(*[F.struct(*_result(ch, F.col(f"c{i}"))) for i, ch in enumerate(group)])
        parts.append(counts.select(F.explode(rows).alias("r")).select("r.*"))
    together = [ch for ch in checks if ch.kind == "relationships" and _plain_keys(tables, ch)]
    shared: list[Check] = []
    if together:
        parents = {(ch.to_table, ch.to_column) for ch in together}
        shared = [ch for ch in checks if ch.kind == "unique" and (ch.table, ch.column) in parents
                  and not (unique_scope and ch.table in unique_scope) and _binary_text(tables, ch)]
        parts.append(_key_counts(tables, together, shared))
    for ch in checks:
        if ch.kind == "unique" and ch not in shared:
            bad = failing_rows(tables, ch, unique_scope)
            parts.append(bad.agg(*_result(ch, F.count(F.lit(1)))))
        elif ch.kind == "relationships" and ch not in together:
            c = ch.columns[0]
            child = (tables[ch.table].filter(F.col(c).isNotNull())
                     .groupBy(c).agg(F.count(F.lit(1)).alias("_n")))
            parent = tables[ch.to_table].select(F.col(ch.to_column).alias(c)).filter(F.col(c).isNotNull())
            orphans = child.join(parent, c, "left_anti")
            parts.append(orphans.agg(*_result(ch, F.coalesce(F.sum("_n"), F.lit(0)))))
        elif ch.kind not in (*ROW_LEVEL, "relationships", "unique"):
            raise ValueError(f"unknown check kind {ch.kind!r}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _plain_keys(tables: Mapping[str, DataFrame], check: Check) -> bool:
    """Whether a check's key and its parent's are both text or both whole numbers (equal values have equal text)."""
    kinds = [tables[check.table].schema[check.columns[0]].dataType, tables[check.to_table].schema[check.to_column].dataType]
    return all(isinstance(k, T.StringType) for k in kinds) or all(isinstance(k, T.IntegralType) for k in kinds)


def _binary_text(tables: Mapping[str, DataFrame], check: Check) -> bool:
    """Whether equal values of a check's column have equal bytes (text without a collation, whole numbers)."""
    kind = tables[check.table].schema[check.column].dataType
    return isinstance(kind, T.IntegralType) or kind == T.StringType()


def _packed(key: Column) -> Column:
    """A key's text as bytes, other bytes for another text.  Keys travel, and a surrogate key (md5 in lower-case
    hexadecimal digits) takes 17 bytes so, not 32; any other text one more than its own."""
    digits = F.unhex(key)
    return (F.when((F.octet_length(key) == 32) & (F.lower(F.hex(digits)) == key), F.concat(F.unhex(F.lit("01")), digits))
            .otherwise(F.concat(F.unhex(F.lit("00")), key.cast("binary"))))


def _by_parent(keys: DataFrame, counts: list[Column]) -> DataFrame:
    return (keys if "p" in keys.columns else keys.withColumn("p", F.lit(0))).groupBy("p").agg(*counts)


def _key_counts(tables: Mapping[str, DataFrame], checks: Sequence[Check], unique: Sequence[Check]) -> DataFrame:
    """The results of relationship checks, all in one pass (one scan a child and a parent column), and of uniqueness
    checks of their parents' columns.

    Foreign keys are counted by (parent, key), a column for each check of a parent, so that the counts already lie
    where the join needs them; uniqueness is read off the same shuffle of the parents' keys.
    """
    parents = {column: p for p, column in enumerate(dict.fromkeys((ch.to_table, ch.to_column) for ch in checks))}
    places: list[tuple[int, int]] = []        # of each check: its parent, its place among that parent's checks
    by_child: dict[str, list[int]] = {}
    for i, ch in enumerate(checks):
        p = parents[ch.to_table, ch.to_column]
        places.append((p, sum(q == p for q, _ in places)))
        by_child.setdefault(ch.table, []).append(i)
    keys = None
    for child, own in by_child.items():
        laid = F.array(*[F.struct(F.lit(places[i][0]).alias("p"), F.lit(places[i][1]).alias("s"),
                                  F.col(checks[i].columns[0]).cast("string").alias("k")) for i in own])
        rows = tables[child].select(F.explode(laid).alias("x")).select("x.p", "x.s", _packed(F.col("x.k")).alias("k"))
        rows = rows.filter(F.col("k").isNotNull())
        keys = rows if keys is None else keys.unionByName(rows)
    known = None
    for (table, column), p in parents.items():
        rows = tables[table].select(F.lit(p).alias("p"), _packed(F.col(column).cast("string")).alias("k")).filter(F.col("k").isNotNull())
        known = rows if known is None else known.unionByName(rows)
    on = ["p", "k"] if len(parents) > 1 else ["k"]        # a constant would be no part of the shuffle
    if unique:
        # The filter holds for every key: it keeps the count in the join's side too, so both uses share one shuffle.
        known = known.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 1)
    slots = range(1 + max(s for _, s in places))
    orphans = keys.groupBy(*on).agg(*[F.count_if(F.col("s") == s).alias(f"n{s}") for s in slots]).join(known, on, "left_anti")
    found = _by_parent(orphans, [F.sum(f"n{s}").alias(f"n{s}") for s in slots]).select("p", F.explode(F.array(
        *[F.struct(F.lit(s).alias("s"), F.col(f"n{s}").alias("n")) for s in slots])).alias("x")).select("p", "x.*")
    if unique:
        found = found.unionByName(_by_parent(known, [F.count_if(F.col("n") > 1).alias("n")]).withColumn("s", F.lit(-1)))
    places += [(parents[ch.table, ch.column], -1) for ch in unique]
    named = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(s).alias("s"), F.lit(c.table).alias("table"), F.lit(c.column).alias("column"),
                               F.lit(c.label).alias("check")) for (p, s), c in zip(places, [*checks, *unique])])
    every = keys.sparkSession.range(1).select(F.explode(named).alias("c")).select("c.*")
    return every.join(F.broadcast(found), ["p", "s"], "left").select(        # a row a check
        "table", "column", "check", F.coalesce("n", F.lit(0)).cast("long").alias("failures"))


def run_checks_one_by_one(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """The same table as :func:`run_checks`, a count of its own for each check (the way a test
    runner issues one query per test); kept to measure the single-pass form."""
    out = None
    for ch in checks:
        count = failing_rows(tables, ch).agg(*_result(ch, F.count(F.lit(1))))
        out = count if out is None else out.unionByName(count)
    return out


def enforce(results: DataFrame, checks: Sequence[Check] | None = None, on_fail: str = "error") -> list[dict]:
    """Collect the (small) result table; raise on failing error checks when ``on_fail='error'``.

    Warn-severity checks, and every check when ``on_fail='warn'``, only log.
    Returns the failing checks as dicts.
    """
    severity = {(c.table, c.column, c.label): c.severity for c in (checks or [])}
    failed = [r.asDict() for r in results.filter(F.col("failures") > 0).collect()]
    errors = []
    for r in failed:
        sev = severity.get((r["table"], r["column"], r["check"]), "error")
        if on_fail == "error" and sev == "error":
            errors.append(r)
        else:
            log.warning("quality check failed: %s", r)
    if errors:
        raise QualityError(f"{len(errors)} quality check(s) failed: {errors}")
    return failed
