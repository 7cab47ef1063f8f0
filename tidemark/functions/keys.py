"""Hash surrogate keys (md5 hex of the concatenated text)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: ColumnOrName) -> Column:
    """Text of a value as used inside keys; timestamps render in the session zone (UTC)."""
    return _c(c).cast("string")


def surrogate_key(*cols: ColumnOrName) -> Column:
    """md5 of the concatenated text of ``cols``; any NULL part gives a NULL key."""
    return F.md5(F.concat(*[as_text(c) for c in cols]))


def versioned_key(key: ColumnOrName, valid_from: ColumnOrName) -> Column:
    """Key of one version: md5(key || valid_from as text)."""
    return surrogate_key(key, valid_from)


def nullable_key(c: ColumnOrName) -> Column:
    """md5 of the value, or NULL when the value is NULL or the empty string."""
    c = _c(c)
    return F.when(c.isNull() | (c == F.lit("")), F.lit(None).cast("string")).otherwise(F.md5(as_text(c)))


def scd_id(key: ColumnOrName, run_ts: ColumnOrName) -> Column:
    """Identity of a snapshot version: md5(key '|' run timestamp text)."""
    return F.md5(F.concat_ws("|", as_text(key), as_text(run_ts)))
