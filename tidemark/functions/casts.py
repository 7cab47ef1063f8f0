"""Typed casts of landing text (ANSI: malformed text raises; ``try_`` forms give NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

AMOUNT_TYPE = "decimal(12,2)"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_date(c: ColumnOrName, strict: bool = True) -> Column:
    c = _c(c)
    return c.cast("date") if strict else c.try_cast("date")


def to_timestamp(c: ColumnOrName, strict: bool = True) -> Column:
    c = _c(c)
    return c.cast("timestamp") if strict else c.try_cast("timestamp")


def to_amount(c: ColumnOrName, strict: bool = True) -> Column:
    """Text to decimal(12,2); extra digits round half-up, overflow raises under ANSI."""
    c = _c(c)
    return c.cast(AMOUNT_TYPE) if strict else c.try_cast(AMOUNT_TYPE)


def to_text(c: ColumnOrName) -> Column:
    """Timestamp/date/number to text; trailing zero fractions are trimmed."""
    return _c(c).cast("string")


def blank_to_null(c: ColumnOrName) -> Column:
    c = _c(c)
    return F.when(c == F.lit(""), F.lit(None).cast("string")).otherwise(c)
