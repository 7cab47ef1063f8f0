"""PII masks and the age bracket, as pure Column expressions (no UDF).

Each mask keeps SQL NULL semantics: a NULL input gives a NULL output, except
the age bracket, whose fall-through branch turns a NULL birth date into the
oldest bracket exactly like the CASE it mirrors.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Mask characters and age brackets (upper bound exclusive, label).
MASK_CHAR = "*"
EMAIL_MASK = "***@"
DIGIT_RUN_MASK = "###"
AGE_BRACKETS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")]
OLDEST_BRACKET = "65+"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_name(c: ColumnOrName) -> Column:
    """First character, then one mask character per remaining character."""
    c = _c(c)
    rest = F.greatest(F.char_length(c) - 1, F.lit(0))
    return F.concat(F.left(c, F.lit(1)), F.repeat(F.lit(MASK_CHAR), rest))


def mask_phone(c: ColumnOrName) -> Column:
    """Mask all but the last four characters; four or fewer are shown whole."""
    c = _c(c)
    hidden = F.greatest(F.char_length(c) - 4, F.lit(0))
    return F.concat(F.repeat(F.lit(MASK_CHAR), hidden), F.right(c, F.lit(4)))


def mask_email(c: ColumnOrName) -> Column:
    """First character, a fixed mask, then the domain ('' when there is no '@')."""
    c = _c(c)
    return F.concat(F.left(c, F.lit(1)), F.lit(EMAIL_MASK), F.split_part(c, F.lit("@"), F.lit(2)))


def redact_digits(c: ColumnOrName) -> Column:
    """Replace every run of ASCII digits by a fixed token (all occurrences)."""
    return F.regexp_replace(_c(c), r"\d+", DIGIT_RUN_MASK)


def completed_years(born: ColumnOrName, as_of: ColumnOrName | _dt.date) -> Column:
    """Whole calendar years from ``born`` to ``as_of``.

    Calendar form: year difference minus one when the (month, day) of ``as_of``
    is before that of ``born``.  Someone born on 29 February is one year older
    on 1 March, not on 28 February.
    """
    born = _c(born)
    as_of = F.lit(as_of) if isinstance(as_of, _dt.date) else _c(as_of)
    before_birthday = (F.month(as_of) < F.month(born)) | (
        (F.month(as_of) == F.month(born)) & (F.dayofmonth(as_of) < F.dayofmonth(born)))
    return F.year(as_of) - F.year(born) - F.when(before_birthday, 1).otherwise(0)


def age_bracket(born: ColumnOrName, as_of: ColumnOrName | _dt.date) -> Column:
    """Bracket label for the completed age; under 18 falls in the youngest, NULL in the oldest."""
    years = completed_years(born, as_of)
    expr = None
    for upper, label in AGE_BRACKETS:
        expr = F.when(years < upper, F.lit(label)) if expr is None else expr.when(years < upper, F.lit(label))
    return expr.otherwise(F.lit(OLDEST_BRACKET))
