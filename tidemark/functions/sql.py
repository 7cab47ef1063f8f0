"""The masks, brackets and keys as SQL functions, for queries written in SQL.

``register(spark)`` creates them as temporary SQL functions of the session: plain
expressions that the optimizer inlines, no Python in a query.  Each equals its Column
form (:mod:`tidemark.functions.masking`, :mod:`tidemark.functions.keys`).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.functions.masking import AGE_BRACKETS, DIGIT_RUN_MASK, EMAIL_MASK, MASK_CHAR, OLDEST_BRACKET

_YEARS = ("year(as_of) - year(born) - CASE WHEN month(as_of) < month(born) OR (month(as_of) = month(born) "
          "AND dayofmonth(as_of) < dayofmonth(born)) THEN 1 ELSE 0 END")
_BRACKETS = " ".join(f"WHEN years < {upper} THEN '{label}'" for upper, label in AGE_BRACKETS)

#: name: (parameters, result type, expression)
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "mask_name": ("c STRING", "STRING", f"left(c, 1) || repeat('{MASK_CHAR}', greatest(char_length(c) - 1, 0))"),
    "mask_phone": ("c STRING", "STRING", f"repeat('{MASK_CHAR}', greatest(char_length(c) - 4, 0)) || right(c, 4)"),
    "mask_email": ("c STRING", "STRING", f"left(c, 1) || '{EMAIL_MASK}' || split_part(c, '@', 2)"),
    "redact_digits": ("c STRING", "STRING", f"regexp_replace(c, '[0-9]+', '{DIGIT_RUN_MASK}')"),
    "completed_years": ("born DATE, as_of DATE", "INT", _YEARS),
    "bracket_of": ("years INT", "STRING", f"CASE {_BRACKETS} ELSE '{OLDEST_BRACKET}' END"),
    "age_bracket": ("born DATE, as_of DATE", "STRING", f"bracket_of({_YEARS})"),
    "surrogate_key": ("key STRING", "STRING", "md5(key)"),
    "versioned_key": ("key STRING, valid_from TIMESTAMP", "STRING", "md5(key || CAST(valid_from AS STRING))"),
    "nullable_key": ("key STRING", "STRING", "CASE WHEN key IS NULL OR key = '' THEN NULL ELSE md5(key) END"),
    "scd_id": ("key STRING, run_ts TIMESTAMP", "STRING", "md5(concat_ws('|', key, CAST(run_ts AS STRING)))"),
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session; returns their names."""
    for name, (parameters, result, expression) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {expression}")
    return list(FUNCTIONS)
