import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (age_bracket, completed_years, mask_email, mask_name, mask_phone, nullable_key,
                                redact_digits, scd_id, surrogate_key, to_amount, to_date, to_text)


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("value,expected", [(None, None), ("", ""), ("A", "A"), ("Ann", "A**"), ("Éva", "É**")])
def test_mask_name(spark, value, expected):
    assert one(spark, mask_name("v"), value) == expected


@pytest.mark.parametrize("value,expected", [(None, None), ("123", "123"), ("1234", "1234"),
                                            ("77011234567", "*******4567")])
def test_mask_phone(spark, value, expected):
    assert one(spark, mask_phone("v"), value) == expected


@pytest.mark.parametrize("value,expected", [(None, None), ("ann@x.kz", "a***@x.kz"), ("nodomain", "n***@")])
def test_mask_email(spark, value, expected):
    assert one(spark, mask_email("v"), value) == expected


@pytest.mark.parametrize("value,expected", [(None, None), ("12 Abay ave, apt 7", "### Abay ave, apt ###"),
                                            ("Main street", "Main street")])
def test_redact_digits(spark, value, expected):
    assert one(spark, redact_digits("v"), value) == expected


@pytest.mark.parametrize("born,as_of,years,bracket", [
    (dt.date(2000, 2, 29), dt.date(2023, 2, 28), 22, "18-24"),
    (dt.date(2000, 2, 29), dt.date(2023, 3, 1), 23, "18-24"),
    (dt.date(2001, 7, 14), dt.date(2026, 7, 13), 24, "18-24"),   # day before the 25th birthday
    (dt.date(2001, 7, 13), dt.date(2026, 7, 13), 25, "25-34"),
    (dt.date(2009, 1, 1), dt.date(2026, 7, 13), 17, "18-24"),    # under 18 -> youngest bracket
    (dt.date(1950, 1, 1), dt.date(2026, 7, 13), 76, "65+"),
    (None, dt.date(2026, 7, 13), None, "65+"),                   # NULL falls through to the oldest
])
def test_age(spark, born, as_of, years, bracket):
    df = spark.createDataFrame([(born,)], "d date")
    r = df.select(completed_years("d", as_of).alias("y"), age_bracket("d", as_of).alias("b")).first()
    assert (r["y"], r["b"]) == (years, bracket)


def test_keys(spark):
    df = spark.createDataFrame([("C1", None), ("", "x"), (None, "y")], "a string, b string")
    got = [tuple(r) for r in df.select(nullable_key("a"), surrogate_key("a", "b")).collect()]
    import hashlib
    assert got[0] == (hashlib.md5(b"C1").hexdigest(), None)
    assert got[1] == (None, hashlib.md5(b"x").hexdigest())
    assert got[2] == (None, None)
    ts = spark.createDataFrame([("C1",)], "k string").select(
        scd_id("k", F.lit("2026-07-13 10:11:12").cast("timestamp"))).first()[0]
    assert ts == hashlib.md5(b"C1|2026-07-13 10:11:12").hexdigest()


def test_casts(spark):
    df = spark.createDataFrame([("12.345", "-12.345", "2026-07-13")], "a string, b string, d string")
    r = df.select(to_amount("a").alias("a"), to_amount("b").alias("b"), to_date("d").alias("d")).first()
    assert str(r["a"]) == "12.35" and str(r["b"]) == "-12.35" and r["d"] == dt.date(2026, 7, 13)
    bad = spark.createDataFrame([("20260713x",)], "d string")
    assert bad.select(to_date("d", strict=False)).first()[0] is None
    with pytest.raises(Exception):
        bad.select(to_date("d")).collect()
    t = spark.createDataFrame([(dt.datetime(2026, 7, 13, 10, 11, 12, 120000),)], "t timestamp")
    assert t.select(to_text("t")).first()[0] == "2026-07-13 10:11:12.12"


def test_sql_functions_equal_their_column_forms(spark):
    """On whole tables, with NULL, empty and short values."""
    import datetime as dt

    from pyspark.sql import functions as F

    from tidemark import functions as C
    from tidemark.functions.sql import FUNCTIONS, register
    assert register(spark) == list(FUNCTIONS)
    cust = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select(
        F.col("c_name").alias("s"), F.date_add(F.lit(dt.date(1940, 2, 28)), (F.col("c_custkey") * 97 % 30000).cast("int")).alias("d"))
    odd = spark.createDataFrame([(None, None), ("", dt.date(2004, 2, 29)), ("a", dt.date(2010, 7, 13)), ("no at", None), ("x@y@z", None),
                                 ("1234", None), ("é9è88", dt.date(1961, 7, 14))], "s string, d date")
    rows = cust.unionByName(odd)
    as_of, run = dt.date(2026, 7, 13), F.timestamp_micros(F.lit(1_784_000_000_000_000))
    pairs = {"mask_name(s)": C.mask_name("s"), "mask_phone(s)": C.mask_phone("s"), "mask_email(s)": C.mask_email("s"),
             "redact_digits(s)": C.redact_digits("s"), "completed_years(d, DATE '2026-07-13')": C.completed_years("d", as_of),
             "age_bracket(d, DATE '2026-07-13')": C.age_bracket("d", as_of), "surrogate_key(s)": C.surrogate_key("s"),
             "nullable_key(s)": C.nullable_key("s"), "versioned_key(s, r)": C.versioned_key("s", "r"), "scd_id(s, r)": C.scd_id("s", "r")}
    rows = rows.withColumn("r", run)
    wrong = rows.select(*[F.sum((~F.expr(e).eqNullSafe(c)).cast("int")).alias(e) for e, c in pairs.items()]).first().asDict()
    assert set(wrong.values()) == {0}, wrong
