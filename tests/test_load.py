import datetime as dt

import pytest
from tidemark.operators.incremental import after_high_water, append_new, merge_by_key, replace_by_key
from tidemark.operators.load import (DuplicateKeyError, insert_absent, require_unique, stamp_load,
                                     upsert_latest)
from tests.conftest import rows

S = "k string, v string"


def test_require_unique(spark):
    with pytest.raises(DuplicateKeyError):
        require_unique(spark.createDataFrame([("a", "1"), ("a", "2")], S), "k")
    with pytest.raises(DuplicateKeyError):
        require_unique(spark.createDataFrame([(None, "1")], S), "k")
    require_unique(spark.createDataFrame([("a", "1"), ("b", "1")], S), "k")


def test_upsert_latest_cases(spark):
    target = spark.createDataFrame([("same", "1"), ("changed", "1"), ("kept", "1")], S)
    batch = spark.createDataFrame([("same", "1"), ("changed", "2"), ("new", "9")], S)
    out = upsert_latest(target, batch, "k")
    assert rows(out) == sorted([("same", "1"), ("changed", "2"), ("kept", "1"), ("new", "9")])
    # upsert twice == once
    assert rows(upsert_latest(out, batch, "k")) == rows(out)
    empty = spark.createDataFrame([], S)
    assert rows(upsert_latest(target, empty, "k")) == rows(target)
    assert rows(upsert_latest(None, batch, "k")) == rows(batch)
    assert rows(upsert_latest(empty, batch, "k")) == rows(batch)


def test_insert_absent_first_wins(spark):
    target = spark.createDataFrame([("a", "old")], S)
    batch = spark.createDataFrame([("a", "new"), ("b", "new")], S)
    out = insert_absent(target, batch, "k")
    assert rows(out) == [("a", "old"), ("b", "new")]
    assert rows(insert_absent(out, batch, "k")) == rows(out)
    with pytest.raises(DuplicateKeyError):
        insert_absent(target, spark.createDataFrame([("c", "1"), ("c", "2")], S), "k")


def test_stamp_is_one_value(spark):
    ts = dt.datetime(2026, 7, 13, 1, 2, 3)
    out = stamp_load(spark.createDataFrame([("a", "1"), ("b", "2")], S), ts)
    assert {r["dwh_load_date"] for r in out.collect()} == {ts}


def test_after_high_water(spark):
    s = "k string, t timestamp"
    t0, t1 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    target = spark.createDataFrame([("a", t0)], s)
    source = spark.createDataFrame([("a", t0), ("b", t1)], s)
    assert rows(after_high_water(source, target, "t")) == [("b", t1)]       # equal to max -> out
    assert rows(after_high_water(source, spark.createDataFrame([], s), "t")) == rows(source)  # empty -> all
    assert rows(after_high_water(source, None, "t")) == rows(source)
    assert rows(append_new(target, source, "t")) == [("a", t0), ("b", t1)]


def test_merge_and_replace(spark):
    s = "k string, v string, t timestamp"
    t0, t1 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    target = spark.createDataFrame([("a", "1", t0), ("b", "1", t0)], s)
    source = spark.createDataFrame([("a", "stale", t0), ("b", "2", t1), ("c", "3", t1)], s)
    assert rows(merge_by_key(target, source, "k", "t")) == [("a", "1", t0), ("b", "2", t1), ("c", "3", t1)]
    batch = spark.createDataFrame([("b", "x", t1), ("b", "y", t1)], s)     # duplicates are kept
    assert rows(replace_by_key(target, batch, "k")) == [("a", "1", t0), ("b", "x", t1), ("b", "y", t1)]


def test_fits_is_a_bounded_check(spark):
    from tidemark.operators.sizing import fits, lookup_join
    big = spark.range(0, 100_000, numPartitions=50)
    assert not fits(big, 1000)
    assert fits(big, 100_000)
    small = spark.createDataFrame([(1, "x")], "id long, name string")
    joined = lookup_join(spark.range(5), small, "id", "left", max_rows=10)
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_high_water_on_wall_clock_time_ignores_the_session_zone(spark):
    s = "k string, t timestamp_ntz"
    t0, t1 = dt.datetime(2026, 1, 1, 23, 30), dt.datetime(2026, 1, 2, 0, 30)
    target = spark.createDataFrame([("a", t0)], s)
    source = spark.createDataFrame([("a", t0), ("b", t1)], s)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Almaty")
        assert rows(after_high_water(source, target, "t")) == [("b", t1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
