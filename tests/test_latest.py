import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.latest import (eligible, latest_by_key, next_ids, number_within_key, overlay_latest,
                                       state_as_of)
from tests.conftest import rows


def test_latest_by_key_null_first_and_ties(spark):
    s = "k string, t timestamp, id string, v string"
    t0, t1 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    df = spark.createDataFrame([
        ("nullwins", t1, "1", "dated"), ("nullwins", None, "2", "undated"),
        ("tie", t1, "1", "low"), ("tie", t1, "2", "high"),
        ("one", t0, "1", "only"),
    ], s)
    got = {r["k"]: r["v"] for r in latest_by_key(df, "k", "t", tiebreak=["id"]).collect()}
    assert got == {"nullwins": "undated", "tie": "high", "one": "only"}
    got = {r["k"]: r["v"] for r in latest_by_key(df, "k", "t", tiebreak=["id"], nulls_first=False).collect()}
    assert got["nullwins"] == "dated"


def test_overlay(spark):
    base = spark.createDataFrame([("a", "active"), ("b", "active")], "k string, status string")
    latest = spark.createDataFrame([("a", "blocked"), ("z", "closed")], "k string, s string")
    assert rows(overlay_latest(base, latest, "k", {"status": "s"})) == [("a", "blocked"), ("b", "active")]


def test_state_as_of_folds_batches_before_date(spark):
    base = spark.createDataFrame([("C1", "active"), ("C2", "active"), ("C3", "active")], "id string, status string")
    adds = spark.createDataFrame([("C4", "active", dt.date(2026, 7, 1)), ("C5", "active", dt.date(2026, 7, 3)),
                                  ("C2", "active", dt.date(2026, 7, 2))],
                                 "id string, status string, batch_date date")
    chg = spark.createDataFrame([("C1", "blocked", dt.date(2026, 7, 1)), ("C1", "closed", dt.date(2026, 7, 2)),
                                 ("C2", "blocked", dt.date(2026, 7, 1)), ("C4", "blocked", dt.date(2026, 7, 1)),
                                 ("C3", "blocked", dt.date(2026, 7, 3))],
                                "id string, new_status string, batch_date date")
    out = state_as_of(base, "id", F.lit("2026-07-03").cast("date"), additions=adds, changes=chg,
                      change_columns={"status": "new_status"})
    # Last change before the date; C2: re-added after its change; C4: added and changed the same day
    # (changes fold after additions); C3: change on the cut-off date is excluded; C5 not yet added.
    assert rows(out) == [("C1", "closed"), ("C2", "active"), ("C3", "active"), ("C4", "blocked")]


def test_eligible_two_levels(spark):
    cust = spark.createDataFrame([("C1", "active"), ("C2", "blocked")], "customer_id string, status string")
    acc = spark.createDataFrame([("A1", "C1", "active"), ("A2", "C2", "active"), ("A3", "C1", "closed")],
                                "account_id string, customer_id string, status string")
    ok = eligible(acc, cust, "customer_id", "customer_id", child_filter=F.col("status") == "active",
                  parent_filter=F.col("status") == "active")
    assert rows(ok, "account_id") == [("A1",)]


def test_number_within_key_and_next_ids(spark):
    df = spark.createDataFrame([("A", "c3"), ("A", "c1"), ("A", "c2"), ("B", "c9")], "acc string, card string")
    for opts in ({}, {"rows_per_segment": 1, "bands": 2}, {"method": "sort"}):
        got = rows(number_within_key(df, "acc", ["card"], **opts), "acc", "card", "ordinal", "group_size")
        assert got == [("A", "c1", 1, 3), ("A", "c2", 2, 3), ("A", "c3", 3, 3), ("B", "c9", 1, 1)]
    ids = spark.createDataFrame([(k,) for k in [5, 3, 9, 1]], "k long").repartition(3)
    assert rows(next_ids(ids, 100, ["k"])) == [(1, 101), (3, 102), (5, 103), (9, 104)]


def test_number_within_key_sort_splits_ties(spark):
    # one hot key whose rows all share the first order value
    data = [("hot", 1, i) for i in range(500)] + [("cold", 2, i) for i in range(3)]
    df = spark.createDataFrame(data, "k string, a int, b int").repartition(4)
    got = rows(number_within_key(df, "k", ["a", "b"], method="sort"), "k", "b", "ordinal", "group_size")
    want = sorted([("hot", i, i + 1, 500) for i in range(500)] + [("cold", i, i + 1, 3) for i in range(3)],
                  key=lambda t: tuple((x is None, str(x)) for x in t))
    assert got == want
