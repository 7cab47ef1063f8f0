"""Physical-plan properties the scale design relies on."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators.history import lookup_version
from tidemark.operators.incremental import after_high_water
from tidemark.operators.latest import latest_by_key
from tidemark.plans import analogues as A

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_lookup_shuffles_the_union_once(spark):
    out = A.asof_fact(spark, SF)
    text = plan(out)
    union_shuffles = set(re.findall(r"Exchange hashpartitioning\(_k0#\d+L, _seg#\d+[^\n]*\[plan_id=(\d+)\]", text))
    assert len(union_shuffles) == 1
    assert text.count("FileScan parquet") >= 1 and "lineitem.parquet" in text


def test_high_water_mark_reaches_the_scan(spark):
    events = A.load(spark, SF, "events")
    target = events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    text = plan(after_high_water(events, target, "ts"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(ts,", text)


def test_latest_by_key_aggregates_before_the_shuffle(spark):
    events = A.load(spark, SF, "events")
    text = plan(latest_by_key(events, "user_id", "ts", tiebreak=["event_id"]))
    partial = text.find("partial_max_by")
    assert partial > 0 and text.rfind("Exchange hashpartitioning(user_id") < partial


def test_small_lookup_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(A.dim_supplier(spark, SF))


@pytest.mark.parametrize("name", [n for n in A.QUERIES if n != "stream_landing"])
def test_no_nested_loops_cartesian_or_python(spark, name):
    text = plan(A.QUERIES[name](spark, SF))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text, (name, bad)


def test_the_fact_shuffles_no_text_of_its_lookup_tables(spark, monkeypatch):
    from tidemark.plans import gold
    moved = []
    real = gold.lookup_version
    monkeypatch.setattr(gold, "lookup_version", lambda facts, *a, **k: moved.append(facts.columns) or real(facts, *a, **k))
    tx = spark.sql("""SELECT 't1' transaction_id, TIMESTAMP'2026-01-01 00:00:00' transaction_timestamp, 'a' account_id, 'c' card_id,
        'm' merchant_id, 'fee' transaction_type, 'GBP' currency_code, 1 amount, 'approved' status, TIMESTAMP'2026-01-02 00:00:00' dwh_load_date""")
    types = spark.sql("SELECT 'fee' transaction_type, 'a fee' description")
    currencies = spark.sql("SELECT 'GBP' currency_code, 'pound' currency_name")
    accounts = spark.sql("SELECT 'a' account_id, 'c1' customer_id")
    customers = spark.sql("SELECT 'c1' customer_id, 'sk' customer_sk, TIMESTAMP'2026-01-01 00:00:00' valid_from, CAST(NULL AS TIMESTAMP) valid_to")
    row = gold.fact_rows(tx, types, currencies, accounts, customers).first()
    assert (row["transaction_type_description"], row["currency_name"], row["customer_sk"]) == ("a fee", "pound", "sk")
    assert not {"transaction_type_description", "currency_name"} & set(moved[0])
