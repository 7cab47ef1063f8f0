"""Segment positions never decrease with the value they route (for every supported type)."""

import datetime as dt
import random

import pytest

from tidemark.operators.scan import order_position

rnd = random.Random(9)
BASE = dt.datetime(2024, 1, 1)

CASES = {
    "long": ("v long", [rnd.randrange(-10**15, 10**15) for _ in range(200)] + [None]),
    "int": ("v int", [rnd.randrange(-10**6, 10**6) for _ in range(200)]),
    "double": ("v double", [rnd.uniform(-1e6, 1e6) for _ in range(200)] + [-0.5, 0.5, 0.0]),
    "date": ("v date", [dt.date(1990, 1, 1) + dt.timedelta(days=rnd.randrange(20000)) for _ in range(200)]),
    "timestamp": ("v timestamp", [BASE + dt.timedelta(microseconds=rnd.randrange(10**12)) for _ in range(200)]),
    "timestamp_ntz": ("v timestamp_ntz", [BASE - dt.timedelta(microseconds=rnd.randrange(10**13)) for _ in range(200)]),
    "string": ("v string", ["".join(rnd.choice("aé\x00z9") for _ in range(rnd.randrange(12))) for _ in range(300)]),
}


@pytest.mark.parametrize("name", list(CASES))
def test_position_is_monotone(spark, name):
    schema, values = CASES[name]
    df = spark.createDataFrame([(v,) for v in values], schema)
    rows = df.select("v", order_position(df, "v").alias("p")).orderBy(df["v"].asc_nulls_first()).collect()
    positions = [r["p"] for r in rows if r["v"] is not None]
    assert all(a <= b for a, b in zip(positions, positions[1:]))
