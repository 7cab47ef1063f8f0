import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.history import lookup_version, merge_timelines, replay_snapshots, snapshot_check
from tidemark.operators.load import DuplicateKeyError
from tidemark.operators.scan import plan_segments
from tests.conftest import rows

D = [dt.datetime(2026, 7, d) for d in range(1, 29)]
SRC = "customer_id string, status string, name string"


def snap_rows(df):
    return rows(df, "customer_id", "status", "name", "valid_from", "valid_to")


def test_snapshot_check_cases(spark):
    s1 = spark.createDataFrame([("c", "active", "A"), ("u", "active", "B"), ("n", None, "C"),
                                ("v", "active", "D"), ("g", "active", "E")], SRC)
    snap = snapshot_check(None, s1, "customer_id", ["status"], D[0])
    assert len(snap.collect()) == 5
    s2 = spark.createDataFrame([
        ("c", "blocked", "A"),      # checked column changes -> close + open
        ("u", "active", "B2"),      # only an unchecked column changes -> nothing
        ("n", "active", "C"),       # NULL -> value
        ("v", None, "D"),           # value -> NULL
        ("new", "active", "F"),     # new key
    ], SRC)                        # "g" vanished -> stays open
    snap2 = snapshot_check(snap, s2, "customer_id", ["status"], D[1])
    assert snap_rows(snap2) == sorted([
        ("c", "active", "A", D[0], D[1]), ("c", "blocked", "A", D[1], None),
        ("g", "active", "E", D[0], None),
        ("n", None, "C", D[0], D[1]), ("n", "active", "C", D[1], None),
        ("new", "active", "F", D[1], None),
        ("u", "active", "B", D[0], None),
        ("v", "active", "D", D[0], D[1]), ("v", None, "D", D[1], None),
    ], key=lambda t: tuple((x is None, str(x)) for x in t))
    # same data, later clock: nothing changes
    snap3 = snapshot_check(snap2, s2, "customer_id", ["status"], D[2])
    assert snap_rows(snap3) == snap_rows(snap2)
    ids = [r["scd_id"] for r in snap2.collect()]
    assert len(ids) == len(set(ids))
    with pytest.raises(DuplicateKeyError):
        snapshot_check(snap, spark.createDataFrame([("c", "a", "x"), ("c", "b", "y")], SRC), "customer_id",
                       ["status"], D[3])


HIST = "k string, valid_from timestamp, valid_to timestamp, a string"


def test_merge_timelines_cases(spark):
    h1 = spark.createDataFrame([("x", D[0], D[2], "s1"), ("x", D[2], None, "s2"), ("only1", D[0], None, "o")], HIST)
    h2 = spark.createDataFrame([("x", D[1], D[2], "a1"), ("x", D[2], D[3], "a2"), ("x", D[3], None, "a3")],
                               HIST).withColumnRenamed("a", "b")
    out = merge_timelines([(h1, ["a"]), (h2, ["b"])], "k")
    got = rows(out, "k", "valid_from", "valid_to", "a", "b")
    assert got == sorted([
        ("only1", D[0], None, "o", None),               # key in one history only
        ("x", D[0], D[1], "s1", None),
        ("x", D[1], D[2], "s1", "a1"),
        ("x", D[2], D[3], "s2", "a2"),                   # both change at the same instant: one point
        ("x", D[3], None, "s2", "a3"),
    ], key=lambda t: tuple((x is None, str(x)) for x in t))


FACT = "fid long, k string, ts timestamp"


def test_lookup_version_boundaries(spark):
    versions = spark.createDataFrame([("x", D[5], D[10], "v1"), ("x", D[10], None, "v2"),
                                      ("gap", D[5], D[6], "g1"), ("gap", D[8], None, "g2")], HIST)
    facts = spark.createDataFrame([
        (1, "x", D[5]),     # ts = valid_from -> v1
        (2, "x", D[10]),    # ts = valid_to -> next version
        (3, "x", D[1]),     # before the first version: back-dated v1, or nothing
        (4, "unknown", D[7]),
        (5, None, D[7]),
        (6, "x", None),
        (7, "gap", D[7]),   # in a gap between versions
        (8, "x", D[20]),
    ], FACT)
    for method in ("scan", "join"):
        got = dict(rows(lookup_version(facts, versions, "k", "ts", columns=["a"], method=method), "fid", "a"))
        assert got == {1: "v1", 2: "v2", 3: "v1", 4: None, 5: None, 6: None, 7: None, 8: "v2"}, method
        got = dict(rows(lookup_version(facts, versions, "k", "ts", columns=["a"], backdate_first=False,
                                       method=method), "fid", "a"))
        assert got[3] is None and got[1] == "v1"


def _random_case(spark, seed, n_keys=6, n_facts=400):
    rnd = random.Random(seed)
    vers, facts = [], []
    for k in range(n_keys):
        starts = sorted(rnd.sample(range(0, 200), rnd.randint(1, 8)))
        for i, s0 in enumerate(starts):
            end = starts[i + 1] if i + 1 < len(starts) else None
            if end is not None and rnd.random() < 0.2:
                end = s0 + (end - s0) // 2 or None       # leave a gap now and then
            vers.append((f"k{k}", dt.datetime(2026, 1, 1) + dt.timedelta(hours=s0),
                         None if end is None else dt.datetime(2026, 1, 1) + dt.timedelta(hours=end), f"k{k}v{i}"))
    hot = "k0"   # one key holds most facts
    for i in range(n_facts):
        k = hot if rnd.random() < 0.6 else (f"k{rnd.randrange(n_keys + 1)}" if rnd.random() < 0.95 else None)
        h = rnd.randrange(-20, 230)
        facts.append((i, k, None if rnd.random() < 0.02 else dt.datetime(2026, 1, 1) + dt.timedelta(hours=h)))
    return spark.createDataFrame(vers, HIST), spark.createDataFrame(facts, FACT)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lookup_scan_equals_join_with_hot_keys(spark, seed):
    versions, facts = _random_case(spark, seed)
    ref = rows(lookup_version(facts, versions, "k", "ts", columns=["a"], method="join"))
    for opts in ({}, {"rows_per_segment": 10, "bands": 4},
                 {"rows_per_segment": 60, "sample_rows": 20}):          # sampled detection
        for back in (True, False):
            got = rows(lookup_version(facts, versions, "k", "ts", columns=["a"], backdate_first=back, **opts))
            want = ref if back else rows(lookup_version(facts, versions, "k", "ts", columns=["a"],
                                                        backdate_first=False, method="join"))
            assert got == want
    assert len(ref) == facts.count()          # the lookup never changes the fact count


def _fold(spark, obs, runs):
    snap = None
    for r in runs:
        src = obs.filter(F.col("run") == r).select("k", "s")
        if src.count() == 0:
            continue
        snap = snapshot_check(snap, src, "k", ["s"], r)
    return snap


def test_replay_equals_folding_snapshots(spark):
    rnd = random.Random(7)
    runs = D[:8]
    data = [(f"k{k}", r, rnd.choice(["a", "b", None])) for k in range(5) for r in runs if rnd.random() < 0.8]
    obs = spark.createDataFrame(data, "k string, run timestamp, s string")
    folded = _fold(spark, obs, runs)
    for opts in ({}, {"rows_per_segment": 2, "bands": 2}):
        replayed = replay_snapshots(obs, "k", "run", ["s"], **opts)
        assert rows(replayed, "k", "s", "valid_from", "valid_to") == rows(folded, "k", "s", "valid_from", "valid_to")


def test_merge_timelines_properties(spark):
    rnd = random.Random(11)
    def history(col):
        out = []
        for k in range(4):
            starts = sorted(rnd.sample(range(50), rnd.randint(1, 6)))
            for i, s0 in enumerate(starts):
                end = starts[i + 1] if i + 1 < len(starts) else None
                out.append((f"k{k}", D[0] + dt.timedelta(hours=s0),
                            None if end is None else D[0] + dt.timedelta(hours=end), f"{col}{i}"))
        return spark.createDataFrame(out, HIST).withColumnRenamed("a", col)
    h1, h2 = history("a"), history("b")
    plain = merge_timelines([(h1, ["a"]), (h2, ["b"])], "k")
    assert rows(plain) == rows(merge_timelines([(h1, ["a"]), (h2, ["b"])], "k", method="join"))
    split = merge_timelines([(h1, ["a"]), (h2, ["b"])], "k", rows_per_segment=2, bands=2)
    assert rows(plain) == rows(split)
    per_key = {}
    for r in plain.collect():
        per_key.setdefault(r["k"], []).append((r["valid_from"], r["valid_to"]))
    for spans in per_key.values():
        spans.sort()
        assert sum(1 for _, e in spans if e is None) == 1            # exactly one current row
        for (s0, e0), (s1, _) in zip(spans, spans[1:]):
            assert e0 == s1                                          # no gaps, no overlaps


def test_overlap_guard(spark):
    from tidemark.operators.history import OverlappingVersionsError, overlapping_versions
    v = spark.createDataFrame([("x", D[0], D[5], "a"), ("x", D[3], D[8], "b"),      # b starts inside a
                               ("x", D[8], None, "c"), ("x", D[9], D[10], "d"),     # d starts while c is open
                               ("y", D[0], D[2], "e"), ("y", D[2], None, "f")], HIST)  # touching, fine
    for opts in ({}, {"rows_per_segment": 1, "bands": 2}):
        assert rows(overlapping_versions(v, "k", **opts), "a") == [("b",), ("d",)]
    facts = spark.createDataFrame([(1, "x", D[4])], FACT)
    with pytest.raises(OverlappingVersionsError):
        lookup_version(facts, v, "k", "ts", columns=["a"], check_overlap=True)
    ok = v.filter(F.col("k") == "y")
    assert rows(lookup_version(facts, ok, "k", "ts", columns=["a"], check_overlap=True), "fid", "a") == [(1, None)]


def test_hot_key_is_split_into_bounded_segments(spark):
    from tidemark.operators.scan import SEG, plan_segments
    rnd = random.Random(3)
    data = [("hot" if i % 3 else f"k{i % 50}", D[0] + dt.timedelta(minutes=rnd.randrange(40000))) for i in range(6000)]
    df = spark.createDataFrame(data, "k string, t timestamp")
    segs = plan_segments(df, ["k"], "t", rows_per_segment=500, bands=8)
    sizes = {(r["k"], r[SEG]): r["n"] for r in segs.assign(df).groupBy("k", SEG).count().withColumnRenamed("count", "n").collect()}
    hot = [n for (k, _), n in sizes.items() if k == "hot"]
    assert len(hot) >= 8                                  # the hot key (4,000 rows) is spread out
    assert max(hot) <= 2 * 500                            # no segment far above the target
    assert all(seg == 0 for (k, seg) in sizes if k != "hot")   # cold keys stay whole


def test_lookup_salts_facts_that_share_one_instant(spark):
    # one hot key: 3,000 facts at a single instant (date-grained), versions around it
    from tidemark.operators import scan as S
    facts = spark.createDataFrame([(i, "hot", D[5]) for i in range(3000)] + [(9000 + i, "k", D[i % 20]) for i in range(40)],
                                  FACT)
    versions = spark.createDataFrame([("hot", D[1], D[5], "h1"), ("hot", D[5], D[9], "h2"), ("hot", D[9], None, "h3"),
                                      ("k", D[3], None, "k1")], HIST)
    ref = rows(lookup_version(facts, versions, "k", "ts", columns=["a"], method="join"))
    calls = []
    orig = S.salt_readers
    def spy(*a, **k):
        out = orig(*a, **k)
        calls.append(out.select("_salt").distinct().count())
        return out
    import tidemark.operators.history as H
    H.salt_readers = spy
    try:
        got = rows(lookup_version(facts, versions, "k", "ts", columns=["a"], rows_per_segment=500, bands=4))
    finally:
        H.salt_readers = orig
    assert got == ref
    assert calls and calls[0] >= 6          # 3,000 tied facts spread over >= 6 salts of <= 500


def test_sampled_detection_finds_the_hot_key(spark):
    from tidemark.operators.scan import SEG, plan_segments
    rnd = random.Random(5)
    data = [("hot" if i % 3 else f"k{i % 50}", D[0] + dt.timedelta(minutes=rnd.randrange(40000))) for i in range(6000)]
    df = spark.createDataFrame(data, "k string, t timestamp")
    segs = plan_segments(df, ["k"], "t", rows_per_segment=500, sample_rows=100)    # samples 20% of rows
    hot = [r["k"] for r in segs.splits.select("k").collect()]
    assert hot == ["hot"]
    sizes = [r["count"] for r in segs.assign(df).filter("k = 'hot'").groupBy(SEG).count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 2 * 500


def test_bands_are_found_by_halving(spark):
    from tidemark.operators.scan import _count_upto
    bands = [1, 3, 3, 7, 20]
    df = spark.createDataFrame([(v, b) for v in (0, 1, 2, 3, 7, 19, 20, 99) for b in (bands, [], list(range(1023)))],
                               "v long, q array<long>")
    for r in df.withColumn("n", _count_upto("q", "v")).collect():
        assert r["n"] == sum(x <= r["v"] for x in r["q"])


def test_assigning_a_segment_does_not_pass_over_all_bands(spark):
    df = spark.range(3000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    plan = plan_segments(df, ["k"], "t", rows_per_segment=100, bands=8).assign(df)
    assert "filter(_q" not in plan._jdf.queryExecution().toString() and plan.select("_seg").distinct().count() >= 8


def test_a_fact_without_further_columns_and_a_given_sample(spark):
    facts = spark.createDataFrame([("a", 5), ("a", 1), ("b", 5), (None, 5)], "k string, t int")
    versions = spark.createDataFrame([("a", 2, None, "x")], "k string, valid_from int, valid_to int, v string")
    asked = []
    sample = lambda fraction: asked.append(fraction) or facts.select("k")
    got = lookup_version(facts, versions, "k", "t", columns=["v"], sample_facts=sample)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("a", 5, "x"), ("a", 1, "x"), ("b", 5, None), (None, 5, None)], key=str) and len(asked) == 1
