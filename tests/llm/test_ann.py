import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import ann

SCHEMA = "vec_id long, embedding array<float>, vec string"


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        score = x.astype(float) @ x[ids.index(q)].astype(float)
        order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-score[i], ids[i]))[:k]
        out[q] = [(ids[i], score[i]) for i in order]
    return out


def search(spark, rows, k=20):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return got


def test_recall_against_brute_force(spark):
    r = np.random.default_rng(2)
    centres = r.normal(size=(40, 32))
    x = (centres[r.integers(0, 40, 9000)] + 0.6 * r.normal(size=(9000, 32))).astype(np.float32)
    ids = list(range(9000))
    got = search(spark, [(i, v.tolist(), "x") for i, v in zip(ids, x)])
    want = brute(ids, x, range(0, 9000, 20), 20)
    assert got.keys() == want.keys()
    hits = 0
    for q, found in got.items():
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(np.isclose(s, x[v].astype(float) @ x[q].astype(float)) for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        hits += len({f[1] for f in found} & {w[0] for w in want[q]})
    assert hits / (20 * len(want)) >= 0.9


def test_copies_ties_and_vectors_that_take_no_part(spark):
    one, other = [1.0, 0.0], [0.0, 1.0]
    rows = [(i, one, "x") for i in range(60)] + [(100, other, "x"), (101, None, "x"), (102, [0.0, 0.0], "x"), (103, [1.0, None], "x"),
                                                 (104, [float("nan"), 1.0], "x"), (105, [float("inf"), 1.0], None), (None, one, "x"), (120, [], "x"),
                                                 (140, None, "x"), (160, [0.0, 0.0], "x")]
    got = search(spark, rows)
    assert set(got) == {0, 20, 40, 100}
    assert [v for _, v, _ in got[0]] == list(range(1, 21))
    assert [v for _, v, _ in got[20]] == [i for i in range(21) if i != 20]
    assert [(v, s) for _, v, s in got[100]] == [(i, 0.0) for i in range(20)]


def test_as_many_as_asked_where_parts_hold_fewer(spark):
    r = np.random.default_rng(3)
    x = 20 * r.normal(size=(8, 16))[np.arange(600) % 8] + r.normal(size=(600, 16))
    got = search(spark, [(i, v.tolist(), "x") for i, v in enumerate(x)], k=300)
    assert set(got) == set(range(0, 600, 20)) and {len(found) for found in got.values()} == {300}


def test_fewer_candidates_than_asked(spark):
    got = search(spark, [(0, [1.0, 2.0], "x"), (7, [2.0, 1.0], "x"), (3, [-1.0, 0.0], "x")])
    assert got == {0: [(1, 7, 4.0), (2, 3, -1.0)]}
    assert search(spark, [(0, [1.0], "x")]) == {} and search(spark, []) == {}


def test_hundreds_of_tied_vectors_go_by_id(spark):
    """Distinct vectors of one score: ties go to smaller ids, however many there are."""
    rows = [(i, [1.0, float(i % 97), 0.0], "x") for i in range(1, 500)] + [(0, [1.0, 0.0, 0.0], "x")]
    got = search(spark, rows)
    assert [v for _, v, _ in got[0]] == list(range(1, 21))
    assert {s for _, _, s in got[0]} == {1.0}
