import random
import re

import numpy as np
import pytest

from tidemark.llm import mixing


def brute_seats(votes, seats, most):
    got = [0] * len(votes)
    for _ in range(min(seats, sum(m for v, m in zip(votes, most) if v > 0))):
        i = max((i for i in range(len(votes)) if votes[i] > 0 and got[i] < most[i]),
                key=lambda i: (votes[i] / (2 * got[i] + 1), -i))
        got[i] += 1
    return got


@pytest.mark.parametrize("seed", range(30))
def test_seats_equal_the_highest_quotients(seed):
    r = random.Random(seed)
    n = r.randint(1, 8)
    votes = [r.choice([0, 5, 10, 10, r.randint(1, 1000)]) for _ in range(n)]
    most = [r.choice([0, 1, 3, 50]) for _ in range(n)]
    seats = r.randint(0, 60)
    assert mixing.sainte_lague(np.array(votes), seats, np.array(most)).tolist() == brute_seats(votes, seats, most)


def brute_targets(size, weight, total, limit):
    target, open_ = [0.0] * len(size), set(range(len(size)))
    rest = total
    while open_:
        w = sum(weight[i] for i in open_)
        over = {i for i in open_ if rest * weight[i] / w > limit[i]}
        if not over:
            for i in open_:
                target[i] = rest * weight[i] / w
            break
        for i in over:
            target[i] = limit[i]
        rest -= sum(limit[i] for i in over)
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(20))
def test_targets_share_the_excess_again(seed):
    r = random.Random(seed)
    size = np.array([r.randint(0, 500) for _ in range(r.randint(1, 9))])
    weight = np.resize(np.array([3.0, 1.0, 2.0]), len(size))
    got = mixing.fill_targets(size, weight, 1.5 * size.sum(), 2.0 * size)
    assert np.allclose(got, brute_targets(size, weight, 1.5 * size.sum(), 2.0 * size))


SCHEMA = "doc_id long, source string, text string, _size string, n_chars long"


def corpus(spark, n=600):
    r = random.Random(5)
    rows = [(i, r.choice(["a", "a", "a", "b", "c", None]), " ".join(["w"] * r.randint(0, 40)), "x", 1) for i in range(n)]
    rows += [(n, "a", None, "x", None), (n + 1, "b", "", None, 1), (n + 2, "c", "long " * 20_000, "x", 1), (3, "a", "w w w", "x", 1),
             (3, "a", "w w w", "x", 1), (None, "b", "v v", "x", 1)]
    return spark.createDataFrame(rows, SCHEMA), rows


def test_mix_comes_near_its_targets(spark):
    docs, rows = corpus(spark)
    got = mixing.mix_sizes(docs).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted({r[1] for r in rows}, key=lambda s: (s is None, s or ""))
    totals = {s: sum(size(r[2]) for r in rows if r[1] == s) for s in names}
    want = brute_targets([totals[s] for s in names], [3, 1, 2, 3][:len(names)], 1.5 * sum(totals.values()),
                         [2 * totals[s] for s in names])
    for s, target in zip(names, want):
        mine = [r for r in got if r["source"] == s]
        assert sum(r["size"] for r in mine) == totals[s]
        assert all(r["source_size"] == totals[s] and r["target"] == pytest.approx(target) for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target) <= 2 * mixing.BLOCK_TOKENS + 1
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    again = mixing.mix_sizes(docs.repartition(5)).collect()
    key = lambda rs: sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in rs)
    assert key(got) == key(again)


def test_mixed_documents_hold_the_words_taken(spark):
    docs, _ = corpus(spark)
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    words = {}
    for r in out.collect():
        words[r["source"]] = words.get(r["source"], 0) + len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    taken = {}
    for r in mixing.mix_sizes(docs).collect():
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert words == {s: n for s, n in taken.items() if n}


def test_shards_of_a_large_source_keep_the_target(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "if(id % 10 = 0, 'b', 'a') as source", "repeat('w ', 30) as text")
    got = mixing.mix_sizes(docs, shard_tokens=4096).groupBy("source").agg(
        {"taken": "sum", "target": "max"}).collect()
    for r in got:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 2 * mixing.BLOCK_TOKENS * 30


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_sizes(docs).count() == 0 and mixing.mix_documents(docs).count() == 0


def test_many_tiny_sources_beside_a_large_one(spark):
    rows = [(i, f"s{i:02d}", "a b c d e", "x", 1) for i in range(60)] + [(100 + i, "s99", "w " * 40, "x", 1) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix_sizes(docs).groupBy("source").agg({"taken": "sum", "target": "max", "size": "sum"}).collect()
    for r in got:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= max(1, 0.01 * r["max(target)"]), r
    assert len(got) == 61 and all(r["sum(taken)"] > 0 for r in got)
    assert mixing.mix_documents(docs).where("source = 's07'").count() >= 1
