import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import neardup, setsketch
from tidemark.llm.components import components


def shingles(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: (len(sets[i]), least[root(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)}


def corpus(seed=7):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(25):
        text = r.choices(words, k=r.choice([3, 5, 8, 60, 200, 400]))
        for _ in range(r.choice([1, 2, 3, 12])):
            own = list(text)
            for _ in range(r.choice([0, 0, 1, 2, 3])):
                own[r.randrange(len(own))] = r.choice(words)
            rows.append(" ".join(own))
        # a chain: each is near the one before only
        for _ in range(r.choice([0, 4])):
            text = text[max(1, len(text) // 20):] + r.choices(words, k=max(1, len(text) // 20))
            rows.append(" ".join(text))
    rows += [None, "", " \n ", "One two", "one TWO", "one\ttwo", "ÄB c d e f", "äb c d e f"]
    r.shuffle(rows)
    return [(10 * i + 3, t) for i, t in enumerate(rows)]


def test_components_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (85, 80):
        got = {r["doc_id"]: r for r in neardup.near_duplicates(docs, percent=percent).collect()}
        want = brute(rows, percent)
        assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == want
        assert all(r["kept"] == (d == r["component_id"]) for d, r in got.items())


def test_many_alike_under_the_threshold_are_all_compared(spark):
    """Texts that share most shingles but are no links fill buckets; the links among them are still found."""
    r = random.Random(9)
    base = [f"b{i}" for i in range(300)]
    rows = []
    for i in range(40):
        own = list(base)
        for k in r.sample(range(0, 300, 6), 7):
            own[k] = f"x{i}-{k}"
        rows.append((i, " ".join(own)))
        if i % 4 == 0:
            own[1] = "y"
            rows.append((100 + i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in neardup.near_duplicates(docs).collect()}
    assert got == brute(rows, 85)


def test_keep_one_keeps_all_columns_and_one_of_each(spark):
    rows = [(1, "a b c d e f g", "x"), (2, "A b c d e f g", "y"), (2, "A b c d e f g", "y"), (3, None, "z"), (4, "", "z"),
            (5, "other words are here now", None), (None, "other words are here now", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, cls string")
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(docs).count() == 0 and neardup.keep_one(docs).count() == 0


def test_sketch_of_a_union_is_the_larger_registers():
    r = np.random.default_rng(0)
    a, b = (r.integers(0, 1 << 63, n).astype(np.uint64) for n in (700, 300))
    one, two, both = setsketch.sketch([a, b, np.union1d(a, b)])
    assert (np.maximum(one, two) == both).all()


def test_joint_estimate_is_near_the_similarity():
    r = np.random.default_rng(1)
    wrong = []
    for n, shared in ((500, 0.5), (500, 0.9), (2000, 0.85), (60, 0.8)) * 10:
        pool = r.integers(0, 1 << 63, 2 * n).astype(np.uint64)
        k = int(n * shared)
        a, b = pool[:n], np.concatenate([pool[:k], pool[n:2 * n - k]])
        sa, sb = setsketch.sketch([a, b])
        est = setsketch.jaccard(sa[None], sb[None], np.array([float(n)]), np.array([float(len(b))]))[0]
        wrong.append(est - k / (len(b) + n - k))
    assert abs(np.mean(wrong)) < 0.03 and np.max(np.abs(wrong)) < 0.15


def test_component_labels(spark):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(200, 200)]
    links += [(300 + r.randrange(50), 300 + r.randrange(50)) for _ in range(30)]
    got = {x["node"]: x["label"] for x in components(spark.createDataFrame(links, "a int, b int")).collect()}
    parent = {n: n for link in links for n in link}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    alone = {n for n, c in Counter(n for a, b in links if a != b for n in (a, b)).items() if c}
    assert got == {n: root(n) for n in alone}


@pytest.mark.parametrize("percent", [80, 85])
def test_pairs_just_at_the_threshold_are_linked(spark, percent):
    """Pairs whose similarity is the threshold exactly, or just under: all of the first, none of the second."""
    rows, want = [], {}
    same, own = (80, 10) if percent == 80 else (170, 15)      # same / (same + 2 * own) = percent / 100
    for i in range(150):
        common = [f"c{i}x{k}" for k in range(same + 4)]
        for j, extra in ((0, own), (1, own + i % 2)):
            rows.append((2 * i + j, " ".join(common + [f"o{i}y{j}z{k}" for k in range(extra)])))
        want[2 * i] = want[2 * i + 1] = 2 * i
        if i % 2:
            want[2 * i + 1] = 2 * i + 1
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()}
    assert got == want == {d: c for d, (_, c) in brute(rows, percent).items()}


def test_bands_and_slack_follow_from_the_threshold():
    assert neardup.band_width(85) == 8 and neardup.band_width(80) in (6, 7)
    assert all(0.05 < neardup.slack(p) < 0.15 for p in (70, 80, 85, 95))


def test_one_large_group_of_copies_keeps_its_least_document(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(i, text, "x") for i in range(5, 405)] + [(5, text, "x"), (5, text + " ", "x"), (None, text, "x"), (1, None, "x"), (1, "", "x")]
    rows += [(None, "other words than those above", "x"), (3, "more words of another kind here", "x")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, h string")
    kept = neardup.keep_one(docs).collect()
    assert sorted(((r["doc_id"], (r["text"] or "").strip()) for r in kept), key=str) == sorted(
        [(5, text), (1, ""), (1, ""), (None, "other words than those above"), (3, "more words of another kind here")], key=str)
