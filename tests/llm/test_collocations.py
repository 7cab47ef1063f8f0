import collections
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import collocations, queries
from tests.llm.test_pipeline import SF

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_force(rows, least=30, top=2000):
    """Every phrase counted, every candidate held against all longer ones."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                f.update((lang, tuple(words[i:i + m])) for i in range(len(words) - m + 1))
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    covered = set()
    for (lang, words), a in candidates.items():
        for m in range(2, len(words)):
            covered.update((lang, words[i:i + m]) for i in range(len(words) - m + 1)
                           if 100 * a >= 80 * f[lang, words[i:i + m]])
    found = collections.defaultdict(list)
    for (lang, words), a in candidates.items():
        if (lang, words) not in covered:
            score, k, l, r = min((2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]])
                                 for k in range(1, len(words)))
            found[lang].append((-score, -a, " ".join(words).encode(), l, r))
    return {(lang, i, p.decode(), -a, l, r, n[lang], -score) for lang, own in found.items()
            for i, (score, a, p, l, r) in enumerate(sorted(own)[:top], 1)}


def rows_of(df):
    rows = [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()]
    want = brute_force(docs)
    assert len(want) > 20
    assert rows_of(queries.op13_collocations(spark, SF)) == want
    # With a lower bound there are many phrases of all lengths, and the lists are cut.
    table = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows_of(collocations.collocations(table, least=4, top=100)) == brute_force(docs, 4, 100)


def test_a_first_word_of_many_phrases_is_cut_over_stretches(spark):
    """Half of all phrases start (and half end) with one word; stretches hand over what they lack."""
    rng = random.Random(3)
    rows = [("en", " ".join(rng.choice(["the", f"w{rng.randint(0, 60)}"]) for _ in range(400))) for _ in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        assert rows_of(collocations.collocations(docs, least=3, top=10 ** 6)) == brute_force(rows, 3, 10 ** 6)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_defined_cases(spark):
    odd = "a\x01b c\x00d a\x01b c\x00d Été Été, New York\tNEW  york\x0bnew york. Café noir x"
    rows = [(None, odd), (None, odd), ("und", odd), ("en", None), ("en", ""), ("en", " .,; "), (None, "big " * 50_000), ("fr", "x" * 200_000),
            ("de", "ein wort"), ("de", "ein wort")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, phrase string, n int")
    assert rows_of(collocations.collocations(docs, least=2)) == brute_force(rows, 2)
    assert rows_of(collocations.collocations(docs.where("false"))) == set()
    assert rows_of(collocations.collocations(docs.where("text is null"))) == set()


def test_products_may_pass_64_bits(spark):
    big = 6 * 10 ** 14
    phrases = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 1)],
                                    "lang string, phrase string, size int, n long")
    totals = spark.createDataFrame([("en", 5 * big)], "lang string, total long")
    was = collocations.count_phrases
    collocations.count_phrases = lambda *a, **k: (phrases, totals)
    try:
        got = rows_of(collocations.collocations(phrases))
    finally:
        collocations.count_phrases = was
    assert got == {("en", 1, "a b", big - 1, big, big + 1, 5 * big, 2_000_000 * (big - 1) // (2 * big + 1))}


def test_words_and_pieces_of_slices():
    texts = pa.array(["One two", "", "three.four\tFIVE", "six"])
    words, piece = collocations.split_words(texts)
    assert words.to_pylist() == ["one", "two", "three", "four", "five", "six"]
    assert [a == b for a, b in zip(piece, piece[1:])] == [True, False, False, True, False]
    words, piece = collocations.split_words(texts.slice(2, 1))
    assert words.to_pylist() == ["three", "four", "five"]
    assert collocations.split_words(pa.array([], pa.string()))[0].to_pylist() == []
    assert [s.to_pylist() for s in collocations._slices(texts)] == [texts.to_pylist()]


def test_the_filter_lets_every_frequent_phrase_through(spark):
    phrases = spark.createDataFrame([("en", f"w{i} v{i}") for i in range(500)] + [("de", "x y")], "lang string, phrase string")
    known = collocations._filter_of(phrases)
    for lang, phrase in phrases.collect():
        one, two = (collocations._hashes(lang, [w]) for w in phrase.split(" "))
        bit = collocations._bit(collocations._extend(one, two))
        assert (known[bit >> 3] >> (bit & 7).astype(np.uint8))[0] & 1
    assert np.unpackbits(known).sum() <= phrases.count()
    assert collocations._filter_of(phrases.where(F.lit(False))).sum() == 0


def test_counting_gives_memory_back_after_each_task(spark, monkeypatch):
    calls = []
    real = collocations.released
    monkeypatch.setattr(collocations, "released", lambda work, *forget: calls.append(1) or real(work, *forget))
    docs = spark.createDataFrame([("en", "a b a b")] * 3, "lang string, text string")
    counted = {r["phrase"]: r["n"] for r in collocations._count(docs, 1, None).collect()}
    assert counted == {"a": 6, "b": 6} and calls == [1]
