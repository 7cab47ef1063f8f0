"""Phrase collocations from sorted count streams.

**Counting.**  Phrases of one to ``LONGEST`` words are counted length by length.
A phrase can only be frequent if both phrases one word shorter in it are, so each
length is counted over the places where they are: the frequent phrases of a length
set bits in a filter of ``FILTER_BITS`` bits (fixed size, so its broadcast never
grows), and a set bit lets a place through.  The filter only ever lets too much
through; counts are exact, by words, and what is not frequent falls in the
aggregation.  A task sums within slices of ``SLICE`` bytes; Spark sums on.

**Estimation layout.**  All counted phrases of all lengths form one stream, written
twice: in prefix order and in suffix order (words reversed).  In prefix order a
phrase directly follows its own first words, so one walk with a phrase of each
length in hand gives every phrase the counts of all its first parts, and every
phrase its most frequent extension to the right; suffix order gives last parts and
extensions to the left.  The streams are range partitioned, so a first word that
starts a third of all phrases is cut like any other stretch; the first parts that
stand in an earlier stretch are handed over (one phrase a length and stretch).
Parts are never looked up by a join, so no phrase is a hot key; only the rows of
the two walks are brought together, a few for each phrase.

**Containment.**  A phrase inside a longer candidate by two or more words is inside
one that is longer by one word and at least as frequent, so one-word extensions
decide.

Defined cases: a null text has no words and a null language is ``und``; repeated
rows count each; an empty table gives an empty table; other columns are ignored;
scores divide exactly, in decimals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import drop, released, small_batches, stage

LONGEST = 4
FILTER_BITS = 26
SALTS = 64
SLICE = 4 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD, _SPACE, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = _SPACE
_KIND[[ord(c) for c in ".,;:!?\n\v\f\r"]] = _BREAK
_MIX = np.uint64(0x9E3779B97F4A7C15)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, in order, and the number of the piece each stands in."""
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or at[-1] == at[0]:
        return pa.array([], pa.string()), np.zeros(0, np.int64)
    data = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8)[at[0]:at[-1]]]
    kind = _KIND[data]
    heads = at[:-1][np.diff(at) > 0] - at[0]
    inside = kind == _WORD
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[heads] = inside[heads]
    breaks = kind == _BREAK
    breaks[heads] = True
    starts = np.flatnonzero(first)
    place = np.cumsum(inside, dtype=np.int64)
    offsets = np.append(place[starts] - 1, place[-1]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return words, np.cumsum(breaks, dtype=np.int64)[starts]


def _hashes(lang: str, words: list[str]) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"), seed) for w in words], np.uint64)


def _extend(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases, each with one word more."""
    return phrase * _MIX + word


def _bit(phrase: np.ndarray) -> np.ndarray:
    mixed = (phrase ^ (phrase >> np.uint64(31))) * _MIX
    return (mixed >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _slice_counts(texts: pa.Array, lang: str, length: int, known: np.ndarray | None) -> tuple[pa.Array, np.ndarray]:
    """Phrases of ``length`` words in ``texts`` that may be frequent, and how often they occur there."""
    words, piece = split_words(texts)
    coded = words.dictionary_encode()
    distinct, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    if length == 1:
        return distinct, np.bincount(ids, minlength=len(distinct))
    single = _hashes(lang, distinct.to_pylist())[ids] if len(distinct) else np.zeros(0, np.uint64)
    shorter = single
    for k in range(1, length - 1):
        shorter = _extend(shorter[:-1], single[k:])
    bit = _bit(shorter)
    may = (known[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
    last = len(ids) - length + 1
    if last <= 0:
        return pa.array([], pa.string()), np.zeros(0, np.int64)
    start = np.flatnonzero(may[:last] & may[1:last + 1] & (piece[:last] == piece[length - 1:]))
    # Phrases are numbered two words at a time, so a number always fits 64 bits.
    key = ids[start]
    for k in range(1, length):
        key = key * len(distinct) + ids[start + k]
        _, at, key = np.unique(key, return_index=True, return_inverse=True)
    n = np.bincount(key, minlength=len(at) if len(start) else 0)
    parts = [distinct.take(pa.array(ids[start[at] + k])) if len(start) else pa.array([], pa.string()) for k in range(length)]
    return pc.binary_join_element_wise(*parts, " "), n


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of whole texts of about ``SLICE`` bytes (a longer text alone)."""
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(at, at[a] + SLICE, "right")) - 1)
        yield texts.slice(a, b - a)
        a = b


def _count(docs: DataFrame, length: int, known: np.ndarray | None) -> DataFrame:
    """Rows (lang, phrase, n): exact counts of all phrases of ``length`` words that may be frequent."""
    sent = None if known is None else docs.sparkSession.sparkContext.broadcast(known)       # FILTER_BITS bits

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if sent is None else sent.value
        for batch in batches:
            langs, texts = batch.column(0).dictionary_encode(), batch.column(1).cast(pa.string())
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                own = texts.filter(pc.equal(langs.indices, code))
                for part in _slices(own):
                    phrases, n = _slice_counts(part, lang, length, bits)
                    for a in range(0, len(phrases), 1 << 16):
                        some = phrases.slice(a, 1 << 16)
                        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(some), pa.string()), "phrase": some,
                                                          "n": pa.array(n[a:a + (1 << 16)].astype(np.int64))})
    return (small_batches(docs).mapInArrow(released(work), "lang string, phrase string, n long")
            .groupBy("lang", "phrase").agg(F.sum("n").alias("n")))


def _filter_of(frequent: DataFrame) -> np.ndarray:
    """The bits of all frequent phrases, as bytes; Spark joins them, at most 2^FILTER_BITS / 64 rows come back."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lang = batch.column(0).to_pylist()
            split = [p.split(" ") for p in batch.column(1).to_pylist()]
            total = np.zeros(len(split), np.uint64)
            for k in range(len(split[0])):
                word = np.concatenate([_hashes(g, [s[k]]) for g, s in zip(lang, split)])
                total = word if k == 0 else _extend(total, word)
            bit = _bit(total)
            slot, at = np.unique(bit >> 6, return_inverse=True)
            mask = np.zeros(len(slot), np.uint64)
            np.bitwise_or.at(mask, at, np.uint64(1) << (bit & 63).astype(np.uint64))
            yield pa.RecordBatch.from_pydict({"slot": pa.array(slot), "mask": pa.array(mask.view(np.int64))})
    rows = (frequent.select("lang", "phrase").mapInArrow(work, "slot long, mask long")
            .groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow())
    known = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    known[rows["slot"].to_numpy()] = rows["mask"].to_numpy()
    return known.view(np.uint8)


def count_phrases(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 30,
                  longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Staged tables: all phrases of up to ``longest`` words that occur ``least`` times in their
    language (lang, phrase, size, n), and each language's words in all (lang, total)."""
    docs = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    levels, known, totals = [], None, None
    for length in range(1, longest + 1):
        counts = _count(docs, length, known)
        if length == 1:
            counts = stage(counts, "words")         # read twice
            totals = stage(counts.groupBy("lang").agg(F.sum("n").alias("total")), "word-totals")
        levels.append(stage(counts.where(F.col("n") >= least).select(
            "lang", "phrase", F.lit(length).alias("size"), "n"), "phrases"))
        if length == 1:
            drop(docs.sparkSession, counts)
        if length < longest:
            known = _filter_of(levels[-1])
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    return every, totals


def _walk(phrases: DataFrame, backward: bool) -> DataFrame:
    """Rows (lang, words, n, parts, extended) in one order: a phrase's own row has the counts of its first parts,
    by number of words (last parts if ``backward``); other rows have a phrase's largest one-word extension."""
    spark = phrases.sparkSession
    words = F.split("phrase", " ")
    placed = (phrases.select("lang", (F.reverse(words) if backward else words).alias("words"), "size", "n")
              .repartitionByRange("lang", "words").withColumn("stretch", F.spark_partition_id()))
    placed = stage(placed, "phrase-order")
    # The last phrase of each length in each stretch: LONGEST rows a stretch, for the stretches behind it.
    ends = (placed.groupBy("stretch", "size").agg(F.max(F.struct("lang", "words", "n")).alias("last")).orderBy("stretch").collect())
    handed: dict[int, dict[int, tuple]] = {}
    seen: dict[int, tuple] = {}
    by_stretch: dict[int, list] = {}
    for r in ends:
        by_stretch.setdefault(r["stretch"], []).append(r)
    for stretch in sorted(by_stretch):
        handed[stretch] = dict(seen)
        for r in by_stretch[stretch]:
            seen[r["size"]] = (r["last"]["lang"], list(r["last"]["words"]), r["last"]["n"])
    sent = spark.sparkContext.broadcast(handed)         # LONGEST phrases a stretch

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch, held, grown = None, {}, {}
        for batch in batches:
            out: dict[str, list] = {"lang": [], "words": [], "n": [], "parts": [], "extended": []}

            def put(lang, words, n, parts, extended):
                out["lang"].append(lang)
                out["words"].append(words[::-1] if backward else words)
                out["n"].append(n)
                out["parts"].append(parts)
                out["extended"].append(extended)
            for s, lang, words, n in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if s != stretch:
                    for size, (of, most) in grown.items():
                        put(of[0], of[1], None, None, most)
                    stretch, held, grown = s, dict(sent.value[s]), {}
                size = len(words)
                parts = []
                for k in range(1, size):
                    part = held.get(k)
                    if part is None or part[0] != lang or part[1] != words[:k]:
                        raise ValueError(f"a first part of {words} is missing from the stream")
                    parts.append(part[2])
                held[size] = (lang, words, n)
                put(lang, words, n, parts, None)
                if size > 1:
                    of = (lang, words[:-1])
                    old = grown.get(size)
                    if old is None or old[0] != of:
                        if old is not None:
                            put(old[0][0], old[0][1], None, None, old[1])
                        grown[size] = (of, n)
                    elif n > old[1]:
                        grown[size] = (of, n)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array(out["lang"], pa.string()), "words": pa.array(out["words"], pa.list_(pa.string())),
                "n": pa.array(out["n"], pa.int64()), "parts": pa.array(out["parts"], pa.list_(pa.int64())),
                "extended": pa.array(out["extended"], pa.int64())})
        rest = list(grown.values())
        if rest:
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([of[0] for of, _ in rest], pa.string()),
                "words": pa.array([of[1][::-1] if backward else of[1] for of, _ in rest], pa.list_(pa.string())),
                "n": pa.array([None] * len(rest), pa.int64()), "parts": pa.array([None] * len(rest), pa.list_(pa.int64())),
                "extended": pa.array([most for _, most in rest], pa.int64())})
    stream = (placed.select("stretch", "lang", "words", "n").repartition("stretch").sortWithinPartitions("stretch", "lang", "words"))
    return stream.mapInArrow(work, "lang string, words array<string>, n long, parts array<long>, extended long")


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 30, top: int = 2000,
                 longest: int = LONGEST) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score (see the module)."""
    phrases, totals = count_phrases(docs, text=text, lang=lang, least=least, longest=longest)
    forward = _walk(phrases, False).withColumn("last_parts", F.lit(None).cast("array<long>"))
    backward = _walk(phrases, True).select("lang", "words", "n", F.lit(None).cast("array<long>").alias("parts"), "extended",
                                           F.col("parts").alias("last_parts"))
    merged = (forward.unionByName(backward).groupBy("lang", "words")
              .agg(F.max("n").alias("a"), F.max("parts").alias("first"), F.max("last_parts").alias("last"),
                   F.max("extended").alias("extended")))
    exact = lambda c: c.cast("decimal(20,0)")
    whole = merged.where((F.size("words") > 1) & (F.col("extended").isNull() | (
        exact(F.col("extended")) * 100 < exact(F.col("a")) * 80)))
    k = F.explode(F.sequence(F.lit(1), F.size("words") - 1))
    cuts = whole.select("lang", "words", "a", "first", "last", k.alias("k"))
    cuts = cuts.select("lang", "words", "a", "k", F.element_at("first", F.col("k")).alias("l"),
                       F.element_at("last", F.size("words") - F.col("k")).alias("r"))
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    worst = (cuts.withColumn("score", score).groupBy("lang", "words", "a")
             .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    scored = worst.select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    # A language may hold most phrases: each of SALTS parts of it is cut to its first ``top`` before they meet.
    order = lambda *by: Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    some = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = some.withColumn("rank", F.row_number().over(order("lang", "part"))).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(order("lang"))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                            F.col("total").alias("n"), F.col("score").cast("long").alias("score"))
