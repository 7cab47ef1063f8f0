"""Spelling variants: near words found through an index of variable-length grams.

**Words** are letter runs, counted over all documents; a fixed share of them is
misspelled on purpose (``spoiled``), as the query's contract says.

**Gram dictionary.**  A word between two end marks has a gram at every place.  A
gram starts with two characters and goes on while it is *common* (stands in more
than 1 / ``PARTS`` of all places and more than ``COMMON`` times), up to ``LONGEST``
characters.  Only common grams are kept: fewer than ``PARTS`` a length, whatever
the number of words, so the dictionary may be broadcast.

**Affected grams.**  A gram depends on its own characters alone, so one edit can
change only the grams that cover it.  ``affected`` is the largest number of grams
that cover one character of a word.  Two words one edit apart share all other
grams, hence each has one of them among its ``affected + 1`` rarest.  Only those
are listed.  With ``LONGEST`` at most 5, a word of five characters or more has more
grams than one edit affects, so no word is left out.

**List merging.**  A shared gram is either in front of the edit, and then all
characters up to its end are equal, or behind it, and then all from its start on
are.  Lists are therefore kept by gram and equal side.  Lists of up to ``LIST``
words are merged by a join; the words of longer lists meet by what is left of them
when one character is taken away (``_masked``), whose groups hold at most one word
a letter and place.  Every pair found is verified by its edit distance.

Defined cases: a null text has no words, and a null id counts as an empty one;
repeated rows count each; an empty table gives an empty table; other columns are
ignored; ties between forms go to the word that is smaller in code-point order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop, stage

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
COMMON = 64             # a gram in more places than this may be common
PARTS = 1 << 14         # and a common gram holds more than this part of all places
LONGEST = 5
LIST = 64               # words in a list that is merged by a join
_OPEN, _CLOSE = "\x02", "\x03"      # no letters, so they occur in no word


def count_words(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shortest: int = 5, least: int = 3,
                spoil: int = 97) -> DataFrame:
    """Rows (word, n): letter runs in lower case (A-Z only), of ``shortest`` code points, that occur ``least`` times.

    If ``spoil`` divides the CRC-32 of ``<doc_id>:<run>``, the run loses a character first (0: never).
    """
    runs = F.regexp_extract_all(F.translate(F.col(f"`{text}`"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                                F.lit(RUN), F.lit(0))
    found = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    found = found.where(F.length("run") >= shortest)        # runs only get shorter
    if spoil:
        found = found.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
        at = (F.col("h") % F.length("run")).cast("int")
        found = found.select(F.when(F.col("h") % spoil == 0, F.concat(
            F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run")).alias("run"))
        found = found.where(F.length("run") >= shortest)
    return found.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _columns(batch: pa.RecordBatch) -> list[list]:
    return [c.to_pylist() for c in batch.columns]


def common_grams(words: DataFrame) -> dict[str, int]:
    """Common grams and their places in all ``words``: fewer than PARTS for each length up to LONGEST."""
    common: dict[str, int] = {}
    places = words.select(F.sum(F.length("word") + 1)).first()[0] or 0
    floor = max(COMMON, places // PARTS)
    for length in range(2, LONGEST + 1):
        known = {g for g in common if len(g) == length - 1}

        def grams(batches: Iterator[pa.RecordBatch], length: int = length, known: set = known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n: dict[str, int] = {}
                for word in batch.column(0).to_pylist():
                    word = _OPEN + word + _CLOSE
                    for p in range(len(word) - length + 1):
                        g = word[p:p + length]
                        if length == 2 or g[:-1] in known:
                            n[g] = n.get(g, 0) + 1
                yield pa.RecordBatch.from_pydict({"gram": pa.array(list(n), pa.string()), "n": pa.array(list(n.values()), pa.int64())})
        rows = (words.select("word").mapInArrow(grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
                .where(F.col("n") > floor).collect())
        common.update((r["gram"], r["n"]) for r in rows)
        if not rows:
            break
    return common


def decompose(marked: str, common: dict[str, int]) -> list[str]:
    """The gram at each place of a word between its end marks."""
    grams = []
    for p in range(len(marked) - 1):
        end = p + 2
        while end < len(marked) and end - p < LONGEST and marked[p:end] in common:
            end += 1
        grams.append(marked[p:end])
    return grams


def affected(grams: list[str]) -> int:
    """The most grams of a word that one edit can change: those that cover one character."""
    cover = [0] * (len(grams) + LONGEST + 1)
    for p, g in enumerate(grams):
        for i in range(p, p + len(g)):
            cover[i] += 1
    return max(cover)


def listed(word: str, common: dict[str, int]) -> list[str]:
    """The lists a word stands in: its rarest grams, each with the characters in front of and behind it."""
    marked = _OPEN + word + _CLOSE
    grams = decompose(marked, common)
    places = sorted(range(len(grams)), key=lambda p: (common.get(grams[p], 0), grams[p], p))[:affected(grams) + 1]
    lists = set()
    for p in places:
        lists.add("<" + marked[:p + len(grams[p])])
        lists.add(">" + marked[p:])
    return sorted(lists)


def _masked(words: DataFrame) -> DataFrame:
    """Pairs (a, b) that may be one edit apart: words equal once one character is masked, or that equal
    another one with a character taken away."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ([], [], [], [])
            for word, n in zip(*_columns(batch)):
                keys = {f"={word}"}
                for i in range(len(word)):
                    keys.add(f"{i}:{word[:i]}{word[i + 1:]}")
                    keys.add(f"-{word[:i]}{word[i + 1:]}")
                for key in keys:
                    # A taken-away key meets only whole words, a masked one only its like.
                    kind = "probe" if key[0] == "-" else "whole" if key[0] == "=" else "mask"
                    rows[0].append(word)
                    rows[1].append(n)
                    rows[2].append(kind)
                    rows[3].append(key[1:] if key[0] in "=-" else key)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()),
                                              pa.array(rows[2], pa.string()), pa.array(rows[3], pa.string())],
                                             names=["word", "n", "kind", "key"])
    keyed = stage(words.mapInArrow(work, "word string, n long, kind string, key string"), "masked-words")
    side = lambda kind, w, n: keyed.where(F.col("kind") == kind).select(
        F.col("word").alias(w), F.col("n").alias(n), "key")
    alike = side("mask", "a", "an").join(side("mask", "b", "bn"), "key").where("a < b")
    shorter = side("probe", "a", "an").join(side("whole", "b", "bn"), "key")
    return alike.unionByName(shorter).select("a", "an", "b", "bn")


def near_words(words: DataFrame) -> DataFrame:
    """Distinct pairs (a, an, b, bn) of ``words`` (word, n) one edit apart, each pair once, a < b."""
    spark = words.sparkSession
    sent = spark.sparkContext.broadcast(common_grams(words))        # fewer than PARTS grams a length

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ([], [], [])
            for word, n in zip(*_columns(batch)):
                for key in listed(word, sent.value):
                    rows[0].append(key)
                    rows[1].append(word)
                    rows[2].append(n)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.string()),
                                              pa.array(rows[2], pa.int64())], names=["list", "word", "n"])
    entries = stage(words.select("word", "n").mapInArrow(work, "list string, word string, n long"), "gram-lists")
    sizes = stage(entries.groupBy("list").agg(F.count("*").alias("size")).where("size > 1"), "list-sizes")
    short = entries.join(sizes.where(F.col("size") <= LIST).select("list"), "list", "left_semi")
    long = entries.join(sizes.where(F.col("size") > LIST).select("list"), "list", "left_semi").select("word", "n").distinct()
    one = short.select("list", F.col("word").alias("a"), F.col("n").alias("an"))
    two = short.select("list", F.col("word").alias("b"), F.col("n").alias("bn"))
    merged = one.join(two, "list").where((F.col("a") < F.col("b")) & (
        F.abs(F.length("a") - F.length("b")) <= 1)).select("a", "an", "b", "bn")
    met = _masked(long)
    met = met.select(F.least("a", "b").alias("a"), F.when(F.col("a") < F.col("b"), F.col("an")).otherwise(F.col("bn")).alias("an"),
                     F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.col("bn")).otherwise(F.col("an")).alias("bn"))
    return merged.unionByName(met).where(F.levenshtein("a", "b", 1) == 1).distinct()


def _roots(links: DataFrame) -> DataFrame:
    """Rows (word, root) for links (word, form): forms followed to the last, twice as far each round.
    Frequencies at least double along a chain, so rounds grow with the logarithm of that of the counts."""
    spark = links.sparkSession
    paths = stage(links.select("word", F.col("form").alias("root")), "form-paths")
    while True:
        on = paths.select(F.col("word").alias("root"), F.col("root").alias("farther"))
        stepped = stage(paths.join(on, "root", "left").select("word", F.coalesce("farther", "root").alias("root"),
                                                              F.col("farther").isNotNull().alias("moved")), "form-paths")
        drop(spark, paths)
        paths = stepped.drop("moved")
        if not stepped.where("moved").limit(1).count():
            return paths


def spelling_variants(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shortest: int = 5, least: int = 3,
                      spoil: int = 97) -> DataFrame:
    """Every word: word, n, n_near, form, form_n, root (see the module and the query's contract)."""
    if shortest < 5:
        raise ValueError("words of fewer than five characters may have no gram that an edit leaves alone")
    words = stage(count_words(docs, text=text, doc_id=doc_id, shortest=shortest, least=least, spoil=spoil), "words")
    pairs = stage(near_words(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("an").alias("n"), F.col("b").alias("near"), F.col("bn").alias("near_n")).union(
        pairs.select("b", "bn", "a", "an"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("down"), "near")).alias("best"))
    told = words.join(best, "word", "left")
    is_form = -F.col("best.down") >= 2 * F.col("n")
    told = stage(told.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                             F.when(is_form, F.col("best.near")).alias("form"),
                             F.when(is_form, -F.col("best.down")).alias("form_n")), "word-forms")
    roots = _roots(told.where("form is not null"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
