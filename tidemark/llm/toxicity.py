"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text.  A
window is one word (longer ones are cut at ``WINDOW`` characters), set in front of
a fixed frame that ends both dictionaries, as zstandard finds no matches in the last
bytes of its input.  A window's distance is its compressed length under the ordinary
dictionary less that under the toxic one.  A text's score comes from how many
windows reach each distance: a logistic model, calibrated on the labelled texts,
turns those counts into a probability.

**What is learned from.**  Of the labelled texts, a bounded sample: of each class
the distinct texts with the smallest hashes, ``TOXIC`` and ``ORDINARY`` of them; the
model weighs them by their classes' true numbers.  A dictionary's training windows
are drawn from words in context (a word between its neighbours counts once, so copies
of a text count once): for the toxic one, words that are surely ``ODDS`` times as
frequent in toxic text; for the ordinary one, all others.  At most ``CONTEXTS`` words
in context of one text are counted, those with the smallest hashes.  Texts to be
scored are read whole.

Defined cases: a null or empty text has no windows and gets the score of none;
labels that are null, and all but 0 and 1, teach nothing; without texts of both
classes every score is the share of toxic texts (0 if there are none); repeated
rows score each; an empty table gives an empty table; extra columns pass through.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import stage

TOXIC, ORDINARY = 4000, 8000
CONTEXTS = 4000
TOXIC_WORDS, ORDINARY_WORDS = 2000, 20_000      # different words a dictionary is trained on, at most
TOXIC_BYTES, ORDINARY_BYTES = 4096, 32_768
ODDS = 4.0
WINDOW = 48
STEPS = 6               # distances told apart: 1 to STEPS and more
CACHE = 300_000         # words whose distance a worker remembers
_FRAME = bytes(range(128, 160))
_WORDS = re.compile(r"[^\W\d_]{1,%d}" % WINDOW)
_FORM = dict(write_content_size=False, write_checksum=False, write_dict_id=False, window_log=16, hash_log=12, chain_log=13,
             search_log=5, min_match=3, target_length=32, strategy=zstandard.STRATEGY_BTOPT)


def windows(text: str | None) -> list[str]:
    """The windows of a text."""
    return _WORDS.findall(text.lower()) if text else []


def _framed(word: str) -> bytes:
    return b" " + word.encode("utf-8", "surrogatepass") + b" "


def train_dictionary(weights: dict[str, int], size: int) -> bytes:
    """A dictionary for windows that occur so often; a few windows are simply laid side by side, the most frequent last."""
    repeats = 40_000 / max(1, sum(weights.values()))
    samples = [_framed(w) for w in sorted(weights) for _ in range(max(1, round(weights[w] * repeats)))]
    if len(weights) < 64:
        return b"".join(_framed(w) for w in sorted(weights, key=lambda w: (weights[w], w)))[-size:]
    np.random.default_rng(0).shuffle(samples)
    return zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes()


class Model:
    """Two dictionaries and the calibration of their distances."""

    def __init__(self, toxic: bytes, ordinary: bytes, base: float):
        self.toxic, self.ordinary, self.base = toxic, ordinary, base
        self.mean = self.scale = self.low = self.high = self.weights = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def distances(self, words: list[str]) -> np.ndarray:
        """The distance of each window."""
        if "_known" not in self.__dict__:
            form = zstandard.ZstdCompressionParameters(**_FORM)
            self._with = [zstandard.ZstdCompressor(compression_params=form, dict_data=zstandard.ZstdCompressionDict(
                d + _FRAME, dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for d in (self.ordinary, self.toxic)]
            self._known = {}
        if len(self._known) > CACHE:
            self._known.clear()
        known, (ordinary, toxic) = self._known, self._with
        for w in set(words).difference(known):
            data = _framed(w) + _FRAME
            known[w] = len(ordinary.compress(data)) - len(toxic.compress(data))
        return np.fromiter((known[w] for w in words), np.int64, len(words))

    def features(self, text: str | None) -> np.ndarray:
        """How many windows reach each distance, and what share of all."""
        words, counts = windows(text), np.zeros(STEPS + 1)
        for a in range(0, len(words), 1 << 16):
            counts += np.bincount(np.clip(self.distances(words[a:a + (1 << 16)]), 0, STEPS), minlength=STEPS + 1)
        n = max(1, len(words))
        return np.concatenate([np.sqrt(counts[1:] / n), np.log1p(counts[1:]), [math.log(n)]])

    def calibrate(self, features: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
        """Fit the logistic model by Newton's method."""
        self.mean, self.scale = features.mean(0), features.std(0) + 1e-9
        self.low, self.high = features.min(0), features.max(0)
        x = np.c_[(features - self.mean) / self.scale, np.ones(len(features))]
        w, ridge = np.zeros(x.shape[1]), 0.1 * np.eye(x.shape[1])
        weight = weight / weight.mean()
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (p - label)) + ridge @ w)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w

    def score(self, texts: list[str | None]) -> np.ndarray:
        """The probability that each text is toxic."""
        if self.weights is None or not texts:
            return np.full(len(texts), self.base)
        # No farther out than the texts learned from: a very long text is judged like the longest of those.
        x = (np.clip([self.features(t) for t in texts], self.low, self.high) - self.mean) / self.scale
        # Summed row by row: a text's score does not depend on its neighbours.
        return 1 / (1 + np.exp(-np.clip((x * self.weights[:-1]).sum(1) + self.weights[-1], -30, 30)))


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """The texts to learn from (label, text), staged, and each class's number of distinct texts."""
    told = (docs.select("id", F.xxhash64("text").alias("h")).join(labels, "id")        # no text moves here
            .groupBy("label", "h").agg(F.min("id").alias("id")))
    told = stage(told, "labelled-texts")
    sizes = {r["label"]: r["n"] for r in told.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = [told.where(F.col("label") == c).orderBy("h").limit(k) for c, k in ((0, ORDINARY), (1, TOXIC))]
    chosen = F.broadcast(stage(chosen[0].unionByName(chosen[1]), "chosen-texts"))      # TOXIC + ORDINARY rows of numbers
    texts = (docs.withColumn("h", F.xxhash64("text")).join(chosen, ["id", "h"]).dropDuplicates(["label", "h"]).select("label", "text"))
    return stage(texts, "training-texts"), sizes


def _word_counts(texts: DataFrame) -> DataFrame:
    """Rows (word, a, b): the different contexts a word has in toxic and in ordinary texts."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = ["", *windows(text), ""]
                seen = {xxhash.xxh3_64_intdigest("\0".join(words[i - 1:i + 2]).encode("utf-8", "surrogatepass")) >> 1: words[i]
                        for i in range(1, len(words) - 1)}
                few = sorted(seen)[:CONTEXTS]
                yield pa.RecordBatch.from_pydict({"label": pa.array([label] * len(few), pa.int32()),
                                                  "word": pa.array([seen[h] for h in few], pa.string()),
                                                  "context": pa.array(few, pa.int64())})
    return (texts.mapInArrow(work, "label int, word string, context long").distinct()
            .groupBy("word").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")))


def train(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> Model:
    """A model from the rows of ``docs`` that ``labels`` (doc_id, label) marks."""
    docs = docs.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    labels = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")).where("label in (0, 1)")
    texts, sizes = _sample(docs, labels)
    toxic, ordinary = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not ordinary:
        return Model(b"", b"", toxic / max(1, toxic + ordinary))
    counts = stage(_word_counts(texts), "training-words")
    all_a, all_b = counts.select(F.sum("a"), F.sum("b")).first()
    # The lower end of an interval for the log odds of a word's shares in toxic and in ordinary text.
    odds = (F.log((F.col("a") + 0.5) / (F.col("b") + 0.5)) + math.log(max(1, all_b or 0) / max(1, all_a or 0))
            - 1.64 * F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5)))
    sure = (F.col("a") >= 3) & (F.col("odds") > math.log(ODDS))
    counts = counts.withColumn("odds", odds)
    marked = {r["word"]: r["a"] for r in counts.where(sure).orderBy(F.desc("odds"), "word").limit(TOXIC_WORDS).collect()}
    plain = {r["word"]: r["b"] for r in counts.where(~sure & (F.col("b") > 0)).orderBy(F.desc("b"), "word").limit(ORDINARY_WORDS).collect()}
    model = Model(train_dictionary(marked, TOXIC_BYTES), train_dictionary(plain, ORDINARY_BYTES), toxic / (toxic + ordinary))
    sent = docs.sparkSession.sparkContext.broadcast(model)          # two dictionaries

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sent.value.features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tolist() for x in own], pa.list_(pa.float64()))],
                                             names=["label", "x"])
    # Sorted, so that equal inputs give equal models.
    rows = sorted((tuple(r["x"]), r["label"]) for r in texts.mapInArrow(measure, "label int, x array<double>").collect())
    y = np.array([r[1] for r in rows], float)
    weight = np.where(y == 1, toxic / max(1, y.sum()), ordinary / max(1, (1 - y).sum()))
    model.calibrate(np.array([r[0] for r in rows]), y, weight)
    return model


def score_texts(df: DataFrame, model: Model, *, text: str = "text", name: str = "toxicity") -> DataFrame:
    """Add ``name`` (replaced if there): the probability that a row's text is toxic."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c != name]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(name, T.DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                scores = sent.value.score(part.column(part.schema.get_field_index(text)).to_pylist())
                own = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*own, pa.array(scores, pa.float64())], names=[*kept, name])
    return df.mapInArrow(work, schema)
