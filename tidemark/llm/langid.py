"""Language identification by error-correcting output codes.

Every language gets a codeword of bits.  For each bit a binary classifier over
hashed character n-grams (1 to 3) tells the languages whose bit is 1 from the
others: its weights are the log odds of an n-gram's smoothed shares on the two
sides, which needs nothing but n-gram counts per language, so it is trained on
all labelled documents.  A text goes to the codeword with the smallest loss over
its bits, each bit weighted by how well its classifier does on the training
documents; if the two nearest codewords are about as near, it is ambiguous.

Counting is done inside tasks; a task hands on one sparse row of counts per
language (``DIMS`` numbers at most), and the model that reaches the driver is
languages x DIMS numbers, however many documents there are.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
labels that are null train nothing; without any labelled text all is ``und``;
one language alone gets every text with letters; repeated rows count as often
as they occur; extra columns pass through.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import released

DIMS = 1 << 12
UNDETERMINED = "und"
AMBIGUOUS = 0.6         # share of the nearer of the two nearest codewords below which a text is flagged
_LETTER = regex.compile(r"\p{L}")


def codewords(n: int) -> np.ndarray:
    """n codewords of +1 and -1: all distinct splits for up to five languages, else seeded random bits
    with the largest least distance of many draws."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 5:
        # Every way to split the languages in two, the first on the positive side.
        rest = [s for s in itertools.product((1, -1), repeat=n - 1) if -1 in s]
        return np.array([[1, *s] for s in rest], float).T
    rng, length = np.random.default_rng(0), int(10 * np.ceil(np.log2(n)))
    best, best_gap = None, -1.0
    for _ in range(200):
        code = rng.choice((-1.0, 1.0), (n, length))
        code = code[:, np.abs(code.sum(0)) < n]
        gap = (code.shape[1] - (code @ code.T)[np.triu_indices(n, 1)].max()) / 2
        if gap > best_gap:
            best, best_gap = code, gap
    return best


def ngram_counts(text: str) -> np.ndarray:
    """Hashed counts of a text's character n-grams, in lower case."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    mix = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)).astype(np.int64)  # noqa: E731  12 bits
    grams = [mix(c + np.uint64(1))]
    if len(c) > 1:
        two = c[:-1] * np.uint64(0x110000) + c[1:]
        grams.append(mix(two + np.uint64(1 << 42)))
        if len(c) > 2:
            grams.append(mix(two[:-1] * np.uint64(0x110001) + c[2:] + np.uint64(1 << 43)))
    return np.bincount(np.concatenate(grams), minlength=DIMS)


def _count(labelled: DataFrame) -> DataFrame:
    """Rows (lang, dim, n): n-gram counts of each language, summed within each task first."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                if (t := text.as_py()) and _LETTER.search(t):
                    sums[lang.as_py()] = sums.get(lang.as_py(), 0) + ngram_counts(t)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()),
                                              "dim": pa.array(at.astype(np.int32)), "n": pa.array(n[at])})
    return labelled.mapInArrow(released(work), "lang string, dim int, n long")


class Model:
    """Languages, their codewords, and a weight row per bit."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs, self.code = langs, codewords(len(langs))
        share = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * DIMS) if langs else counts
        mean = lambda rows: share[rows].mean(0) if rows.any() else np.full(DIMS, 1 / DIMS)
        # Each language counts the same on its side, however many documents it has.
        self.weights = np.array([np.log(mean(bit > 0)) - np.log(mean(bit < 0)) for bit in self.code.T]).reshape(-1, DIMS)
        if langs:
            self.weights[:, counts.sum(0) == 0] = 0         # n-grams that no language has tell nothing
        # A bit's weight: how clearly the languages' own counts fall on their sides of it.
        margins = (share @ self.weights.T) * self.code if langs else np.ones((0, 1))
        clear = np.clip(margins.min(0), 0, None) if langs else np.ones(1)
        self.bit_weight = clear / clear.sum() if clear.sum() > 0 else np.full(len(clear), 1 / max(1, len(clear)))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (0 to 1) and whether it is ambiguous, of each text."""
        lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        flagged = np.ones(len(texts), bool)
        if not self.langs:
            return lang, score, flagged
        at = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        if not at:
            return lang, score, flagged
        counts = np.array([ngram_counts(texts[i]) for i in at], float)
        length = counts.sum(1, keepdims=True)
        # Evidence adds up over a text's n-grams, which are far from independent: a root tempers it.
        f = counts @ self.weights.T / np.sqrt(length)
        loss = (np.logaddexp(0, -f[:, None, :] * self.code[None]) * self.bit_weight).sum(2)
        near = np.exp(-(loss - loss.min(1, keepdims=True)))
        share = near / near.sum(1, keepdims=True)
        best = share.argmax(1)
        two = np.sort(share, 1)[:, -2:]
        for k, i in enumerate(at):
            lang[i], score[i] = self.langs[best[k]], share[k, best[k]]
            flagged[i] = len(self.langs) > 1 and two[k, 1] / two[k].sum() < AMBIGUOUS
        return lang, score, flagged


def train(labelled: DataFrame, *, text: str = "text", lang: str = "lang") -> Model:
    """A model from all rows with text and label."""
    rows = (_count(labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text, lang))
            .groupBy("lang", "dim").agg(F.sum("n").alias("n")).collect())      # languages x DIMS at most
    langs = sorted({r["lang"] for r in rows})
    counts = np.zeros((len(langs), DIMS))
    for r in rows:
        counts[langs.index(r["lang"]), r["dim"]] = r["n"]
    return Model(langs, counts)


def identify(df: DataFrame, model: Model, *, text: str = "text", prefix: str = "lang_") -> DataFrame:
    """Add ``<prefix>pred``, ``<prefix>score`` and ``<prefix>ambiguous`` (replaced if there)."""
    sent = df.sparkSession.sparkContext.broadcast(model)        # languages x DIMS numbers
    names = [f"{prefix}pred", f"{prefix}score", f"{prefix}ambiguous"]
    kept = [c for c in df.columns if c not in names]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(names[0], T.StringType()),
                           T.StructField(names[1], T.DoubleType()), T.StructField(names[2], T.BooleanType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                lang, score, flag = sent.value.predict(part.column(part.schema.get_field_index(text)).to_pylist())
                own = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*own, pa.array(lang, pa.string()), pa.array(score), pa.array(flag)],
                                                 names=[*kept, *names])
    return df.mapInArrow(released(work), schema)
