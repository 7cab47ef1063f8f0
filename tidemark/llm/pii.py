"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Four kinds have a fixed definition (``base_spans``) and always stay.  Further
candidates (secrets, long numbers, local phone numbers, national ids, bank
accounts, spelled-out addresses, titled names) come from wide patterns.  On each
candidate, base spans included, five labelers vote for, against or abstain:
the shape by a strict pattern or checksum, a gazetteer, words of the context,
the neighbouring characters, and the variety of its characters.
Expectation-maximisation estimates from the votes' joint counts how reliable
each labeler is on either class and how likely each combination is personal;
these probabilities train a logistic classifier over span features, which
decides on the candidates beyond the base.

All documents' votes count.  What reaches the driver is a count per combination
of kind, votes and features, whose number is bounded by their value ranges.

Defined cases: null and empty texts hold nothing; overlapping candidates yield
to base spans, then to the earlier one; without any candidate nothing is added;
repeated rows count each; an empty table gives an empty table; extra columns
pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import released

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("secret", "number", "local_phone", "national_id", "iban", "spoken_email", "name")
KINDS = BASE_KINDS + ADDED_KINDS

# The base definitions.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")    # no match starts inside a run of digits
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_SECRET = re.compile(r"\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b\s{0,3}[=:]\s{0,3}[\"']?"
                     r"([A-Za-z0-9_+/=-]{12,})", re.I)
_NUMBER = re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.][0-9]{4}(?![0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}\b")
_SPOKEN = re.compile(r"[A-Za-z0-9._-]{1,64}\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}\x20?(?:\(dot\)|\[dot\])\x20?[A-Za-z]{2,10}")
_TITLES = ("Mr. ", "Mrs. ", "Ms. ", "Dr. ", "Herr ", "Frau ", "Monsieur ", "Madame ", "Señor ", "Señora ")
_NAME = re.compile(r"\b(?:Mr\.|Mrs\.|Ms\.|Dr\.|Herr|Frau|Monsieur|Madame|Señor|Señora) ([A-ZÀ-Þ][^\W\d_]+(?: [A-ZÀ-Þ][^\W\d_]+)?)")

# Gazetteers and context words.
_TLDS = frozenset("com org net edu gov io info de fr es uk eu ch at it nl".split())
_CODES = ("1", "33", "34", "39", "41", "43", "44", "49", "7", "81", "86", "91")
_IBAN_LANDS = frozenset("DE FR ES IT NL BE AT CH GB IE PT PL".split())
_GIVEN = frozenset("Anna John Maria James Peter Paul Julia Hans Pierre Marie Carlos José Carmen Thomas Michael Sarah".split())
_FOR = {"email": "mail contact write", "spoken_email": "mail contact write", "ip": "ip host server address",
        "card": "card visa mastercard credit pay", "number": "card account number konto compte cuenta",
        "phone": "phone tel call fax mobile", "local_phone": "phone tel call fax mobile", "secret": "token secret key password",
        "national_id": "ssn social security", "iban": "iban account bank", "name": "name contact dear"}
_AGAINST = frozenset("version isbn order ticket page chapter figure section example sample invoice".split())
_CONTEXT = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9)
    return total % 10 == 0


def base_spans(t: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the fixed definitions: leftmost matches of each kind that do not overlap."""
    out, floor, at = [], 0, t.find("@")
    while at >= 0:
        low = at
        while low > floor and t[low - 1] in _LOCAL:
            low -= 1
        m = _DOMAIN.match(t, at) if low < at else None
        if m:
            out.append(("email", low, m.end()))
            floor = m.end()
        at = t.find("@", max(at + 1, floor))
    if not _DIGIT.search(t):
        return out
    for m in _IP.finditer(t):
        if all(len(p := g.lstrip("0")) <= 3 and int(p or "0") <= 255 for g in m.groups()):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(t):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in t:
        for m in _PHONE.finditer(t):
            if 10 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def candidates(t: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Further spans that may be personal data, clear of the base spans and of each other."""
    found: list[tuple[str, int, int]] = []
    lower = t.lower() if "=" in t or ":" in t else ""
    if any(w in lower for w in ("token", "secret", "passw", "key")):
        found += [("secret", *m.span(1)) for m in _SECRET.finditer(t)]
    if _DIGIT.search(t):
        found += [("iban", *m.span()) for m in _IBAN.finditer(t)]
        found += [("number", *m.span()) for m in _NUMBER.finditer(t)]
        found += [("national_id", *m.span()) for m in _NATIONAL.finditer(t)]
        found += [("local_phone", *m.span()) for m in _LOCAL_PHONE.finditer(t)]
    if "(at)" in t or "[at]" in t:
        found += [("spoken_email", *m.span()) for m in _SPOKEN.finditer(t)]
    if any(title in t for title in _TITLES):
        found += [("name", *m.span(1)) for m in _NAME.finditer(t)]
    taken, out = sorted((a, b) for _, a, b in base), []
    for kind, a, b in sorted(found, key=lambda x: (x[1], KINDS.index(x[0]))):
        if all(b <= x or a >= y for x, y in taken) and (not out or a >= out[-1][2]):
            out.append((kind, a, b))
    return out


def votes(t: str, kind: str, a: int, b: int) -> tuple[int, int, int, int, int]:
    """The labelers' votes on a span: 1 personal, -1 not, 0 abstain."""
    s = t[a:b]
    digits = "".join(_DIGIT.findall(s))
    if kind in ("card", "number"):
        shape = 1 if luhn(digits) else 0
    elif kind == "secret":
        shape = 1 if len(s) >= 24 and digits and not digits == s else -1
    elif kind == "national_id":
        shape = -1 if digits[:3] in ("000", "666") or digits[0] == "9" else 1
    elif kind == "iban":
        c = s.replace(" ", "")
        shape = 1 if int("".join(str(int(x, 36)) for x in c[4:] + c[:4])) % 97 == 1 else -1
    else:
        shape = 1
    if kind in ("email", "spoken_email"):
        gazetteer = 1 if re.split(r"[^A-Za-z]+", s.lower())[-1] in _TLDS else -1
    elif kind == "phone":
        gazetteer = 1 if digits.startswith(_CODES) else -1
    elif kind == "ip":
        gazetteer = -1 if s.split(".")[0] in ("0", "127", "255") else 1
    elif kind == "iban":
        gazetteer = 1 if s[:2] in _IBAN_LANDS else -1
    elif kind == "name":
        gazetteer = 1 if s.split(" ")[0] in _GIVEN else 0
    elif kind == "secret":
        gazetteer = 1 if s.startswith(("AKIA", "ghp_", "sk-")) or re.fullmatch(r"[0-9A-Fa-f]{32,}", s) else 0
    elif kind in ("card", "number"):
        gazetteer = 1 if digits[0] in "3456" else 0         # the issuers' leading digits
    else:
        gazetteer = 0
    near = set(_CONTEXT.findall(t[max(0, a - 40):a].lower())[-4:])
    context = 1 if near & set(_FOR[kind].split()) else -1 if near & _AGAINST else 0
    glued = (a > 0 and t[a - 1].isalnum()) or (b < len(t) and t[b].isalnum())
    variety = len(set(digits if len(digits) >= 6 else s))
    return shape, gazetteer, context, -1 if glued else 1, 1 if variety >= 4 else -1


def features(t: str, kind: str, a: int, b: int) -> tuple[int, int, int, int, int]:
    """Bounded features of a span: kind, length, share of digits, character classes before and after."""
    s = t[a:b]
    side = lambda c: 0 if c == "" else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4
    return (KINDS.index(kind), min(len(s).bit_length(), 8), int(4 * len(_DIGIT.findall(s)) / len(s)),
            side(t[a - 1:a]), side(t[b:b + 1]))


_SIZES = (len(KINDS), 9, 5, 5, 5)


def _one_hot(rows: np.ndarray) -> np.ndarray:
    return np.concatenate([np.eye(n)[rows[:, k]] for k, n in enumerate(_SIZES)], 1) if len(rows) else np.zeros((0, sum(_SIZES)))


class Model:
    """Labeler reliabilities by EM, and the span classifier trained on what they say."""

    def __init__(self, vote_rows: np.ndarray, feature_rows: np.ndarray, counts: np.ndarray):
        kinds = feature_rows[:, 0] if len(feature_rows) else np.zeros(0, int)
        self.reliability = {}
        soft = np.zeros(len(counts))
        for k in np.unique(kinds):
            at = kinds == k
            soft[at], self.reliability[KINDS[k]] = self._em(vote_rows[at], counts[at])
        self.weights = self._fit(_one_hot(feature_rows), soft, counts)

    @staticmethod
    def _em(v: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability that each row of votes is personal, and each labeler's vote shares on either class."""
        q = 1 / (1 + np.exp(-1.0 * v.sum(1)))                # majority vote to begin with
        says = np.stack([v == x for x in (-1, 0, 1)], 2).astype(float)
        prior_counts = np.array([[2.0, 1.0, 0.5], [0.5, 1.0, 2.0]])     # labelers are better than chance
        for _ in range(50):
            share = []
            for c, w in enumerate((n * (1 - q), n * q)):
                got = np.einsum("r,rlx->lx", w, says) + prior_counts[c]
                share.append(got / got.sum(1, keepdims=True))
            prior = (n @ q + 1) / (n.sum() + 2)
            score = sum(np.einsum("rlx,lx->r", says, np.log(share[c])) * (1 if c else -1) for c in (0, 1))
            new = 1 / (1 + np.exp(-np.clip(score + np.log(prior / (1 - prior)), -30, 30)))
            if np.abs(new - q).max() < 1e-6:
                break
            q = new
        return q, np.array(share)

    @staticmethod
    def _fit(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Logistic regression on soft labels, weighted by the logarithm of counts (Newton steps, ridge)."""
        w, weight = np.zeros(x.shape[1]), np.log1p(n)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            g = x.T @ (weight * (p - y)) + 0.1 * w
            h = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
            w = w - np.linalg.solve(h, g)
        return w

    def accepts(self, row: tuple[int, ...]) -> bool:
        at, score = 0, 0.0
        for value, size in zip(row, _SIZES):
            score, at = score + self.weights[at + value], at + size
        return score > 0


def train(docs: DataFrame, *, text: str = "text") -> Model:
    """A model from the candidates of all documents."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, int] = {}
        for batch in batches:
            for t in batch.column(0):
                if t := t.as_py():
                    base = base_spans(t)
                    for kind, a, b in base + candidates(t, base):
                        row = (*votes(t, kind, a, b), *features(t, kind, a, b))
                        sums[row] = sums.get(row, 0) + 1
        rows = list(sums)
        yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in rows], pa.int32()) for i in range(10)),
                                          pa.array(list(sums.values()), pa.int64())], names=[f"c{i}" for i in range(11)])
    names = [f"c{i}" for i in range(10)]
    counted = (docs.select(text).mapInArrow(released(work), ", ".join(f"{c} int" for c in names) + ", c10 long")
               .groupBy(*names).agg(F.sum("c10").alias("n")).collect())     # bounded: see the module's head
    rows = np.array([[r[c] for c in names] for r in counted], int).reshape(-1, 10)
    return Model(rows[:, :5], rows[:, 5:], np.array([r["n"] for r in counted], float))


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())]))


def spans_of(t: str | None, model: Model) -> list[tuple[str, int, int, bool]]:
    """All spans of a text, by start, then kind as listed."""
    if not t:
        return []
    base = base_spans(t)
    more = [x for x in candidates(t, base) if model.accepts(features(t, *x))]
    return sorted([(*x, True) for x in base] + [(*x, False) for x in more], key=lambda x: (x[1], KINDS.index(x[0])))


def find_spans(docs: DataFrame, model: Model, *, text: str = "text", column: str = "spans") -> DataFrame:
    """Add ``column``: array<struct<kind, start, end, base>> in code points, end exclusive."""
    kept = [c for c in docs.columns if c != column]
    sent = docs.sparkSession.sparkContext.broadcast(model)      # a few hundred numbers
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            found = [[dict(zip(("kind", "start", "end", "base"), s)) for s in spans_of(t.as_py(), sent.value)]
                     for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept),
                                              pa.array(found, kind)], names=[*kept, column])
    return docs.mapInArrow(released(work), T.StructType([*(docs.schema[c] for c in kept), T.StructField(column, SPANS)]))


def redact(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; ``n_chars``, if there, follows."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def clean(t: str | None) -> str | None:
        out, end = [], 0
        for kind, a, b, _ in spans_of(t, sent.value):
            if a >= end:
                out += [t[end:a], f"[{kind.upper()}]"]
            end = max(end, b)
        return "".join([*out, t[end:]]) if out else t

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = names.index(text)
            columns = list(batch.columns)
            columns[at] = pa.array([clean(t.as_py()) for t in batch.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)
    out = docs.mapInArrow(released(work), docs.schema)
    return out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
