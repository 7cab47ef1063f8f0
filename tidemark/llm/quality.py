"""Quality rules: a decision list learned by sequential covering, in DataFrame operations throughout.

The statistics of a text are column expressions.  For learning, each statistic
is binned at quantiles of the labelled rows, and those rows become counts per
combination of bins, label and fold (grow or prune).  A rule (a conjunction of
thresholds) is grown one condition at a time: one aggregation counts good and
bad rows below and above every threshold among the rows that the rule and no
earlier rule covers; the condition with the best information gain is added.  The
rule is then pruned back to the prefix that does best on the prune fold.  The
list is emitted as one ordered ``CASE WHEN`` expression.

Only counts per threshold reach the driver (features x bins rows a step).

Defined cases: a null or empty text has no words and zero statistics, and fails
the base rule; null labels are left out; a document's labels count each, if
there are several; without any labelled bad row the list is empty and keeps
what the base rule keeps; repeated rows and extra columns pass through; an
empty table gives an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, WORD, stage

SYMBOLS = "[#*$%&|<>]"
BINS = 32
MAX_RULES = 8
MAX_CONDITIONS = 3
MIN_PRECISION = 0.9       # of a rule, on the prune fold, for it to be used
MIN_COVERED = 10          # bad rows of the grow fold that a rule must cover


def text_statistics(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed to ``docs``."""
    t = F.coalesce(F.col("_text"), F.lit(""))
    # Words one space apart (no word holds one); a single space stays as it is.
    plain = F.trim(F.regexp_replace(t, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " "))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    windows = F.regexp_extract_all("_plain", F.lit("(?=([^ ]+ [^ ]+ [^ ]+))[^ ]+"), F.lit(1))
    n_words = F.when(F.size("_windows") > 0, F.size("_windows") + 2).when(F.col("_plain") == "", 0).otherwise(
        F.size(F.split("_plain", " ")))
    # Each step is a column of its own, as it is used more than once.
    steps = [
        {"_text": docs[f"`{text}`"]},
        {"_plain": plain, "_lines": lines},
        {"_windows": windows},
        # Equal windows side by side, with their places; few texts repeat any.
        {"n_words": n_words.cast("long"),
         "_sorted": F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(
             F.transform("_windows", lambda x, i: F.struct(x.alias("t"), i.alias("i")))))},
        {"_hits": F.sort_array(F.array_distinct(_twins("_sorted")))},
        {"word_chars": F.when(F.col("n_words") > 0, F.length("_plain") - F.col("n_words") + 1).otherwise(0).cast("long"),
         "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long"),
         "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
         "n_repeat_words": F.coalesce(_covered("_hits"), F.lit(0)).cast("long")},
    ]
    out = docs
    for columns in steps:
        out = out.withColumns(columns)
    out = out.drop("_text", "_plain", "_lines", "_windows", "_sorted", "_hits")
    out = out.select(*docs.columns, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _twins(ranked: str) -> Column:
    """Places of windows that equal their neighbour once sorted (null: none are sorted)."""
    at = lambda k: F.element_at(ranked, k)
    second = F.filter(F.sequence(F.lit(2), F.size(ranked)), lambda k: at(k)["t"] == at(k - 1)["t"])
    return F.when(F.col(ranked).isNotNull(), F.flatten(F.transform(second, lambda k: F.array(at(k)["i"], at(k - 1)["i"]))))


def _covered(hits: str) -> Column:
    """Words that windows at these places (in order) cover: each up to the next one, three at most."""
    steps = F.zip_with(hits, F.slice(hits, 2, F.greatest(F.size(hits), F.lit(1))), lambda a, b: F.least(
        F.lit(3), F.coalesce(b - a, F.lit(3))))
    return F.aggregate(steps, F.lit(0), lambda total, n: total + n)


def _ratio(name: str) -> Column:
    return F.col(name) / F.greatest(F.col("n_words"), F.lit(1)).cast("double")


#: What a rule may test, by name.
FEATURES = {
    "n_words": lambda: F.col("n_words").cast("double"),
    "chars_per_word": lambda: _ratio("word_chars"),
    "symbols_per_word": lambda: _ratio("n_symbols"),
    "dup_lines_per_word": lambda: _ratio("n_dup_lines"),
    "repeat_share": lambda: _ratio("n_repeat_words"),
}


@dataclass(frozen=True)
class Condition:
    """``feature > threshold`` if ``above``, else ``feature <= threshold``; ``bin`` is the threshold's place."""
    feature: str
    above: bool
    bin: int
    threshold: float

    def holds(self) -> Column:
        x = FEATURES[self.feature]()
        return x > self.threshold if self.above else x <= self.threshold

    def holds_bin(self) -> Column:
        x = F.col(f"b_{self.feature}")
        return x > self.bin if self.above else x <= self.bin

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


@dataclass
class DecisionList:
    """Ordered rules that reject; what no rule matches is kept."""
    rules: list[list[Condition]] = field(default_factory=list)

    def verdict(self) -> Column:
        """Whether a row with the statistics is kept, as one ordered conditional expression."""
        out = None
        for rule in self.rules:
            test = _all([c.holds() for c in rule])
            out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def fired(self) -> Column:
        """The number of the first rule that matches, from 1 (null: none)."""
        out = F.lit(None).cast("int")
        for n, rule in reversed(list(enumerate(self.rules, 1))):
            out = F.when(_all([c.holds() for c in rule]), F.lit(n)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join(f"{n}. reject if " + " and ".join(map(str, r)) for n, r in enumerate(self.rules, 1)) + "\nelse keep"


def _all(tests: list[Column]) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & t
    return out


def _gain(p0: float, n0: float, p1: float, n1: float) -> float:
    """Information gain of narrowing a rule from (p0 bad, n0 good) rows to (p1, n1)."""
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0))) if p1 > 0 else -math.inf


def learn(labelled: DataFrame, *, good: str = "quality", fold_key: str = "doc_id") -> DecisionList:
    """A decision list from rows with statistics and a label (1 good, 0 bad); two thirds grow, one third prunes."""
    rows = labelled.where(F.col(good).isNotNull()).select(
        *[f().alias(n) for n, f in FEATURES.items()], (F.col(good) == 0).cast("int").alias("bad"),
        (F.pmod(F.xxhash64(F.col(fold_key).cast("string")), F.lit(3)) == 0).alias("prune"))
    shares = [i / BINS for i in range(1, BINS)]
    # Quantiles of either label, so that a rare label's range is cut finely as well.
    asked = [F.percentile_approx(F.when(F.col("bad") == b, F.col(n)), shares, 10_000).alias(f"{n}_{b}")
             for n in FEATURES for b in (0, 1)]
    got = rows.agg(*asked).first()
    cuts = {n: sorted({x for b in (0, 1) for x in (got[f"{n}_{b}"] or [])}) for n in FEATURES}
    bins = {n: sum((F.col(n) > c).cast("int") for c in cuts[n]) if cuts[n] else F.lit(0) for n in FEATURES}
    # A threshold lies midway between its quantile and the next value seen above it.
    least = {(r["f"], r["b"]): r["least"] for r in rows.select(F.explode(F.array(*[F.struct(
        F.lit(n).alias("f"), b.alias("b"), F.col(n).alias("v")) for n, b in bins.items()])).alias("x"))
        .groupBy("x.f", "x.b").agg(F.min("x.v").alias("least")).collect()}
    above = lambda n, b: next((least[n, k] for k in range(b + 1, len(cuts[n]) + 1) if (n, k) in least), cuts[n][b])
    marks = {n: [(c + above(n, b)) / 2 for b, c in enumerate(cuts[n])] for n in FEATURES}
    binned = stage(rows.groupBy(*[b.alias(f"b_{n}") for n, b in bins.items()], "prune")
                   .agg(F.sum("bad").cast("long").alias("bad"), F.sum(1 - F.col("bad")).cast("long").alias("good")),
                   "quality-counts")
    found = DecisionList()
    left = F.lit(True)                              # rows that no rule so far covers
    while len(found.rules) < MAX_RULES:
        rule = _grow(binned.where(~F.col("prune") & left), marks)
        rule = _prune(binned.where(F.col("prune") & left), rule) if rule else []
        if not rule:
            break
        found.rules.append(rule)
        left = left & ~_all([c.holds_bin() for c in rule])
    return found


def _grow(rows: DataFrame, thresholds: dict[str, list[float]]) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS:
        counted = (rows.where(_all([c.holds_bin() for c in rule]))
                   .select("bad", "good", F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(f"b_{n}").alias("b"))
                                                               for n in FEATURES])).alias("x"))
                   .groupBy("x.f", "x.b").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect())
        bins = {(r["f"], r["b"]): (r["bad"], r["good"]) for r in counted}
        bad, good = (sum(v[k] for (f, _), v in bins.items() if f == next(iter(FEATURES))) for k in (0, 1))
        if bad < MIN_COVERED or good == 0:
            break
        best, best_gain = None, 0.0
        for f, marks in thresholds.items():
            low_bad = low_good = 0
            for b, mark in enumerate(marks):
                more = bins.get((f, b), (0, 0))
                low_bad, low_good = low_bad + more[0], low_good + more[1]
                for above, p, n in ((False, low_bad, low_good), (True, bad - low_bad, good - low_good)):
                    if p >= MIN_COVERED and (g := _gain(bad, good, p, n)) > best_gain + 1e-9:
                        best, best_gain = Condition(f, above, b, mark), g
        if best is None:
            break
        rule.append(best)
    return rule


def _prune(rows: DataFrame, rule: list[Condition]) -> list[Condition]:
    """The rule's prefix with the best (bad - good) / (bad + good) on the prune fold, if it is precise enough."""
    sums = rows.agg(*[F.coalesce(F.sum(F.when(_all([c.holds_bin() for c in rule[:k]]), F.col(what))), F.lit(0))
                      .alias(f"{what}{k}") for k in range(1, len(rule) + 1) for what in ("bad", "good")]).first()
    score = lambda k: (sums[f"bad{k}"] - sums[f"good{k}"]) / max(1, sums[f"bad{k}"] + sums[f"good{k}"])
    best = max(range(1, len(rule) + 1), key=lambda k: (score(k), -k))
    bad, good = sums[f"bad{best}"], sums[f"good{best}"]
    return rule[:best] if bad and bad >= MIN_PRECISION * (bad + good) else []


def apply_rules(measured: DataFrame, rules: DecisionList) -> DataFrame:
    """Add ``rule`` (the first that rejects) and ``kept`` to rows with statistics."""
    return measured.withColumns({"rule": rules.fired(), "kept": ~F.col("base_failed") & rules.verdict()})
