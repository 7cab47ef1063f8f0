import random
import re

from pyspark.sql import functions as F

from tidemark.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t):
    t = t or ""
    words = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(i, i + 3)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def texts():
    r = random.Random(3)
    out = [None, "", " ", "\n\n", "a", "a a a", "a a a a", "a b c a b c", "x\ny\nx\n\n\nx", "é ü z 🙂 🙂 🙂 🙂",
           "\u001fa\u001f b", "tab\tcr\rff\fvt\x0b end", " lead", "trail ", "a\n a\na "]
    for _ in range(150):
        out.append("".join(r.choice(["a", "b", "c", "#x", "<|>", "é"]) + r.choice([" ", " ", "\n", "  ", "\t", "\n\n", ""])
                           for _ in range(r.randint(0, 130))))
    return out


def test_statistics_equal_brute_force(spark):
    rows = [(i, t, "k") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lines string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in quality.text_statistics(docs).collect()}
    for i, t, _ in rows:
        assert got[i] == brute(t), repr(t)


def test_main_path_has_no_python(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id int, text string")
    plan = quality.apply_rules(quality.text_statistics(docs), quality.DecisionList())
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def measured(spark, n=3000):
    r = random.Random(4)
    rows = []
    for i in range(n):
        symbols = r.choice([0, 0, 0, 5, 40])
        bad = symbols == 40 or (i % 7 == 0 and i % 3 == 0)
        rows.append((i, 100 if i % 7 else 60 + i % 3, 500, symbols, 0, 0, False, 0 if bad and symbols == 40 else 1))
    return spark.createDataFrame(rows, "doc_id int, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                       "n_repeat_words long, base_failed boolean, quality int")


def test_learns_the_planted_threshold(spark):
    rows = measured(spark)
    rules = quality.learn(rows)
    assert rules.rules and all(c.feature == "symbols_per_word" for c in rules.rules[0][:1])
    wrong = quality.apply_rules(rows, rules).where((F.col("quality") == 1) != F.col("kept")).count()
    assert wrong == 0


def test_nothing_to_learn_keeps_what_the_base_keeps(spark):
    rows = measured(spark, 60)
    for labelled in (rows.where("false"), rows.withColumn("quality", F.lit(1)), rows.withColumn("quality", F.lit(None).cast("int"))):
        rules = quality.learn(labelled)
        assert rules.rules == []
        assert quality.apply_rules(rows, rules).where("not kept").count() == 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    assert quality.apply_rules(quality.text_statistics(docs), quality.DecisionList()).count() == 0
