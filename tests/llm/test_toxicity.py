import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, toxicity
from tests.llm.test_pipeline import SF

BAD = "horrid vile rotten nasty foul wretched loathsome dreadful".split()


def made(spark, n=600, seed=1):
    rng = random.Random(seed)
    parts = ["ta", "re", "no", "mi", "lo", "su", "pa", "ke", "di", "ra"]
    rows, marks = [], []
    for i in range(n):
        words = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(rng.randint(30, 200))]
        toxic = int(rng.random() < 0.2)
        for _ in range(rng.randint(3, 8) if toxic else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words)))
        marks.append((i, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = made(spark)
    model = toxicity.train(docs.where("doc_id % 3 != 0"), labels)
    got = toxicity.score_texts(docs.where("doc_id % 3 = 0"), model, name="p").join(labels, "doc_id")
    toxic, clean = got.where("toxic = 1"), got.where("toxic = 0")
    assert toxic.where("p >= 0.3").count() / toxic.count() >= 0.95
    assert clean.where("p >= 0.3").count() / clean.count() <= 0.05
    assert got.where("p < 0 or p > 1 or p is null").count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = queries.op12_toxicity(spark, SF).cache()
    assert got.count() == docs.count()
    assert got.where("score < 0 or score > 1 or score is null or predicted != cast(score >= 0.3 as int)").count() == 0
    assert got.where("held_out").count() == docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).count()
    again = queries.op12_toxicity(spark, SF)
    assert got.join(again.withColumnRenamed("score", "s"), "doc_id").where("score != s").count() == 0       # reruns agree


def test_a_window_of_toxic_text_is_nearer_to_its_dictionary(spark):
    docs, labels = made(spark)
    model = toxicity.train(docs, labels)
    assert model.distances(BAD).min() >= 2
    plain = sorted({w for r in docs.limit(50).collect() for w in r["text"].split()} - set(BAD))
    assert model.distances(plain).mean() < 1        # single ones may be nearer by chance; scores go by how many are


def test_defined_cases(spark):
    docs, labels = made(spark, 200)
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "123 !?", "x"), (4, "wretched " * 100_000, "x"), (4, "wretched " * 100_000, "x"),
                                 (5, "y" * 300_000, None)], "doc_id int, text string, toxic string")
    model = toxicity.train(docs.withColumn("label", F.lit("x")), labels)
    got = toxicity.score_texts(odd, model, name="toxic")
    assert got.columns == ["doc_id", "text", "toxic"]
    score = [(r["doc_id"], r["toxic"]) for r in got.orderBy("doc_id").collect()]
    assert score[0][1] == score[1][1] == score[2][1] and score[3][1] == score[4][1] > 0.9 and all(0 <= s <= 1 for _, s in score)
    assert toxicity.score_texts(odd.where("false"), model).count() == 0


def test_labels_of_one_kind_or_none(spark):
    docs, labels = made(spark, 40)
    some = spark.createDataFrame([(1, "words"), (2, None)], "doc_id int, text string")
    for known, want in ((labels.where("false"), 0.0), (labels.where("toxic = 0"), 0.0), (labels.where("toxic = 1"), 1.0),
                        (labels.withColumn("toxic", F.lit(None).cast("int")), 0.0), (labels.withColumn("toxic", F.lit(7)), 0.0)):
        model = toxicity.train(docs, known)
        assert [r["toxicity"] for r in toxicity.score_texts(some, model).collect()] == [want, want]
    nothing = docs.withColumn("text", F.lit(None).cast("string"))
    scores = [r["toxicity"] for r in toxicity.score_texts(some, toxicity.train(nothing, labels)).collect()]
    assert all(0 <= s <= 1 for s in scores)


@pytest.mark.parametrize("words", [1, 5, 63, 64, 200, 3000])
def test_dictionaries_of_few_and_many_windows(words):
    weights = {f"w{i}x{i * i}": 1 + i % 7 for i in range(words)}
    weights = {"".join(chr(97 + int(c)) if c.isdigit() else c for c in w): n for w, n in weights.items()}
    model = toxicity.Model(toxicity.train_dictionary(weights, 4096), toxicity.train_dictionary({}, 4096), 0.5)
    assert model.distances(list(weights)).max() > 0
