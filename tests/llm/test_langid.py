import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import langid, queries
from tests.llm.test_pipeline import SF


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = queries.op10_language(spark, SF)
    assert got.count() == docs.count()
    judged = got.where("held_out").join(docs, "doc_id").where("lang is not null and lang_pred != 'und'")
    total, right = judged.count(), judged.where("lang = lang_pred").count()
    assert total and right / total >= 0.95
    assert got.where("score < 0 or score > 1 or score is null").count() == 0


def test_codewords_differ_in_many_bits():
    for n in (2, 3, 5, 6, 20, 60):
        code = langid.codewords(n)
        assert set(np.unique(code)) == {-1.0, 1.0}
        assert all(-n < column.sum() < n for column in code.T)
        gap = (code[:, None] != code[None]).sum(2)[np.triu_indices(n, 1)]
        assert gap.min() >= 1 and (n < 6 or gap.min() >= 3)


def sample(spark):
    rows = [("der hund und die katze " * k, "de") for k in range(1, 30)] + [("the dog and the cat " * k, "en") for k in range(1, 30)]
    return spark.createDataFrame(rows + [(None, "de"), ("x", None), ("", "en")], "text string, lang string")


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "123 !?", "x"), (4, "the cat", "x"), (4, "the cat", "x"),
                                  (5, "und die katze " * 20_000, None)], "doc_id int, text string, dim string")
    got = [tuple(r) for r in langid.identify(docs, langid.train(sample(spark))).orderBy("doc_id").select(
        "doc_id", "lang_pred", F.col("lang_score") == 0, "dim").collect()]
    assert got == [(1, "und", True, "x"), (2, "und", True, "x"), (3, "und", True, "x"), (4, "en", False, "x"), (4, "en", False, "x"),
                   (5, "de", False, None)]


def test_a_text_between_two_languages_is_flagged(spark):
    model = langid.train(sample(spark))
    docs = spark.createDataFrame([("the dog and the cat the dog and the cat",), ("日本語",)], "text string")
    flagged = {r["text"]: r["lang_ambiguous"] for r in langid.identify(docs, model).collect()}
    assert flagged == {"the dog and the cat the dog and the cat": False, "日本語": True}


def test_nothing_or_one_language_to_learn(spark):
    docs = spark.createDataFrame([("words",), (None,)], "text string")
    none = langid.train(sample(spark).where("false"))
    assert {r["lang_pred"] for r in langid.identify(docs, none).collect()} == {"und"}
    one = langid.train(sample(spark).where("lang = 'de'"))
    assert [r["lang_pred"] for r in langid.identify(docs, one).collect()] == ["de", "und"]
    assert langid.identify(docs.where("false"), one).count() == 0
