import corpus_pipeline
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
from tests.llm.test_neardup import brute as components
from tests.llm.test_pii import brute as personal
from tidemark.llm import langid, mixing

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_duplicates", "personal_data", "mixture", "tokens"]

    told = stages["language"](spark, docs, SF).cache()
    assert told.columns == docs.columns
    predicted = {r["doc_id"]: r for r in langid.identify(docs.select("doc_id", "text"), langid.train(docs)).collect()}
    assert {r["doc_id"] for r in told.collect()} == {d for d, r in predicted.items() if r["lang_pred"] != "und"}
    assert told.count() == docs.where(F.col("text").rlike(r"\p{L}")).count()     # only those without a letter go

    kept = stages["near_duplicates"](spark, told, SF).cache()
    assert kept.columns == docs.columns
    texts = [(r["doc_id"], r["text"]) for r in told.collect()]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in components(texts, 80).values()})

    clean = stages["personal_data"](spark, kept, SF).cache()
    assert clean.columns == docs.columns and clean.count() == kept.count()
    assert all(personal(r["text"] or "") == [] for r in clean.collect())

    mixed = stages["mixture"](spark, clean, SF).cache()
    assert mixed.columns == docs.columns
    words = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(
        F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).collect()}
    target = {r["source"]: r["target"] for r in mixing.mix_sizes(clean).select("source", "target").distinct().collect()}
    assert all(abs(words.get(s, 0) - t) <= 2 * mixing.BLOCK_TOKENS + 1 for s, t in target.items())

    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    plain = sorted((r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids) for r in mixed.collect())
    coded = stages["tokens"](spark, mixed, SF).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in coded) == plain
    assert all(r["n_tokens"] == len(r["ids"]) for r in coded)


def test_only_documents_without_letters_go_by_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    short = docs.where("text is not null").limit(4)
    texts = ["A.\nAll rights reserved.", "De.", "日本語", "12 3 !?"]
    short = spark.createDataFrame([tuple(texts[i] if f == "text" else -1 - i if f == "doc_id" else r[f] for f in docs.columns)
                                   for i, r in enumerate(short.collect())], docs.schema)
    every = docs.unionByName(short)
    told = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["language"](spark, every, SF).select("doc_id").collect()}
    assert told == {r["doc_id"] for r in every.where(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()}
    assert {-1, -2, -3} <= told and -4 not in told


def test_stages_on_empty_and_odd_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    empty = docs.where("false")
    odd = docs.limit(3).withColumn("text", F.lit(None).cast("string")).unionByName(docs.limit(4)).unionByName(docs.limit(4)).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) if f.name in ("source", "lang", "n_chars") else F.col(f.name) for f in docs.schema])
    for start in (empty, odd):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, start, SF).count() <= 4 * start.count()


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names}
    assert corpus_pipeline.ORACLE_SQL is None
