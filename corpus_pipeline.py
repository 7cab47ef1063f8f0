"""A training corpus from ``documents``: five stages, each an operator of ``tidemark.llm``.

Each stage works on all that its predecessor kept, written as Parquet and read
again; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, langid, mixing, neardup, pii
from tidemark.llm.common import scratch

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told, be it narrowly; those without a letter go (``und``)."""
    found = langid.identify(docs, langid.train(docs.select("text", "lang")), prefix="_stage_")
    return found.where(F.col("_stage_pred") != langid.UNDETERMINED).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (similarity 0.8 or more)."""
    return neardup.keep_one(docs, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs, pii.train(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, once for each taking."""
    return mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text they decode to."""
    coded = bpe.round_trip_bpe(docs.select("doc_id", "source", "lang", "text"), TOKENIZER)
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixture", mixture), ("tokens", tokens)]

ORACLE_SQL = None       # classifiers, sketches and merges are not SQL: tests hold the rows against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
