"""One query per operator over its whole table, ``opN_<name>``, and DuckDB SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, bpe, collocations, html, langid, licenses, mixing, neardup, pii, quality, spelling, toxicity, warc
from tidemark.llm.common import scratch, stage
from tidemark.llm.oracles import ORACLES  # noqa: F401  registered with the queries


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 3, 1, 2 in turn, 150 % of all words, a source at most twice."""
    return mixing.mix_sizes(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses found in the documents."""
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, the base rule and the learned decision list's verdict on every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = stage(quality.text_statistics(docs).drop("text"), "quality-statistics")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    rules = quality.learn(measured.where("not base_failed").join(labels, "doc_id"))
    return quality.apply_rules(measured, rules)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingles agree to 85 % or more."""
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again; digests of both."""
    path = public_tokenizers.path("word_bpe_49k.json")
    back = bpe.round_trip_bpe(_table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base spans, and all spans."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_spans(docs, pii.train(docs)).drop("text")
    base = F.filter("spans", lambda s: s["base"])
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in pii.BASE_KINDS], F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vector whose id is divisible by 20."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC files and read back through verified record boundaries."""
    path = scratch(spark, "warc")
    warc.write_warc(_table(spark, sf_dir, "pages"), path)
    records = warc.resolve_revisits(warc.read_warc(spark, path, payloads=False))
    return records.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                          F.col("type").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"))


def held_out() -> Column:
    """Documents that train no language classifier."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    out = held_out()
    model = langid.train(docs.where(~out).select("text", "lang"))
    found = langid.identify(docs.select("doc_id", "text"), model).drop("text")
    return found.select("doc_id", out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
                        F.col("lang_ambiguous").alias("ambiguous"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, their near words and the frequent forms they are variants of."""
    return spelling.spelling_variants(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from labelled documents that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = toxicity.train(docs.where(~out), _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = toxicity.score_texts(docs, model, name="score")
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of two to four words in each language."""
    return collocations.collocations(_table(spark, sf_dir, "documents").select("lang", "text"))


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_license_scan, op3_quality_rules, op4_near_duplicates, op5_bpe, op6_pii, op7_main_text, op8_nearest,
    op9_warc, op10_language, op11_spelling, op12_toxicity, op13_collocations)}
