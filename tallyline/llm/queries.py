"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline.llm import (
    bpe, fingerprint, html_extract, kmeans, langid, line_crf, line_dedup, lm_score, ngram_join, packing, pii,
    spelling, topk)
from tallyline.llm.oracle import ORACLE  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document and back, as digests."""
    return bpe.round_trip(_table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in power-of-two pieces."""
    packed = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "bucket")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out())
    model = langid.fit(docs.where(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "text", "held_out"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every document that repeat an earlier line, up to one changed word."""
    docs = _table(spark, sf_dir, "documents")
    counted = docs.select("doc_id", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).alias("n_lines"))
    gone = line_dedup.repeated_lines(docs)
    return counted.join(gone, "doc_id", "left").select(
        "doc_id", F.greatest("n_lines", F.lit(0)).cast("bigint").alias("n_lines"),
        F.greatest(F.size("repeated"), F.lit(0)).cast("bigint").alias("n_repeated"),
        F.coalesce(F.array_join(F.col("repeated").cast("array<string>"), ","), F.lit("")).alias("repeated"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages)).select("page_id", "url", "text", "n_chars")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.detect(_table(spark, sf_dir, "documents"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match prints of every document, its edited text and its successor."""
    return fingerprint.compare_edited(_table(spark, sf_dir, "documents"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leave-one-out trigram scores of every document."""
    return lm_score.score(_table(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one."""
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors.where(F.col("vec_id") % 20 == 0), vectors)


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector in one of 16 clusters."""
    return kmeans.with_inertia(*kmeans.cluster(_table(spark, sf_dir, "embeddings"))).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the corpus with its near words, form and root."""
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts of every document and whether it is kept."""
    docs = _table(spark, sf_dir, "documents")
    field = line_crf.fit(docs, _table(spark, sf_dir, "labels"))
    return line_crf.rate(docs, field).withColumn("n_content_lines", F.size("content_lines").cast("bigint")).drop("content_lines")


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_packing": op2_packing,
    "op3_ngram_join": op3_ngram_join,
    "op4_language": op4_language,
    "op5_line_dedup": op5_line_dedup,
    "op6_html": op6_html,
    "op7_pii": op7_pii,
    "op8_fingerprint": op8_fingerprint,
    "op9_lm_score": op9_lm_score,
    "op10_top_k": op10_top_k,
    "op11_clustering": op11_clustering,
    "op12_spelling": op12_spelling,
    "op13_quality": op13_quality,
}
