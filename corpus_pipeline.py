"""The corpus pipeline: documents through the training-data operators, stage by stage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline.llm import langid, line_dedup, ngram_join, packing, pii
from tallyline.session import shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or far from every language learned from the labelled ones, go."""
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.predict(docs.select(F.struct(*docs.columns).alias("row"), "text"), model)
    return found.where(~F.col("rejected")).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line, up to one changed word, leave the texts."""
    return line_dedup.drop_repeated(docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays, the one with the smallest id.

    Each row is decided by its own text, also where ids repeat or are null; of identical rows
    one stays. Documents that lost all their lines have no words and link with nothing, so
    they stay. An empty table stays empty, and further columns, whatever their names, pass.
    """
    return ngram_join.keep_one(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; every document stays."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become token pieces of power-of-two lengths."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("personal_data", hide_personal_data),
    ("packing", pack_sequences),
]

# Fitted centroids, edit distances over hashed neighbourhoods, connected components and a
# tokenizer file have no SQL form; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
