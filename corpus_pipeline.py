"""Cleaning pipeline over the documents table. Each stage is written as Parquet before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkpanel.llm.exact import exact_dedup
from sparkpanel.llm.language import fit_language, predict_language
from sparkpanel.llm.minhash import near_duplicates
from sparkpanel.llm.packing import pack
from sparkpanel.llm.queries import held_out
from sparkpanel.llm.staging import small_batches, staged
from sparkpanel.llm.suffixes import drop_repeated_bytes

#: Least calibrated probability of the predicted language; evenly spread over four languages it is 0.25.
MIN_SCORE = 0.3
#: Strings of so many bytes that occur again are looked for: the least the operator allows, as 51 words may be short.
REPEATED_BYTES = 160
#: Of the runs that such strings cover those of over 50 words go, and those of 400 bytes, as some text has no spaces.
PASSAGE_WORDS, PASSAGE_BYTES = 51, 400


def beside(docs: DataFrame, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``operator`` on the documents, with the columns it doesn't read out of the way of those it adds."""
    small_batches(docs.sparkSession)
    aside = {c: f"column_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    out = operator(docs.withColumnsRenamed(aside))
    return out.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a language: a letter at least, and a prediction of ``MIN_SCORE``."""
    small_batches(spark)
    model = fit_language(docs.filter(~held_out()), "doc_id", "text", "lang")
    accepted = (F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)
    return beside(docs, lambda d: predict_language(d, "text", model).filter(accepted))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return beside(docs, lambda d: exact_dedup(d, "doc_id", "text").filter("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that links of similarity 0.8 over five-word shingles join, the smallest id stays."""
    return beside(docs, lambda d: near_duplicates(d, "doc_id", "text", words=5, percent=80).filter("kept"))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole characters of repeated passages of over 50 words, or of 400 bytes, are removed; every row stays."""
    text = F.when(F.col("text").isNotNull(), F.col("kept").cast("string"))
    limits = {"length": REPEATED_BYTES, "whole_characters": True, "least_words": PASSAGE_WORDS, "least_bytes": PASSAGE_BYTES}
    cut = beside(docs, lambda d: drop_repeated_bytes(d, "doc_id", "text", **limits).withColumn("text", text))
    return cut.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else cut


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4,096 ids."""
    small_batches(spark)
    return pack(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"), end_id=2, length=4096)


STAGES = [
    ("language_id", known_language), ("exact_dedup", drop_copies), ("minhash", drop_near_copies),
    ("suffix_array", cut_passages), ("packing", pack_sequences),
]

#: The first stage is a fitted model, which SQL can't express; tests/llm has plain versions of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
