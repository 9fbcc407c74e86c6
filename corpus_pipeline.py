"""The corpus pipeline: each stage reads all that the one before it kept.

1. language     documents whose language is not identified go; ``lang`` is what was identified.
2. near         of each group of similar documents the one with the smallest id stays.
3. benchmark    documents that hold benchmark passages go.
4. secrets      secrets are masked, copied examples stay as they are.
5. pieces       the ids of the subword pieces of every text that is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loticote.llm import decontaminate, language, pieces, secrets, shingles
from loticote.llm.common import prepare
from loticote.session import materialize, tune

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(tune(spark))
    found = language.detect_language(docs, keep=COLUMNS)
    kept = found.where(F.col("lang_pred") != language.UNKNOWN)
    named = {c: F.col(f"keep_{c}") for c in COLUMNS} | {"lang": F.col("lang_pred")}
    return kept.select(*(named[c].alias(c) for c in COLUMNS))


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(tune(spark))
    return shingles.keep_one(docs).select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(tune(spark))
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_leaks(docs.select(*COLUMNS), benchmark)


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(tune(spark))
    masked = secrets.mask_secrets(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(tune(spark))
    return pieces.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language", identified),
    ("near", one_of_similar),
    ("benchmark", without_benchmark),
    ("secrets", masked_secrets),
    ("pieces", encoded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written and read back for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
