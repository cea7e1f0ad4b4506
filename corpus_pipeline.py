"""The training-data pipeline: five stages over ``documents``, each by one operator.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each
result as Parquet below ``spark.checkpoint.dir`` and hands it to the next stage. The executors
serve all stages one after another, so each stage hands its workers texts in small batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headstart.llm import langid, mixing, near_dedup, packing, secret_scan
from headstart.llm.common import drop_stage, small_batches, stage

#: A document whose best language has less calibrated probability than this is rejected.
MIN_LANG_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier recognises; the rest go."""
    small_batches(spark)
    pred, score = "_lang_pred", "_lang_score"
    marked = langid.predict(docs, langid.train(docs), pred, score)
    return marked.filter((F.col(pred) != langid.UND) & (F.col(score) >= MIN_LANG_SCORE)).drop(pred, score)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    small_batches(spark)
    return near_dedup.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the secrets in its text replaced."""
    small_batches(spark)
    return secret_scan.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.epochs_of(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in the training sequences."""
    return packing.pack(docs)


STAGES = [("language", language), ("dedup", dedup), ("secrets", secrets), ("mix", mix), ("pack", pack)]

#: Trained language identification and public tokenizers aren't SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            drop_stage(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
