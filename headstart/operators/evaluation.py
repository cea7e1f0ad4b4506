"""Distributed evaluation from a scored table (A1–A5).

The scored table is read once: one partial+final hash aggregate to the confusion table
``(label, pred, n, nll_sum)``, which has at most classes² rows. Every metric is derived
from that small table, so the whole evaluation is a single pass over the data. ``by``
columns (e.g. a split tag) evaluate several tables in the same pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(scored: DataFrame, *, label: str = "label", pred: str = "pred",
              nll: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """``label int, pred int, n bigint`` (+ ``nll_sum`` when a loss column is given) (A1)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if nll is not None:
        aggs.append(F.sum(nll).alias("nll_sum"))
    return scored.groupBy(*by, F.col(label).alias("label"), F.col(pred).alias("pred")).agg(*aggs)


def per_class_stats(conf: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``cls, tp, predicted, actual, precision, recall`` (+ ``nll_sum`` of the rows whose
    label is ``cls``); precision is null for classes never predicted, recall null for
    classes that never occur (A3, A4)."""
    has_loss = "nll_sum" in conf.columns
    zero = F.lit(0).cast("bigint")
    nll = F.col("nll_sum") if has_loss else F.lit(None).cast("double")
    side = F.explode(F.array(
        F.struct(F.col("label").alias("cls"),
                 F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(zero).alias("tp"),
                 zero.alias("predicted"), F.col("n").alias("actual"), nll.alias("nll_sum")),
        F.struct(F.col("pred").alias("cls"), zero.alias("tp"), F.col("n").alias("predicted"),
                 zero.alias("actual"), F.lit(None).cast("double").alias("nll_sum"))))
    out = (conf.select(*by, side.alias("s")).select(*by, "s.*")
           .groupBy(*by, "cls")
           .agg(F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"),
                F.sum("actual").alias("actual"), F.sum("nll_sum").alias("nll_sum"))
           .withColumn("precision", F.col("tp") / F.nullif(F.col("predicted"), zero))
           .withColumn("recall", F.col("tp") / F.nullif(F.col("actual"), zero)))
    return out if has_loss else out.drop("nll_sum")


def accuracy(conf: DataFrame) -> DataFrame:
    """One row: ``accuracy`` = correct / all (A2)."""
    return conf.agg((F.sum(F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0))
                     / F.sum("n")).alias("accuracy"))


def macro_precision_recall(conf: DataFrame) -> DataFrame:
    """One row: macro-averaged ``precision`` and ``recall`` (classes left out as above)."""
    return per_class_stats(conf).agg(F.avg("precision").alias("precision"),
                                     F.avg("recall").alias("recall"))


def mean_loss(scored: DataFrame, nll: str = "nll") -> DataFrame:
    """One row: mean negative log-likelihood ``loss`` (A5)."""
    return scored.agg(F.avg(nll).alias("loss"))


def summarize(conf: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row ``n, accuracy, precision, recall, loss`` (per ``by`` group) from a confusion
    table (with ``nll_sum`` for the loss); one aggregate over the per-class table."""
    stats = per_class_stats(conf, by)
    loss = (F.sum("nll_sum") / F.sum("actual")) if "nll_sum" in stats.columns \
        else F.lit(None).cast("double")
    return stats.groupBy(*by).agg(F.coalesce(F.sum("actual"), F.lit(0).cast("bigint")).alias("n"),
                     (F.sum("tp") / F.sum("actual")).alias("accuracy"),
                     F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                     loss.alias("loss"))


def evaluate(scored: DataFrame, *, label: str = "label", pred: str = "pred",
             nll: str | None = "nll", by: tuple[str, ...] = ()) -> DataFrame:
    """Single-pass evaluation of a predicted table → one metrics row (per ``by`` group)."""
    if nll is not None and nll not in scored.columns:
        nll = None
    return summarize(confusion(scored, label=label, pred=pred, nll=nll, by=by), by)
