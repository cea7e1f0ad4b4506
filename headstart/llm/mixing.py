"""Mixing sources to target weights (operator 9).

Sources in code point order (null last) weigh 1, 2, 3, 1, 2, 3, ... of the corpus size. A
target stops at ``max_epochs`` times its source's size; the excess goes to the others by
weight until no target is above its stop. Every document gets a hash-random key; documents
are range-sorted by it within their source, a distributed prefix sum of their sizes places
each one on the source's line, and the source is cut at exactly its budget: whole epochs
first, then the leading part of the line for the rest.

Edge cases: a null text has size 0 and takes 0; an empty table gives an empty result; rows
that repeat (same id, same text) are documents of their own, and share the same key; a
source without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import n_words, with_prefix_sums

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 9


def water_fill(sizes: list[int], weights: list[int], max_epochs: int = MAX_EPOCHS) -> list[float]:
    """Targets that share ``sum(sizes)`` by weight, none above ``max_epochs`` times its size."""
    total, target = sum(sizes), [0.0] * len(sizes)
    open_, left = [i for i, s in enumerate(sizes) if s > 0], float(total)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > max_epochs * sizes[i]]
        if not full:
            for i in open_:
                target[i] = unit * weights[i]
            break
        for i in full:
            target[i] = float(max_epochs * sizes[i])
            left -= target[i]
        open_ = [i for i in open_ if i not in set(full)]
    return target


def source_targets(sized: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, target`` for every source.

    One row per source comes to the driver: the list of sources is the mix's own
    configuration (named sources), not data.
    """
    spark = sized.sparkSession
    rows = sized.groupBy("source").agg(F.sum("size").alias("source_size")).collect()
    rows = sorted(rows, key=lambda r: (r.source is None, (r.source or "").encode("utf-32-be")))
    sizes = [int(r.source_size) for r in rows]
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))]
    targets = water_fill(sizes, weights, max_epochs)
    return spark.createDataFrame([(r.source, s, t) for r, s, t in zip(rows, sizes, targets)],
                                 "source string, source_size long, target double")


def random_key(seed: int = SEED) -> Column:
    """A document's hash-random place on its source's line, the same in any engine with md5."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                          F.coalesce(F.col("text"), F.lit(""))))


def mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken, key`` for every document of ``docs``."""
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), random_key(seed).alias("key"))
    placed, scratch = with_prefix_sums(sized, ["source"], ["key", "doc_id"], "size", "before", "mix")
    t = source_targets(scratch, max_epochs).withColumnRenamed("source", "t_source")
    # one row per source, as many as the mix names
    joined = placed.join(F.broadcast(t), placed["source"].eqNullSafe(t["t_source"]))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return joined.select("doc_id", "size", "source_size", "target",
                        (epochs * F.col("size") + part).cast("long").alias("taken"), "key")


def epochs_of(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix takes them: a row for each time a document is taken.

    Documents stay whole: the one at a source's cut is taken once more if the mix takes half
    of its words or more. A document without words costs nothing and is taken once.
    """
    times = mix(docs, max_epochs, seed).select(
        F.col("doc_id").alias("_mix_id"), F.col("key").alias("_mix_key"),
        F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(F.lit(1)).cast("int").alias("_mix_times"))
    # rows that repeat an id and a text are taken equally often
    times = times.groupBy("_mix_id", "_mix_key").agg(F.max("_mix_times").alias("_mix_times")).filter("_mix_times > 0")
    joined = docs.join(times, random_key(seed).eqNullSafe(F.col("_mix_key")) & docs["doc_id"].eqNullSafe(F.col("_mix_id")))
    return joined.withColumn("_mix_times", F.explode(F.sequence(F.lit(1), F.col("_mix_times")))) \
        .drop("_mix_id", "_mix_key", "_mix_times")
