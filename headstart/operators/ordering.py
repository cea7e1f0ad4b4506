"""Seeded shuffle, dense global position, fixed-size split, mini-batch assignment (O1–O3, T4).

The order is ``md5('<seed>:<id>')``, then the id, then a hash of the whole row, so rows that
share an id have a fixed order too. The dense position needs no window over the data:

1. one range exchange on (key, id, row hash, input row number) sorts the table into
   ranges. The last key only tells rows apart that are equal in every column, so the range
   partitioner can split any group, and which of such rows comes first doesn't matter.
   The number of ranges is the session's shuffle partitions, coalesced by AQE to the data's size;
2. the sorted ranges are checkpointed, which fixes their rows on every retry;
3. the ranges' row counts give each range's offset (one row per range), and
   position = offset + row number within the range.

Positions are exact and the same at any size and partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.random import order_key
from ..session import checkpoint_root

KEY, HASH, TIE, RANGE = "_order_key", "_order_hash", "_order_tie", "_order_range"
#: ``monotonically_increasing_id`` counts rows of a partition in its low 33 bits.
ROW_BITS = 33


def shuffle_order(df: DataFrame, id_col: str, seed: int = 42, num_partitions: int | None = None,
                  key: str = KEY) -> DataFrame:
    """Rows range-partitioned and sorted by the seeded key (O1): one range exchange.

    Without ``num_partitions`` AQE sizes the ranges by the data.
    """
    keyed = (df.withColumn(key, order_key(id_col, seed))
             .withColumn(HASH, F.xxhash64(*df.columns)).withColumn(TIE, F.monotonically_increasing_id()))
    by = (key, id_col, HASH, TIE)
    ranged = keyed.repartitionByRange(num_partitions, *by) if num_partitions else keyed.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by).drop(HASH, TIE)


def with_position(df: DataFrame, id_col: str, seed: int = 42, out: str = "pos",
                  keep_key: bool = False) -> DataFrame:
    """Append the dense 0-based position ``out`` in seeded order (O3)."""
    checkpoint_root(df.sparkSession)
    ranged = shuffle_order(df, id_col, seed)
    ranged = (ranged if keep_key else ranged.drop(KEY)).checkpoint(eager=True)
    n = F.monotonically_increasing_id()
    numbered = ranged.withColumn(RANGE, F.shiftright(n, ROW_BITS).cast("int")) \
        .withColumn(out, n.bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
    # one row per range: the running sum is over the number of partitions
    counts = ranged.groupBy(F.spark_partition_id().alias(RANGE)).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(RANGE, (F.sum("_n").over(Window.orderBy(RANGE)) - F.col("_n")).alias("_off"))
    return (numbered.join(offsets, RANGE).withColumn(out, F.col("_off") + F.col(out)).drop("_off", RANGE))


def split_fixed(positioned: DataFrame, n_valid: int, n_test: int, pos: str = "pos",
                out: str = "split") -> DataFrame:
    """First ``n_valid`` positions → valid, next ``n_test`` → test, rest → train (O2)."""
    if n_valid < 0 or n_test < 0:
        raise ValueError("split sizes must be >= 0")
    p = F.col(pos)
    return positioned.withColumn(out, F.when(p < n_valid, "valid")
                                 .when(p < n_valid + n_test, "test").otherwise("train"))


def assign_minibatches(positioned: DataFrame, workers: int, batch_size: int, avg_freq: int,
                       pos: str = "pos") -> DataFrame:
    """``round, worker, batch`` from the position (T4): a round is ``workers·batch·avg_freq``
    consecutive rows; each worker gets ``avg_freq`` batches of ``batch_size`` rows."""
    for name, v in (("workers", workers), ("batch_size", batch_size), ("avg_freq", avg_freq)):
        if v <= 0:
            raise ValueError(f"{name} must be positive")
    per_round = workers * batch_size * avg_freq
    per_worker = batch_size * avg_freq
    p = F.col(pos)
    return (positioned
            .withColumn("round", (p / F.lit(per_round)).cast("long").cast("int"))
            .withColumn("worker", (F.pmod(p, F.lit(per_round)) / F.lit(per_worker)).cast("long").cast("int"))
            .withColumn("batch", (F.pmod(p, F.lit(per_worker)) / F.lit(batch_size)).cast("long").cast("int")))
