"""Helpers shared by the operators: word splitting, Arrow mapping, scratch tables, ranges.

Words everywhere are ``[^\\x20\\x09-\\x0D]+`` (what ``bytes.split()`` splits by); lower-casing
touches A-Z only (what ``bytes.lower()`` does). Scratch tables are Parquet below
``spark.checkpoint.dir``, so they outlive executors.
"""

from __future__ import annotations

import ctypes
import gc
import time
import uuid
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import remove_path, scratch_path, ship_package

WORD_CLASS = r"[^ \t-\r]+"
#: Bytes of rows that Spark hands a worker at once, about, where a step asks for small batches.
BATCH_BYTES = 2 << 20


def n_words(text: Column) -> Column:
    """Words in ``text``; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS)), F.lit(0)).cast("long")


def fold_of(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; 0 stands in for a null id's text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with the package available to the workers."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_unused()
        yield from fn(batches)

    return df.mapInArrow(run, schema)


def small_batches(spark: SparkSession) -> None:
    """From now on the session hands its workers batches of ``BATCH_BYTES``, not of 10,000 rows.

    Worker and executor hold a batch whole, the executor outside its heap and, while it grows, several
    times over; 10,000 texts are 35 MB and more. Rows don't depend on it. Spark has no such setting for
    one query alone and reads it when a query runs, so it stays for the session.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_kept: dict[Hashable, object] = {}
_asked: set[Hashable] = set()


def kept(key: Hashable, make: Callable[[], object]):
    """What ``make`` gives, kept in this worker for as long as its tasks ask for it."""
    if key not in _kept:
        _kept[key] = make()
    _asked.add(key)
    return _kept[key]


def forget_unused() -> None:
    """Before a task: what the worker's last task didn't ask for goes, and free memory returns to the
    system. A worker serves the stages of a job in turn; one stage's vocabulary and caches mustn't add
    up with those of the next."""
    if unused := _kept.keys() - _asked:
        for key in unused:
            del _kept[key]
        gc.collect()
    _asked.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone keeps what was freed
        trim(0)


def text_slices(batch: pa.RecordBatch, slice_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of about ``slice_bytes`` of ``text``, at least a row each."""
    total = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + slice_bytes)))
        yield batch.slice(lo, hi - lo)
        lo = hi


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh scratch table and read it back: cuts the lineage for good.

    ``drop_stage`` removes a table that nothing reads any more; one that a returned plan still
    reads goes when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_folder = path
    return out


def drop_stage(*tables: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more."""
    for t in tables:
        remove_path(t.sparkSession, t.scratch_folder)


def bucketed(df: DataFrame, key: str, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """A scratch table sorted in one file per bucket of ``key``, so that joins on ``key`` don't
    shuffle it again; and what deletes it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"scratch_{uuid.uuid4().hex}"
    n = shuffle_partitions(spark)
    df.repartition(n, key).write.option("path", path).bucketBy(n, key).sortBy(key).saveAsTable(table, format="parquet")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)

    def drop() -> None:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove_path(spark, path)

    return spark.table(table), drop


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now: it does so once the driver's
    garbage collector has seen that no plan can read them any more. A first collection lets
    go of the Python side's handles, a second one of what they held."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_prefix_sums(df: DataFrame, group: list[str], order: list[str], value: str, out: str,
                     name: str) -> tuple[DataFrame, DataFrame]:
    """Exclusive running sum of ``value`` within ``group`` in ``order``, over any group size.

    Range partitioning by (group, order) cuts a large group into several sorted ranges. The
    ranges are written once; their sums give each range's offset; a window inside a range
    adds the rest. No task holds more than a range. Returns (result, the scratch table that
    the result reads).
    """
    n = shuffle_partitions(df.sparkSession)
    ranged = stage(df.repartitionByRange(n, *group, *order).withColumn("_range", F.spark_partition_id()), name)
    sums = ranged.groupBy("_range", *group).agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*group).orderBy("_range") if group else Window.orderBy("_range")
    offsets = sums.withColumn("_offset", F.sum("_sum").over(w) - F.col("_sum")).drop("_sum")
    inside = Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    cond = [local["_range"] == offsets["_range"]] + [local[g].eqNullSafe(offsets[g]) for g in group]
    drop = offsets.drop("_offset").columns
    joined = local.join(offsets, cond)
    for c in drop:
        joined = joined.drop(offsets[c])
    return joined.withColumn(out, F.col("_local") + F.col("_offset")).drop("_local", "_offset", "_range"), ranged
