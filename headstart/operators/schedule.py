"""Learning-rate schedules: parse ``iter,rate|iter,rate`` (T11) and look up the rate in
force at an iteration (T12).

A schedule given on the command line is parsed and checked on the driver, before any job
starts. Schedules that are data stay data: :func:`parse_schedules` parses a column of texts, and
:func:`rate_asof` looks rates up in a schedule table of any size. :func:`rate_column` is the
same lookup for a parsed argument.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .ordering import ROW_BITS


def parse_schedule(text: str) -> dict[int, float]:
    """``'0,0.1|3,0.01'`` → ``{0: 0.1, 3: 0.01}``; duplicate iterations: the last wins.

    Every pair has exactly two parts, iteration ≥ 0 and rate > 0, else ``ValueError``.
    """
    out: dict[int, float] = {}
    for pair in text.split("|"):
        parts = pair.split(",")
        if len(parts) != 2:
            raise ValueError(f"schedule entry {pair!r} must be 'iteration,rate'")
        it, rate = int(parts[0]), float(parts[1])
        if it < 0 or not rate > 0:
            raise ValueError(f"schedule entry {pair!r}: need iteration >= 0 and rate > 0")
        out[it] = rate
    return dict(sorted(out.items()))


def rate_at(iteration: int, schedule: dict[int, float] | None, base: float) -> float:
    """Rate of the last entry at or before ``iteration``; ``base`` before the first."""
    rate = base
    for it, r in sorted((schedule or {}).items()):
        if it <= iteration:
            rate = r
        else:
            break
    return rate


def rate_column(iteration, schedule: dict[int, float] | None, base: float) -> Column:
    """The same lookup as a column expression."""
    it = F.col(iteration) if isinstance(iteration, str) else iteration
    expr = None
    for k, r in sorted((schedule or {}).items(), reverse=True):
        expr = F.when(it >= k, F.lit(r)) if expr is None else expr.when(it >= k, F.lit(r))
    return F.lit(float(base)) if expr is None else expr.otherwise(F.lit(float(base)))


def parse_schedules(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """``keys, iteration int, rate double`` of a column of schedule texts (T11), a row for each
    iteration of a text; duplicate iterations: the last wins.

    A text that is null has no rows; one with a bad pair (not two parts, iteration < 0 or not whole,
    rate not > 0) fails the job with the pair in the message, wherever the pair stands.
    """
    pairs = df.select(*keys, F.posexplode(F.split(text, r"\|", -1)).alias("_place", "_pair")).withColumn("_kv", F.split("_pair", ",", -1))
    it, rate = F.expr("try_cast(get(_kv, 0) AS int)"), F.expr("try_cast(get(_kv, 1) AS double)")
    good = (F.size("_kv") == 2) & F.coalesce(it >= 0, F.lit(False)) & F.coalesce(rate > 0, F.lit(False)) & ~F.coalesce(F.isnan(rate), F.lit(False))
    message = F.concat(F.lit("schedule entry '"), "_pair", F.lit("' must be 'iteration,rate' with iteration >= 0 and rate > 0"))
    checked = pairs.select(*keys, "_place", F.when(good, it).otherwise(F.raise_error(message).cast("int")).alias("iteration"), rate.alias("rate"))
    return checked.groupBy(*keys, "iteration").agg(F.max_by("rate", "_place").alias("rate"))


def schedule_frame(spark: SparkSession, text: str) -> DataFrame:
    """``iteration int, rate double`` of one schedule (last duplicate wins)."""
    parse_schedule(text)  # validate first
    return parse_schedules(spark.range(1).select(F.lit(text).alias("text")), "text")


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the rate of the last schedule entry so far in the range; the entries go."""
    last = None
    for b in batches:
        rates = b.column("_rate").to_pylist() if b.num_rows else []
        known = np.array([r is not None for r in rates], bool)
        at = np.maximum.accumulate(np.where(known, np.arange(len(rates)), -1)) if rates else np.empty(0, np.int64)
        filled = [last if k < 0 else rates[k] for k in at.tolist()]
        last = filled[-1] if filled else last
        out = b.set_column(b.schema.get_field_index("_rate"), "_rate", pa.array(filled, pa.float64()))
        yield out.filter(pa.array(~known))


def rate_asof(df: DataFrame, schedule: DataFrame, iteration: str = "iteration", base: float | None = None, out: str = "rate") -> DataFrame:
    """``df`` with the rate of the last entry of ``schedule`` (``iteration, rate``, iterations distinct) at or
    before its iteration, ``base`` before the first and for a null iteration (T12).

    An as-of join without a join on an inequality: both tables are sorted together by one range
    exchange, entries before rows of the same iteration (a last key splits iterations that many
    rows share); a pass over each range carries the last rate on; and the last rate of the
    ranges before (one row per range) fills what comes before a range's first entry.
    """
    checkpoint_root(df.sparkSession)
    rows = df.select(F.struct(*df.columns).alias("_row"), F.col(iteration).cast("long").alias("_it"), F.lit(1).alias("_kind"),
                     F.monotonically_increasing_id().alias("_tie"), F.lit(None).cast("double").alias("_rate"))
    entries = schedule.select(F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), F.col("iteration").cast("long").alias("_it"),
                              F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_tie"), F.col("rate").cast("double").alias("_rate"))
    by = ("_it", "_kind", "_tie")
    # the sorted ranges are fixed, so their numbers hold on every retry
    ranged = rows.unionByName(entries).repartitionByRange(*by).sortWithinPartitions(*by).checkpoint(eager=True)
    number = F.shiftright(F.monotonically_increasing_id(), ROW_BITS).cast("int")
    numbered = ranged.withColumn("_range", number)
    lasts = numbered.groupBy("_range").agg(F.max_by("_rate", F.when(F.col("_kind") == 0, F.col("_it"))).alias("_last"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    carried = lasts.select("_range", F.last("_last", ignorenulls=True).over(before).alias("_before"))
    kept = numbered.select("_row", "_rate", "_range")
    filled = kept.mapInArrow(_carry, kept.schema).join(carried, "_range", "left")
    found = F.coalesce("_rate", "_before") if base is None else F.coalesce("_rate", "_before", F.lit(float(base)))
    return filled.select("_row.*", found.alias(out))
