"""Schedules as data: parsed from a column, looked up as of an iteration in a table."""

import bisect

import pytest
from pyspark.sql import functions as F

from headstart.operators.schedule import parse_schedule, parse_schedules, rate_asof, schedule_frame


def test_texts_parse_like_the_argument(spark):
    texts = ["0,0.1|3,0.01|3,0.05|7,0.001", "5,1", " 2 , 0.5|2,0.25", "0,1e-3|0,2e-3|0,3e-3"]
    df = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)] + [(9, None, "clash")], "k int, t string, iteration string")
    got = {}
    for r in parse_schedules(df, "t", "k").collect():
        got.setdefault(r.k, {})[r.iteration] = r.rate
    assert got == {k: parse_schedule(t) for k, t in enumerate(texts)}
    assert parse_schedules(df.limit(0), "t", "k").count() == 0


@pytest.mark.parametrize("bad", ["", "3", "1,0.1|", "1,0.1|2", "-1,0.1", "1,0", "1,-2", "x,0.1", "1,x", "1,0.1,2", "1.5,0.1", "1,NaN", "1,0.1|1,0|1,0.2"])
def test_bad_pairs_fail_the_job(spark, bad):
    df = spark.createDataFrame([("0,0.1",), (bad,)], "t string")
    with pytest.raises(Exception, match="schedule entry"):
        parse_schedules(df, "t").collect()


def test_asof_equals_a_search_over_many_ranges(spark):
    entries = {k * 7 % 501: 1.0 / (k + 1) for k in range(60)}
    sched = spark.createDataFrame(sorted(entries.items()), "iteration int, rate double").repartition(7)
    # half of the rows share one iteration; some have none
    df = spark.range(3000).select("id", F.when(F.col("id") % 2 == 0, 250).when(F.col("id") % 101 == 0, F.lit(None)).otherwise(F.col("id") % 600 - 20).cast("int").alias("iteration"),
                                  F.lit("clash").alias("_rate"), F.lit("clash").alias("rate_before"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rate_asof(df, sched, base=9.0).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    keys = sorted(entries)
    assert len(got) == 3000 and got[0].asDict().keys() == {"id", "iteration", "_rate", "rate_before", "rate"}
    for r in got:
        at = -1 if r.iteration is None else bisect.bisect_right(keys, r.iteration) - 1
        assert r.rate == (9.0 if at < 0 else entries[keys[at]]), r


def test_asof_without_entries_rows_or_base(spark):
    df = spark.createDataFrame([(1, 4), (2, None)], "id int, iteration int")
    none = spark.createDataFrame([], "iteration int, rate double")
    assert [r.rate for r in rate_asof(df, none).collect()] == [None, None]
    assert [r.rate for r in rate_asof(df, none, base=0.5).collect()] == [0.5, 0.5]
    assert rate_asof(df.limit(0), schedule_frame(spark, "0,0.1")).count() == 0
    assert {r.id: r.rate for r in rate_asof(df, schedule_frame(spark, "4,0.2|5,0.1")).collect()} == {1: 0.2, 2: None}


def test_asof_has_no_inequality_join(spark):
    df = spark.range(10).select(F.col("id").alias("iteration"))
    plan = rate_asof(df, schedule_frame(spark, "0,0.1|5,0.2"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
