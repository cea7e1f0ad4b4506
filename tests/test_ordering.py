import hashlib

from pyspark.sql import functions as F

from headstart.operators import ordering as O


def _pos(df, n_parts):
    return {r.vec_id: r.pos for r in O.with_position(df.repartition(n_parts), "vec_id", 42).collect()}


def test_same_seed_same_positions_any_partitioning(emb):
    df = emb.select("vec_id")
    a, b = _pos(df, 1), _pos(df, 7)
    assert a == b
    assert sorted(a.values()) == list(range(df.count()))


def test_different_seed_changes_order(emb):
    df = emb.select("vec_id")
    a = {r.vec_id: r.pos for r in O.with_position(df, "vec_id", 1).collect()}
    b = {r.vec_id: r.pos for r in O.with_position(df, "vec_id", 2).collect()}
    assert a != b


def test_shuffle_order_sorted_within_range_partitions(emb):
    o = O.shuffle_order(emb.select("vec_id"), "vec_id", 42, num_partitions=4)
    keys = [r[O.KEY] for r in o.collect()]
    assert keys == sorted(keys)


def test_split_disjoint_and_complete(emb):
    s = O.split_fixed(O.with_position(emb.select("vec_id"), "vec_id", 42), 50, 60)
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"valid": 50, "test": 60, "train": emb.count() - 110}
    assert s.select("vec_id").distinct().count() == emb.count()


def test_minibatch_assignment_shape(emb):
    a = O.assign_minibatches(O.with_position(emb.select("vec_id"), "vec_id", 42), 4, 8, 5)
    per = a.groupBy("round", "worker", "batch").count().filter("round = 0")
    assert per.count() == 4 * 5 and per.agg(F.max("count")).first()[0] == 8


def _exact(rows, seed=42):
    """Positions by a plain sort on (md5, id); rows of one id as a set of positions."""
    key = lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i)
    out = {}
    for pos, i in enumerate(sorted(rows, key=key)):
        out.setdefault(i, set()).add(pos)
    return out


def _got(df, **kw):
    out = {}
    for r in O.with_position(df, "vec_id", 42, **kw).collect():
        out.setdefault(r.vec_id, set()).add(r.pos)
    return out


def test_exact_order_at_3_and_7_partitions(spark):
    ids = list(range(3000)) + [5] * 40
    df = spark.createDataFrame([(i,) for i in ids], "vec_id long")
    want = _exact(ids)
    assert _got(df.repartition(3)) == want
    assert _got(df.repartition(7)) == want


def test_hot_id_clustered_in_one_partition_is_split(spark):
    # half of the rows share one id, and all of those come from one input partition
    df = spark.range(4000).select(F.when(F.col("id") < 2000, F.lit(7)).otherwise(F.col("id")).alias("vec_id"),
                                  (F.col("id") % 97).alias("x")).coalesce(1)
    ids = [r.vec_id for r in df.collect()]
    assert _got(df) == _exact(ids)
    o = O.shuffle_order(df, "vec_id", 42, num_partitions=8)
    per = [r["count"] for r in o.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(per) == 8 and max(per) < 1000
    # rows of one id have one order, however the input is partitioned
    a = {r.pos: (r.vec_id, r.x) for r in O.with_position(df, "vec_id", 42).collect()}
    b = {r.pos: (r.vec_id, r.x) for r in O.with_position(df.repartition(5), "vec_id", 42).collect()}
    assert a == b


def test_millions_of_ids(spark):
    n = 2_000_000
    pos = O.with_position(spark.range(n).withColumnRenamed("id", "vec_id"), "vec_id", 42, keep_key=True)
    pos = pos.cache()
    assert pos.agg(F.min("pos"), F.max("pos"), F.countDistinct("pos")).first()[:] == (0, n - 1, n)
    # neighbours in position are neighbours in key order
    ahead = pos.select((F.col("pos") - 1).alias("pos"), F.col(O.KEY).alias("next"))
    assert pos.join(ahead, "pos").filter(F.col(O.KEY) >= F.col("next")).count() == 0
    pos.unpersist()


def test_empty_table(spark):
    assert O.with_position(spark.range(0).withColumnRenamed("id", "vec_id"), "vec_id").count() == 0


def test_shuffle_order_splits_hot_key(spark):
    df = spark.range(400).select(F.lit(1).alias("vec_id"), "id").repartition(4)
    o = O.shuffle_order(df, "vec_id", 42, num_partitions=4)
    per = [r["count"] for r in o.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(per) > 1 and max(per) < 400
