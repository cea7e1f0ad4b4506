"""Property tests: Spark column functions against plain-Python definitions (one DataFrame
per generated batch, so Spark runs stay few)."""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headstart.functions import labels as L
from headstart.operators.schedule import rate_at, rate_column

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

segment = st.text(alphabet="ab/._0123456789", min_size=0, max_size=6)
digits = st.text(alphabet="0123456789", min_size=1, max_size=5)
paths = st.builds(lambda a, d3, d4, ext: f"{a}{d3}_{d4}{ext}", segment, digits, digits,
                  st.sampled_from([".jpg", ".jpg.bak", ".png", ""]))


def _py_label(path):
    m = re.fullmatch(r".+/(\d{3})_\d{4}\.jpg", path, flags=re.S)
    return int(m.group(1)) - 1 if m else None


@SETTINGS
@given(st.lists(paths, min_size=20, max_size=60))
def test_path_label_matches_whole_string_regex(spark, batch):
    df = spark.createDataFrame([(p,) for p in batch], "path string")
    got = [r.l for r in df.select(L.path_label("path").alias("l")).collect()]
    assert got == [_py_label(p) for p in batch]


values = st.sampled_from([0.0, -0.0, 1.0, -2.0, float("nan"), 0.5])


def _py_first_nonzero(a):
    for i, v in enumerate(a):
        if math.isnan(v) or v != 0:
            return i
    return None


@SETTINGS
@given(st.lists(st.lists(values, min_size=1, max_size=6), min_size=20, max_size=40))
def test_onehot_decode_is_first_nonzero(spark, arrays):
    arrays = [a for a in arrays if _py_first_nonzero(a) is not None]  # all-zero rows fail by design
    if not arrays:
        return
    df = spark.createDataFrame([(a,) for a in arrays], "a array<float>")
    got = [r.l for r in df.select(L.onehot_decode("a").alias("l")).collect()]
    assert got == [_py_first_nonzero(a) for a in arrays]


schedules = st.dictionaries(st.integers(0, 30), st.floats(0.0001, 1.0), min_size=0, max_size=5)


@SETTINGS
@given(schedules, st.floats(0.0001, 1.0))
def test_rate_column_equals_rate_at(spark, schedule, base):
    df = spark.range(40).withColumn("rate", rate_column("id", schedule, base))
    got = [r.rate for r in df.orderBy("id").collect()]
    assert got == [rate_at(t, schedule, base) for t in range(40)]


@SETTINGS
@given(st.lists(st.integers(-(1 << 40), 1 << 40), min_size=5, max_size=30, unique=True),
       st.floats(0.05, 0.95), st.integers(0, 1000), st.integers(0, 50))
def test_dropout_mask_same_bits_in_spark_and_numpy(spark, ids, keep, seed, step):
    import numpy as np

    from headstart.functions.random import dropout_mask, dropout_mask_np

    df = spark.createDataFrame([(i,) for i in ids], "vec_id long")
    got = {r.vec_id: r.m for r in df.select("vec_id", dropout_mask("vec_id", 7, keep, seed, step).alias("m")).collect()}
    want = dropout_mask_np(np.array(ids), 7, keep, seed, step)
    assert all(list(want[k]) == got[i] for k, i in enumerate(ids))


@SETTINGS
@given(st.lists(st.integers(0, 10 ** 9), min_size=1, max_size=60, unique=True), st.integers(0, 99))
def test_position_equals_python_sort(spark, ids, seed):
    import hashlib

    from headstart.operators.ordering import with_position

    df = spark.createDataFrame([(i,) for i in ids], "vec_id long").repartition(3)
    got = {r.vec_id: r.pos for r in with_position(df, "vec_id", seed).collect()}
    order = sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
    assert got == {i: k for k, i in enumerate(order)}
