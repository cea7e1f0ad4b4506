import numpy as np
import pytest
from pyspark.sql import functions as F

from headstart.operators.scoring import featurize, predict, score
from headstart.plans import fixtures as FX


def _collect(df):
    return {r.vec_id: (r.pred, r.prob) for r in df.collect()}


def test_scores_independent_of_batch_and_partitions(spark, emb):
    m = FX.one_layer()
    a = _collect(predict(emb.repartition(1), m, features="embedding", keep=["vec_id", "label"], batch_rows=7))
    b = _collect(predict(emb.repartition(5), m, features="embedding", keep=["vec_id", "label"], batch_rows=4096))
    assert a.keys() == b.keys()
    assert all(a[k][0] == b[k][0] and a[k][1] == pytest.approx(b[k][1], abs=1e-15) for k in a)


def test_plugin_scorer_runs_once_per_task(spark, emb):
    def factory():
        w = np.ones((64, 2))
        return lambda x: x @ w

    out = featurize(emb, factory, input_col="embedding", output_col="f", keep=["vec_id"])
    r = out.join(emb, "vec_id").select("f", "embedding").first()
    assert r.f[0] == pytest.approx(sum(r.embedding), abs=1e-6) and len(r.f) == 2


def test_wrong_width_and_null_rejected(spark):
    df = spark.createDataFrame([(1, [0.1, 0.2], 0)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="must all have length 64"):
        score(df, FX.one_layer(), features="embedding", keep=["vec_id"]).collect()
    from headstart.sources.features import require_not_null

    nul = spark.createDataFrame([(1, None, 0)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="null in column embedding"):
        require_not_null(nul, ["embedding", "label"]).collect()
    assert require_not_null(nul, ["embedding"], on_null="drop").count() == 0


def test_with_probs_sums_to_one(spark, emb):
    out = predict(emb, FX.one_layer(), features="embedding", keep=["vec_id"], label=None, with_probs=True)
    s = out.select(F.aggregate("probs", F.lit(0.0), lambda a, x: a + x).alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-12 for r in s)


def test_packed_layout_scores_like_arrays(spark, emb):
    from headstart.sources.features import to_array, to_packed

    packed = to_packed(emb, "embedding")
    assert packed.schema["embedding"].dataType.simpleString() == "binary"
    a = _collect(predict(emb, FX.one_layer(), features="embedding", keep=["vec_id", "label"]))
    b = _collect(predict(packed, FX.one_layer(), features="embedding", keep=["vec_id", "label"]))
    assert a == b
    back = to_array(packed, "embedding").join(emb.withColumnRenamed("embedding", "orig"), "vec_id")
    assert back.filter("embedding != orig").count() == 0
    out = score(packed, FX.one_layer(), features="embedding", keep=["vec_id"], output_packed=True)
    assert out.schema["output"].dataType.simpleString() == "binary"
    assert len(out.first().output) == 10 * 4


def test_null_label_or_features_fail_where_consumed(spark):
    from headstart.operators.training import FitParams, fit
    from headstart.model import dense, init_params

    df = spark.createDataFrame([(1, [0.0] * 64, None), (2, [0.0] * 64, 1)],
                               "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="null in column label"):
        predict(df, FX.one_layer(), features="embedding", keep=["vec_id"]).collect()
    m = init_params([dense("out", 64, 10, "softmax")], scheme="zeros")
    with pytest.raises(Exception, match="null in column label"):
        fit(df, m, FitParams(workers=1, batch_size=2, avg_freq=1), id_col="vec_id", features="embedding")
    nf = spark.createDataFrame([(1, None, 0)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="null feature vector"):
        predict(nf, FX.one_layer(), features="embedding", keep=["vec_id"]).collect()


def test_float32_compute_is_close(spark, emb):
    a = {r.vec_id: r.output for r in score(emb, FX.one_layer(), features="embedding", keep=["vec_id"]).collect()}
    for kw in (dict(), dict(output_float=True)):
        b = {r.vec_id: r.output for r in score(emb, FX.one_layer(), features="embedding", keep=["vec_id"], dtype=np.float32, **kw).collect()}
        assert all(np.allclose(a[k], b[k], atol=1e-6) for k in a)
    p = predict(emb, FX.one_layer(), features="embedding", keep=["vec_id"], dtype=np.float32).collect()
    assert all(abs(r.prob - max(a[r.vec_id])) < 1e-6 for r in p)


def test_null_element_is_refused(spark):
    df = spark.createDataFrame([(1, [1.0] * 63 + [None], 0)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="null element"):
        predict(df, FX.one_layer(), features="embedding").collect()
