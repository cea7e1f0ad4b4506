import numpy as np
import pytest
from pyspark.sql import functions as F

from headstart.model import dense, forward, init_params
from headstart.operators.ordering import split_fixed, with_position
from headstart.operators.training import FitParams
from headstart.plans import programs as P
from headstart.session import scratch_path
from headstart.sources.features import write_features
from headstart.sources.models import read_model

from .conftest import SF01


def _three_dense_stages():
    # three dense stages named like the layers the reference cuts at: fc1 → fc2 → predictions
    return init_params([dense("fc1", 64, 32, "relu"), dense("fc2", 32, 16, "relu"),
                        dense("predictions", 16, 10, "softmax")], scheme="fixture")


@pytest.fixture(scope="module")
def feature_root(spark):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet").withColumnRenamed("embedding", "features") \
        .withColumnRenamed("vec_id", "id")
    df = split_fixed(with_position(emb, "id", 42), 50, 60).drop("pos")
    root = scratch_path(spark, "t-features")
    write_features(df, root)
    return root


def test_second_stage_featurization(spark, feature_root):
    from headstart.operators.scoring import score

    chain = _three_dense_stages()
    # first featurization cut after fc1 (32 wide), like the image featurizer would write it
    fc1 = scratch_path(spark, "t-fc1")
    write_features(score(spark.read.parquet(feature_root), chain.upto("fc1"), features="features",
                         output="features"), fc1)
    fc2 = scratch_path(spark, "t-fc2")
    P.featurize_features(spark, fc1, fc2, chain, "fc2", layout="double")  # layers after fc1 up to fc2
    assert len(spark.read.parquet(fc2).first().features) == 16
    pred_path = scratch_path(spark, "t-pred")
    P.featurize_features(spark, fc2, pred_path, chain, "predictions", layout="double")  # after fc2
    pred = {r.id: r.features for r in spark.read.parquet(pred_path).collect()}
    src = {r.id: r.features for r in spark.read.parquet(feature_root).collect()}
    assert pred.keys() == src.keys()
    ids = sorted(pred)[:20]
    want = forward(chain, np.array([src[k] for k in ids], dtype=np.float64))
    assert np.allclose(np.array([pred[k] for k in ids]), want, atol=1e-12)
    with pytest.raises(ValueError, match="last layer"):
        P.featurize_features(spark, fc2, pred_path + "x", chain, "fc1")


def test_train_score_and_continue(spark, feature_root):
    train = f"{feature_root}/split=train"
    valid = f"{feature_root}/split=valid"
    save = scratch_path(spark, "t-head")
    p = FitParams(epochs=2, workers=2, batch_size=16, avg_freq=2, rate=0.05, eval_interval=1)
    res = P.train_head(spark, train, "predictions", n_in=64, n_classes=10, params=p, valid_path=valid,
                       save_path=save)
    assert list(res.history.split) == ["train", "valid", "train", "valid"]
    m = P.score_model(spark, save, f"{feature_root}/split=test").first()
    assert m.n == 60 and 0 <= m.accuracy <= 1
    save2 = scratch_path(spark, "t-head2")
    res2 = P.train_incrementally(spark, train, save, save2, params=p.replace(rate=0.01, schedule={0: 0.02}))
    assert res2.iterations == 2 * res.iterations
    _, _, meta = read_model(spark, save2)
    assert meta["iterations"] == res2.iterations


def test_initial_model_presets(spark):
    path = scratch_path(spark, "t-init")
    m = P.save_initial_model(spark, "fc1", path, n_in=32, n_classes=5)
    back, _, meta = read_model(spark, path)
    assert [l.name for l in back.layers] == [l.name for l in m.layers]
    assert meta["rate"] == 0.01 and meta["l2"] == 0.01
    with pytest.raises(ValueError):
        P.save_initial_model(spark, "conv", scratch_path(spark, "t-init2"), n_in=32, n_classes=5)
    with pytest.raises(ValueError, match="missing required"):
        P.train_head(spark, None, "fc2", n_in=4, n_classes=2)


def test_feature_layouts_of_written_tables(spark, feature_root):
    from headstart.operators.scoring import score

    chain = _three_dense_stages()
    types = {}
    # the stage that starts after fc1 reads fc1 features

    fc1 = scratch_path(spark, "t-fc1-src")
    write_features(score(spark.read.parquet(feature_root), chain.upto("fc1"), features="features",
                         output="features"), fc1)
    for layout in ("float", "double", "packed"):
        out = scratch_path(spark, f"t-layout-{layout}")
        P.featurize_features(spark, fc1, out, chain, "fc2", layout=layout)
        types[layout] = spark.read.parquet(out).schema["features"].dataType.simpleString()
    assert types == {"float": "array<float>", "double": "array<double>", "packed": "binary"}
    with pytest.raises(ValueError, match="layout"):
        P.featurize_features(spark, fc1, scratch_path(spark, "t-x"), chain, "fc2", layout="half")
