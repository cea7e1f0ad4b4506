import pytest

from headstart.operators import evaluation as E


def test_confusion_metrics_fixture(spark):
    conf = spark.createDataFrame([(0, 0, 3), (0, 1, 1), (1, 1, 2), (2, 0, 1)], "label int, pred int, n bigint")
    assert E.accuracy(conf).first().accuracy == pytest.approx(5 / 7)
    m = E.macro_precision_recall(conf).first()
    assert m.precision == pytest.approx(0.708333, abs=1e-6)
    assert m.recall == pytest.approx(0.583333, abs=1e-6)
    s = E.summarize(conf).first()
    assert s.n == 7 and s.loss is None
    stats = {r.cls: r for r in E.per_class_stats(conf).collect()}
    assert stats[2].precision is None and stats[2].recall == 0.0


def test_evaluate_single_pass_matches_parts(spark):
    scored = spark.createDataFrame([(0, 0, 0.1), (0, 1, 2.0), (1, 1, 0.5), (2, 0, 1.5)],
                                   "label int, pred int, nll double")
    r = E.evaluate(scored).first()
    assert r.n == 4 and r.accuracy == pytest.approx(0.5)
    assert r.loss == pytest.approx((0.1 + 2.0 + 0.5 + 1.5) / 4)
    assert E.mean_loss(scored).first().loss == pytest.approx(r.loss)


def test_evaluate_empty_table(spark):
    empty = spark.createDataFrame([], "label int, pred int, nll double")
    r = E.evaluate(empty).first()
    assert r.n == 0 and r.accuracy is None and r.loss is None


def test_split_evaluation_in_one_pass_equals_separate(spark, emb):
    from pyspark.sql import functions as F

    from headstart.operators.scoring import predict
    from headstart.operators.training import evaluate_splits
    from headstart.plans import fixtures as FX

    a, b = emb.filter(F.col("vec_id") % 2 == 0), emb.filter(F.col("vec_id") % 2 == 1)
    both = evaluate_splits({"a": a, "b": b, "none": None}, FX.one_layer(), features="embedding", label="label")
    assert set(both) == {"a", "b"}
    for name, d in (("a", a), ("b", b)):
        one = E.evaluate(predict(d, FX.one_layer(), features="embedding", keep=["label"])).first().asDict()
        for k in ("n", "accuracy", "precision", "recall", "loss"):
            assert both[name][k] == pytest.approx(one[k], abs=1e-12), (name, k)
