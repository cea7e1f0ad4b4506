"""Plan shapes that the scale design relies on (checked with explain())."""

import contextlib
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from headstart.operators import evaluation as E
from headstart.operators.scoring import predict
from headstart.operators.training import FitParams, prepare_layout
from headstart.plans import fixtures as FX
from headstart.model import head, init_params
from headstart.sources.features import read_features
from headstart.sources.models import read_model, scan_layers, write_model

from .conftest import SF01


def _plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_filter_and_projection_reach_the_scan(spark):
    df = read_features(spark, f"{SF01}/embeddings.parquet", features="embedding", columns=["vec_id"])
    plan = _plan(df.filter(F.col("label") == 3).select("vec_id"))
    assert "PushedFilters: [IsNotNull(label), EqualTo(label,3)]" in plan
    assert "ReadSchema: struct<vec_id:bigint,label:int>" in plan


def test_scoring_is_a_narrow_map(spark, emb):
    plan = _plan(predict(emb, FX.one_layer(), features="embedding", keep=["vec_id"]))
    assert "MapInArrow" in plan and "Exchange" not in plan


def test_evaluation_shuffles_only_aggregates(spark, emb):
    plan = _plan(E.evaluate(predict(emb, FX.one_layer(), features="embedding", keep=["label"])))
    # partial aggregation before each exchange: the data itself is never shuffled
    assert plan.count("+- Exchange") == 3 and plan.count("partial_") >= 3
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_training_round_has_no_exchange(spark, emb):
    layout = prepare_layout(emb, FitParams(workers=2, batch_size=8, avg_freq=2), id_col="vec_id",
                            features="embedding", label="label")
    block = layout.block(0, 2, 16)
    part = block.filter(F.col("round") == 1)
    plan = _plan(part.mapInArrow(lambda it: it, part.schema), "simple").split("InMemoryRelation")[0]
    assert "Exchange" not in plan and "InMemoryTableScan" in plan and "(round#" in plan
    block.unpersist()
    layout.release()


def test_layer_filter_reaches_the_model_scan(spark, tmp_path):
    model = init_params(head("fc1", 6, 3), seed=1)
    path = str(tmp_path / "model")
    write_model(spark, model, path, state={f"{model.layers[-1].name}/W@adam.m": np.ones((6, 3))}, meta={"iterations": 7})
    names = model.layer_names
    plan = _plan(scan_layers(spark, path, after=names[0]))
    assert "PushedFilters: [Or(LessThan(layer,0),And(GreaterThanOrEqual(layer,1),LessThanOrEqual(layer," in plan
    for kw, want in (({"after": names[0]}, model.after(names[0])), ({"upto": names[0]}, model.upto(names[0])),
                     ({"after": names[0], "upto": names[1]}, model.after(names[0]).upto(names[1]))):
        got, state, meta = read_model(spark, path, **kw)
        assert got.layers == want.layers and got.params.keys() == want.params.keys() and meta == {"iterations": 7}
        assert all(np.array_equal(got.params[k], want.params[k]) for k in want.params)
        assert set(state) == ({f"{names[-1]}/W@adam.m"} if names[-1] in got.layer_names else set())
    for kw in ({"after": names[-1]}, {"upto": "nope"}, {"after": names[1], "upto": names[0]}):
        with pytest.raises(ValueError, match="no layer"):
            read_model(spark, path, **kw)
