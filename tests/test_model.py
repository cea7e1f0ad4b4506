import numpy as np
import pytest

from headstart.model import (Model, batchnorm, dense, dropout, forward, head, init_params, initial_preset,
                             loss_and_grads)
from headstart.plans import fixtures as FX
from headstart.sources.models import model_to_df, read_model, write_model
from headstart.session import scratch_path


def test_upto_after_compose_to_full():
    chain = FX.two_stage()
    x = np.random.default_rng(0).normal(size=(7, 64))
    full = forward(chain, x)
    staged = forward(chain.after("fc1"), forward(chain.upto("fc1"), x))
    assert np.allclose(full, staged, atol=0, rtol=0)
    with pytest.raises(ValueError):
        chain.upto("nope")
    with pytest.raises(ValueError):
        chain.after("predictions")


def test_width_mismatch_is_refused():
    with pytest.raises(ValueError, match="width mismatch"):
        init_params([dense("a", 4, 3), dense("b", 2, 2)])


def test_heads_by_input_layer():
    assert [l.kind for l in head("FC2", 64, 10)] == ["dropout", "batchnorm", "dense"]
    assert [l.kind for l in head("predictions", 64, 10)] == ["batchnorm", "dense"]
    assert len(head("fc1", 64, 10, hidden=16)) == 6
    with pytest.raises(ValueError, match="not supported"):
        head("conv5", 64, 10)
    pre = initial_preset("fc2", 64, 10)
    assert len(pre.layers) == 1 and pre.rate == 0.001 and pre.momentum == 0.98
    with pytest.raises(ValueError):
        initial_preset("FC2", 64, 10)  # case-sensitive preset names


def _numeric_grad(model, x, y, masks, key, eps=1e-6):
    g = np.zeros_like(model.params[key])
    it = np.nditer(g, flags=["multi_index"])
    for _ in it:
        i = it.multi_index
        p = {k: v.copy() for k, v in model.params.items()}
        p[key][i] += eps
        lp = loss_and_grads(Model(model.layers, p), x, y, masks)[0]
        p[key][i] -= 2 * eps
        lm = loss_and_grads(Model(model.layers, p), x, y, masks)[0]
        g[i] = (lp - lm) / (2 * eps)
    return g


def test_backward_matches_finite_differences():
    layers = [dropout("d0", 5, 0.8), batchnorm("bn0", 5), dense("h", 5, 4, "relu"), batchnorm("bn1", 4),
              dense("out", 4, 3, "softmax")]
    m = init_params(layers, seed=1)
    m.params["bn0/gamma"] = np.linspace(0.5, 1.5, 5)
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(6, 5)), rng.integers(0, 3, size=6)
    masks = {"d0": rng.random((6, 5)) < 0.8}
    _, grads, _ = loss_and_grads(m, x, y, masks)
    for key in ("out/W", "out/b", "h/W", "bn0/gamma", "bn1/beta"):
        assert np.allclose(grads[key], _numeric_grad(m, x, y, masks, key), atol=1e-6), key


def test_fixture_scores_like_oracle(spark, emb):
    from headstart.operators.evaluation import evaluate
    from headstart.operators.scoring import predict

    r = evaluate(predict(emb, FX.one_layer(), features="embedding", keep=["label"])).first()
    assert round(r.accuracy * r.n) == 39 and r.loss == pytest.approx(2.316543, abs=1e-6)


def test_model_table_roundtrip(spark):
    from headstart.operators.training import init_state

    m = init_params(head("fc1", 8, 3, keep_prob=0.9, hidden=5), seed=5)
    st = init_state(m, "adam")
    st = {k: v + 0.25 for k, v in st.items()}
    path = scratch_path(spark, "t-model")
    write_model(spark, m, path, state=st, meta={"iterations": 12})
    back, st2, meta = read_model(spark, path)
    assert [l for l in back.layers] == [l for l in m.layers]
    assert all(np.array_equal(back.params[k], m.params[k]) for k in m.keys())
    assert sorted(st2) == sorted(st) and all(np.array_equal(st2[k], st[k]) for k in st)
    assert meta == {"iterations": 12.0}
    with pytest.raises(Exception):
        write_model(spark, m, path)  # default mode refuses to overwrite
    assert model_to_df(spark, m).filter("param = 'W'").count() == 8 + 5  # one row per input index
