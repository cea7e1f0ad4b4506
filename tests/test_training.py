import numpy as np
import pytest
from pyspark.sql import functions as F

from headstart.model import dense, head, init_params
from headstart.operators import training as TR
from headstart.operators.ordering import assign_minibatches, with_position
from headstart.operators.training import FitParams, fit, init_state, train_batches

ZERO = dict(updater="sgd", rate=1.0, eval_interval=1 << 30)


def _zero_model():
    return init_params([dense("out", 64, 10, "softmax")], scheme="zeros")


def _fit(emb, model, **kw):
    return fit(emb, model, FitParams(**kw), id_col="vec_id", features="embedding", label="label")


def test_workers_average_equals_big_batch(emb):
    a = _fit(emb, _zero_model(), epochs=2, workers=4, batch_size=25, avg_freq=1, **ZERO)
    b = _fit(emb, _zero_model(), epochs=2, workers=1, batch_size=100, avg_freq=1, **ZERO)
    for k in a.model.keys():
        assert np.abs(a.model.params[k] - b.model.params[k]).max() < 1e-12
    assert a.iterations == b.iterations == 2 * 5


def test_one_worker_equals_local_loop(emb):
    p = FitParams(epochs=1, workers=1, batch_size=100, avg_freq=1, **ZERO)
    res = fit(emb, _zero_model(), p, id_col="vec_id", features="embedding")
    rows = assign_minibatches(with_position(emb, "vec_id", 42), 1, 100, 1).orderBy("pos").collect()
    m, st = _zero_model(), {}
    for r0 in range(0, len(rows), 100):
        chunk = rows[r0:r0 + 100]
        x = np.array([r.embedding for r in chunk], dtype=np.float64)
        y = np.array([r.label for r in chunk])
        ids = np.array([r.vec_id for r in chunk])
        m, st, _, _ = train_batches(m, st, [(ids, x, y)], p, r0 // 100, 0)
    for k in m.keys():
        assert np.array_equal(m.params[k], res.model.params[k])


@pytest.mark.parametrize("updater", ["nesterovs", "adam", "adadelta", "rmsprop", "SGD"])
def test_updaters_reduce_loss(emb, updater):
    m = init_params(head("predictions", 64, 10), seed=3)
    rate = 1.0 if updater == "adadelta" else 0.05
    res = fit(emb, m, FitParams(epochs=2, workers=2, batch_size=25, avg_freq=2, rate=rate, updater=updater,
                                eval_interval=1), id_col="vec_id", features="embedding")
    h = res.history
    assert len(h) == 2 and h.loss.iloc[1] < 2.5 and np.isfinite(h.loss).all()


def test_params_are_checked_before_jobs():
    with pytest.raises(ValueError, match="unknown updater"):
        FitParams(updater="lbfgs")
    with pytest.raises(ValueError):
        FitParams(workers=0)
    with pytest.raises(ValueError):
        FitParams(schedule={-1: 0.1})
    with pytest.raises(ValueError):
        FitParams(rate=0)


def test_dropout_and_warm_start_are_reproducible(spark, emb):
    m = init_params(head("fc2", 64, 10, keep_prob=0.8), seed=42)
    p = FitParams(epochs=1, workers=2, batch_size=16, avg_freq=2, rate=0.05, eval_interval=1)
    a = fit(emb, m, p, id_col="vec_id", features="embedding")
    b = fit(emb, m, p, id_col="vec_id", features="embedding")
    for k in a.model.keys():
        assert np.array_equal(a.model.params[k], b.model.params[k])
    # warm start continues the iteration count and keeps optimizer state
    c = fit(emb, a.model, p.replace(schedule={0: 0.1, 20: 0.01}), id_col="vec_id", features="embedding",
            state=a.state, iterations=a.iterations)
    assert c.iterations == 2 * a.iterations
    assert sorted(c.state) == sorted(init_state(a.model, "nesterovs"))


def test_keep_prob_override(emb):
    m = init_params(head("fc2", 64, 10, keep_prob=1.0), seed=42)
    r1 = _fit(emb, m, epochs=1, workers=2, batch_size=50, avg_freq=1, rate=0.1, eval_interval=1 << 30)
    r2 = _fit(emb, m, epochs=1, workers=2, batch_size=50, avg_freq=1, rate=0.1, eval_interval=1 << 30,
              keep_prob=0.5)
    assert r2.model.layers[0].keep_prob == 0.5
    assert not np.array_equal(r1.model.params["predictions/W"], r2.model.params["predictions/W"])


def test_chunked_average_is_bit_equal_on_reruns(emb, monkeypatch):

    m = init_params(head("fc2", 64, 10, keep_prob=0.9), seed=42)
    p = FitParams(epochs=1, workers=3, batch_size=16, avg_freq=2, rate=0.05, updater="adam",
                  eval_interval=1 << 30)
    a = fit(emb, m, p, id_col="vec_id", features="embedding")
    monkeypatch.setattr(TR, "CHUNK", 100)                 # several chunks per vector
    b = fit(emb.repartition(5), m, p, id_col="vec_id", features="embedding")
    assert a.iterations == b.iterations == a.updater_steps
    for k in m.keys():
        assert np.array_equal(a.model.params[k], b.model.params[k])
    for k in a.state:
        assert np.array_equal(a.state[k], b.state[k])


def test_layout_blocks(emb):
    """Each worker alone in a partition of a block; blocks hold consecutive rounds and all rows."""
    from pyspark.sql import functions as F

    from headstart.operators.training import prepare_layout

    p = FitParams(workers=5, batch_size=8, avg_freq=3)
    layout = prepare_layout(emb, p, id_col="vec_id", features="embedding", label="label", rounds_per_block=2)
    assert layout.rounds == -(-emb.count() // (5 * 8 * 3)) and layout.blocks == -(-layout.rounds // 2)
    seen = 0
    for b in range(layout.blocks):
        block = layout.block(b, 5, 24)
        per = (block.groupBy(F.spark_partition_id().alias("part"))
               .agg(F.countDistinct("worker").alias("w"), F.min("worker").alias("worker")).collect())
        assert all(r.w == 1 for r in per) and len({r.worker for r in per}) == len(per)
        assert {r["round"] for r in block.select("round").distinct().collect()} <= {2 * b, 2 * b + 1}
        seen += block.count()
        block.unpersist()
    assert seen == emb.count()
    layout.release()


def test_jobs_and_reads_of_an_epoch_follow_the_rows(spark, emb, monkeypatch):
    monkeypatch.setattr(TR, "BARRIER_BYTES", 0)  # a job per round

    calls = {"block": 0, "rows": 0, "round": 0}
    block, run = TR.Layout.block, TR.run_round

    def counted_block(self, *a):
        out = block(self, *a)
        calls["block"] += 1
        calls["rows"] += out.count()
        return out

    def counted_round(*a, **kw):
        calls["round"] += 1
        return run(*a, **kw)

    monkeypatch.setattr(TR.Layout, "block", counted_block)
    monkeypatch.setattr(TR, "run_round", counted_round)
    m, p = _zero_model(), FitParams(epochs=2, workers=2, batch_size=5, avg_freq=2, **ZERO)
    got = []
    for n in (100, 200, 400):
        calls.update(block=0, rows=0, round=0)
        layout = TR.prepare_layout(emb.filter(f"vec_id < {n}"), p, id_col="vec_id", features="embedding", rounds_per_block=2)
        fit(emb, m, p, id_col="vec_id", features="embedding", layout=layout)
        layout.release()
        got.append((calls["block"], calls["rows"], calls["round"]))
    assert [g[1] for g in got] == [200, 400, 800]  # two epochs read every row twice
    assert [g[2] for g in got] == [10, 20, 40]
    assert got[2][0] == 2 * -(-20 // 2) and got[0][0] == 2 * -(-5 // 2)


def test_one_block_is_read_once_for_all_epochs(emb, monkeypatch):
    monkeypatch.setattr(TR, "BARRIER_BYTES", 0)  # a job per round

    n, block = [0], TR.Layout.block
    monkeypatch.setattr(TR.Layout, "block", lambda self, *a: (n.__setitem__(0, n[0] + 1), block(self, *a))[1])
    _fit(emb, _zero_model(), epochs=3, workers=2, batch_size=50, avg_freq=1, **ZERO)
    assert n == [1]


def test_full_batch_round_equals_one_step_on_all_rows(spark, emb):
    from pyspark.sql import functions as F

    from headstart.operators.training import full_batch_round

    m = init_params([dense("h", 64, 8, "relu"), dense("out", 8, 10, "softmax")], seed=1)
    rows = emb.collect()
    for updater in ("sgd", "adam"):
        p = FitParams(rate=0.1, updater=updater, l2=0.01)
        df = emb.withColumn("worker", (F.col("vec_id") % 3).cast("int"))
        got, state, loss = full_batch_round(df.repartition(7), m, init_state(m, updater), p, features="embedding", label="label")
        again, _, _ = full_batch_round(df.repartition(7), m, init_state(m, updater), p, features="embedding", label="label")
        steps, losses = [], []
        for w in range(3):
            mine = [r for r in rows if r.vec_id % 3 == w]
            one = (np.arange(len(mine)), np.array([r.embedding for r in mine], float), np.array([r.label for r in mine]))
            out = train_batches(m, init_state(m, updater), [one], p, 0, 0)
            steps.append(out[0].params)
            losses.append(out[3])
        for k in m.keys():
            assert np.abs(got.params[k] - np.mean([s[k] for s in steps], axis=0)).max() < 1e-12
            assert np.array_equal(got.params[k], again.params[k])
        assert abs(loss - np.mean(losses)) < 1e-12
    with pytest.raises(ValueError, match="one batch-norm layer"):
        full_batch_round(df, init_params(head("fc1", 64, 10)), {}, p, features="embedding", label="label")


@pytest.mark.parametrize("updater", ["sgd", "nesterovs", "adam", "adadelta", "rmsprop"])
def test_update_rules_against_hand_formulas(updater):
    """Three steps on one weight and one bias, by the rules as published."""
    from headstart.operators.training import apply_update

    p = FitParams(updater=updater, rate=0.1, momentum=0.9, l2=0.5)
    params = {"l/W": np.array([[2.0]]), "l/b": np.array([1.0])}
    shape = init_params([dense("l", 1, 1, "softmax")], scheme="zeros")
    state = init_state(shape, updater)
    w = {"l/W": [2.0, 0.0, 0.0], "l/b": [1.0, 0.0, 0.0]}  # value and two slots
    for t, grads in enumerate([(1.0, -2.0), (0.5, 0.25), (-3.0, 1.0)]):
        apply_update(params, {"l/W": np.array([[grads[0]]]), "l/b": np.array([grads[1]])}, state, p, 0.1, t)
        for key, g in zip(("l/W", "l/b"), grads):
            x, a, b = w[key]
            g = g + 0.5 * x if key == "l/W" else g
            if updater == "sgd":
                x -= 0.1 * g
            elif updater == "nesterovs":
                v = 0.9 * a - 0.1 * g
                x, a = x - 0.9 * a + 1.9 * v, v
            elif updater == "adam":
                a, b = 0.9 * a + 0.1 * g, 0.999 * b + 0.001 * g * g
                x -= 0.1 * (a / (1 - 0.9 ** (t + 1))) / ((b / (1 - 0.999 ** (t + 1))) ** 0.5 + 1e-8)
            elif updater == "rmsprop":
                a = 0.95 * a + 0.05 * g * g
                x -= 0.1 * g / (a + 1e-8) ** 0.5
            else:
                a = 0.95 * a + 0.05 * g * g
                d = -((b + 1e-6) ** 0.5) / (a + 1e-6) ** 0.5 * g
                x, b = x + d, 0.95 * b + 0.05 * d * d
            w[key] = [x, a, b]
            assert abs(params[key].item() - x) < 1e-12, (updater, key, t)


def test_another_updater_starts_from_fresh_state(spark, emb):
    from headstart.operators.training import UPDATERS, prepare_layout
    from headstart.sources.models import read_model, write_model
    from headstart.session import scratch_path

    m = init_params(head("predictions", 64, 10), seed=3)
    p = FitParams(epochs=1, workers=2, batch_size=50, avg_freq=5, rate=0.01, eval_interval=1 << 30)
    layout = prepare_layout(emb, p, id_col="vec_id", features="embedding")
    run = lambda model, u, **kw: fit(emb, model, p.replace(updater=u), id_col="vec_id", features="embedding", layout=layout, **kw)
    for first in UPDATERS:
        a = run(m, first)
        path = scratch_path(spark, "t-warm")
        write_model(spark, a.model, path, state=a.state, meta=a.meta())
        model, state, meta = read_model(spark, path)
        for second in UPDATERS:
            warm = run(model, second, state=state, iterations=int(meta["iterations"]), updater_steps=int(meta["updater_steps"]))
            assert warm.iterations == a.iterations * 2
            if second == "sgd":  # has no state
                continue
            cold = run(model, second)
            same = all(np.array_equal(warm.model.params[k], cold.model.params[k]) for k in model.keys())
            assert same == (second != first), (first, second)
            assert warm.updater_steps == cold.iterations + (a.updater_steps if second == first else 0)
    layout.release()


def test_interval_counts_epochs_of_the_run_and_history_is_appended(spark, emb):
    from headstart.session import scratch_path

    path = scratch_path(spark, "t-hist")
    p = FitParams(epochs=3, workers=2, batch_size=100, avg_freq=1, rate=0.01, eval_interval=2)
    res = fit(emb, _zero_model(), p, id_col="vec_id", features="embedding", start_epoch=5, history_path=path)
    assert res.history.epoch.tolist() == [6]
    fit(emb, _zero_model(), p.replace(eval_interval=1), id_col="vec_id", features="embedding", history_path=path)
    assert sorted(r.epoch for r in spark.read.parquet(path).collect()) == [0, 1, 2, 6]


def test_shared_layout_gives_the_same_fit(emb):
    from headstart.operators.training import prepare_layout

    m = init_params(head("predictions", 64, 10), seed=3)
    p = FitParams(epochs=1, workers=2, batch_size=16, avg_freq=2, rate=0.05, updater="rmsprop",
                  eval_interval=1 << 30)
    layout = prepare_layout(emb, p, id_col="vec_id", features="embedding")
    a = fit(emb, m, p, id_col="vec_id", features="embedding", layout=layout)
    b = fit(emb, m, p, id_col="vec_id", features="embedding")
    for k in m.keys():
        assert np.array_equal(a.model.params[k], b.model.params[k])
    with pytest.raises(ValueError, match="layout was prepared"):
        fit(emb, m, p.replace(workers=3), id_col="vec_id", features="embedding", layout=layout)
    layout.release()


def test_distributed_fit_equals_brute_force_schedule(emb):
    """Whole schedule without Spark: same rows, rounds and workers, every worker's steps,
    then the mean of parameters and optimizer state — compared with the distributed fit."""
    from headstart.operators.training import flatten, unflatten

    m = init_params(head("fc2", 64, 10, keep_prob=0.8), seed=11)
    p = FitParams(epochs=2, workers=4, batch_size=8, avg_freq=3, rate=0.02, momentum=0.9, l2=0.01,
                  updater="nesterovs", eval_interval=1 << 30, seed=5)
    res = fit(emb, m, p, id_col="vec_id", features="embedding")

    rows = assign_minibatches(with_position(emb, "vec_id", p.seed), p.workers, p.batch_size,
                              p.avg_freq).orderBy("pos").collect()
    model, state, it = m, init_state(m, p.updater), 0
    n_rounds = max(r["round"] for r in rows) + 1
    for epoch in range(p.epochs):
        for rnd in range(n_rounds):
            vecs, steps = [], 0
            for w in range(p.workers):
                mine = [r for r in rows if r["round"] == rnd and r["worker"] == w]
                if not mine:
                    continue
                batches = []
                for b in sorted({r["batch"] for r in mine}):
                    sel = [r for r in mine if r["batch"] == b]
                    batches.append((np.array([r.vec_id for r in sel]),
                                    np.array([r.embedding for r in sel], dtype=np.float64),
                                    np.array([r.label for r in sel])))
                new_m, new_s, k, _ = train_batches(model, state, batches, p, it, epoch)
                vecs.append(flatten(new_m, new_s))
                steps = max(steps, k)
            model, state = unflatten(model, state, np.mean(np.stack(vecs), axis=0))
            it += steps
    assert res.iterations == it
    for k in m.keys():
        assert np.abs(res.model.params[k] - model.params[k]).max() < 1e-12, k
    for k in state:
        assert np.abs(res.state[k] - state[k]).max() < 1e-12, k


def test_snapshot_resume_equals_uninterrupted_run(spark, emb):
    from headstart.session import scratch_path
    from headstart.sources.models import read_model

    m = init_params(head("fc2", 64, 10, keep_prob=0.8), seed=9)  # dropout: masks keyed by epoch
    p = FitParams(epochs=2, workers=2, batch_size=16, avg_freq=2, rate=0.05, updater="adam",
                  eval_interval=1 << 30)
    full = fit(emb, m, p, id_col="vec_id", features="embedding")
    snap = scratch_path(spark, "t-snap")
    fit(emb, m, p.replace(epochs=1), id_col="vec_id", features="embedding", snapshot_path=snap)
    model, state, meta = read_model(spark, snap)
    assert meta["epoch"] == 0
    # resume the second epoch from the snapshot
    rest = fit(emb, model, p.replace(epochs=1), id_col="vec_id", features="embedding", state=state,
               iterations=int(meta["iterations"]), start_epoch=int(meta["epoch"]) + 1)
    assert rest.iterations == full.iterations
    for k in m.keys():
        assert np.abs(rest.model.params[k] - full.model.params[k]).max() < 1e-12


def test_snapshot_survives_a_broken_write(spark, emb, tmp_path):
    from headstart.sources.models import read_model, snapshots

    snap = str(tmp_path / "snap")
    m = _zero_model()
    fit(emb, m, FitParams(epochs=3, workers=2, batch_size=100, avg_freq=1, **ZERO), id_col="vec_id", features="embedding",
        snapshot_path=snap)
    assert snapshots(spark, snap) == [1, 2]  # the last two stay
    (tmp_path / "snap" / "epoch=3").mkdir()  # a write that never finished
    (tmp_path / "snap" / "epoch=3" / "part-0.parquet").write_bytes(b"broken")
    assert read_model(spark, snap)[2]["epoch"] == 2


def test_null_elements_are_refused(spark, emb):
    from pyspark.sql import functions as F

    bad = emb.withColumn("embedding", F.when(F.col("vec_id") == 7, F.transform("embedding", lambda x, i: F.when(i != 3, x)))
                         .otherwise(F.col("embedding")))
    with pytest.raises(Exception, match="null element"):
        _fit(bad, _zero_model(), epochs=1, workers=2, batch_size=100, avg_freq=1, **ZERO)


def test_fit_survives_losing_the_cached_block(emb, monkeypatch):
    """Executors lost: rounds then read the block from the layout again and give the same model."""
    monkeypatch.setattr(TR, "BARRIER_BYTES", 0)  # a job per round

    m = init_params(head("fc2", 64, 10, keep_prob=0.8), seed=4)
    p = FitParams(epochs=1, workers=3, batch_size=16, avg_freq=2, rate=0.05, eval_interval=1 << 30)
    ref = fit(emb, m, p, id_col="vec_id", features="embedding")
    block = TR.Layout.block

    def lost(self, *a):
        out = block(self, *a)
        out.unpersist(blocking=True)  # as if every executor holding the cache were lost
        return out

    monkeypatch.setattr(TR.Layout, "block", lost)
    res = fit(emb, m, p, id_col="vec_id", features="embedding")
    for k in m.keys():
        assert np.array_equal(res.model.params[k], ref.model.params[k])


def test_barrier_blocks_equal_rounds_bit_for_bit(spark, emb, monkeypatch):
    """Several blocks, several epochs of one block, dropout and batch-norm, a short last round, every updater's state."""
    for rounds_per_block, updater in ((2, "adam"), (32, "nesterovs")):
        p = FitParams(epochs=3, workers=3, batch_size=16, avg_freq=3, rate=0.05, updater=updater, l2=0.01, eval_interval=2,
                      schedule={0: 0.05, 7: 0.01})
        model = init_params(head("fc2", 64, 10, keep_prob=0.9), seed=1)
        layout = TR.prepare_layout(emb, p, id_col="vec_id", features="embedding", rounds_per_block=rounds_per_block)
        got = {}
        for together in (True, False):
            jobs = []
            run = TR.run_block
            monkeypatch.setattr(TR, "run_block", lambda *a, **k: (jobs.append(1), run(*a, **k))[1])
            monkeypatch.setattr(TR, "BARRIER_BYTES", (16 << 20) * together)
            got[together] = fit(emb, model, p, id_col="vec_id", features="embedding", layout=layout)
            assert len(jobs) == together * (3 * layout.blocks if layout.blocks > 1 else 2)
            monkeypatch.setattr(TR, "run_block", run)
        layout.release()
        a, b = got[True], got[False]
        assert a.iterations == b.iterations and a.updater_steps == b.updater_steps
        assert TR.flatten(a.model, a.state).tobytes() == TR.flatten(b.model, b.state).tobytes()
        assert a.history.equals(b.history)


def test_more_workers_than_slots_average_by_rounds(spark, emb, monkeypatch):
    monkeypatch.setattr(TR, "barrier_slots", lambda s: 3)
    monkeypatch.setattr(TR, "run_block", lambda *a, **k: pytest.fail("no slots for a barrier stage"))
    p = FitParams(epochs=1, workers=4, batch_size=32, avg_freq=4, updater="sgd")
    assert fit(emb, init_params(head("predictions", 64, 10)), p, id_col="vec_id", features="embedding").iterations > 0


def test_a_failing_barrier_task_fails_the_fit(spark, emb):
    bad = emb.withColumn("label", F.when(F.col("vec_id") == 7, F.lit(None).cast("int")).otherwise(F.col("label")))
    with pytest.raises(Exception, match="null in column label"):
        fit(bad, init_params(head("predictions", 64, 10)), FitParams(workers=2), id_col="vec_id", features="embedding")


def test_full_batch_round_with_batch_norm_and_dropout_equals_one_big_batch(spark, emb):
    """Moments and gradients merged over tasks give what one worker gets from all its rows at once."""
    rows = emb.collect()
    ids, x, y = (np.array([r[c] for r in rows]) for c in ("vec_id", "embedding", "label"))
    x = x.astype(np.float64) * 3 + 100  # far from 0: sums of squares alone would lose digits
    for layers in (head("fc2", 64, 10, keep_prob=0.7), head("predictions", 64, 10), [dense("layer0", 64, 10, "softmax")]):
        m, p = init_params(layers, seed=3), FitParams(rate=0.1, updater="adam", l2=0.01, seed=9)
        df = spark.createDataFrame([(int(i), v.tolist(), int(c), int(i) % 3) for i, v, c in zip(ids, x, y)],
                                   "vec_id long, embedding array<double>, label int, worker int").repartition(7)
        got, state, _ = TR.full_batch_round(df, m, init_state(m, "adam"), p, features="embedding", label="label", id_col="vec_id", epoch=2)
        want = [TR.flatten(*train_batches(m, init_state(m, "adam"), [(ids[k], x[k], y[k])], p, 0, 2)[:2]) for k in (ids % 3 == w for w in range(3))]
        assert np.allclose(TR.flatten(got, state), np.mean(want, axis=0), rtol=1e-9, atol=1e-9)
    deep = init_params(head("fc1", 64, 10, keep_prob=0.7), seed=3)
    with pytest.raises(ValueError, match="one batch-norm layer"):
        TR.full_batch_round(df, deep, init_state(deep, "sgd"), p, features="embedding", label="label", id_col="vec_id")
    fc2 = init_params(head("fc2", 64, 10, keep_prob=0.7), seed=3)
    with pytest.raises(ValueError, match="id_col"):
        TR.full_batch_round(df, fc2, init_state(fc2, "sgd"), p, features="embedding", label="label")


def test_merged_moments_of_uneven_parts():
    rng = np.random.default_rng(2)
    parts = [rng.normal(1e6, 1, (n, 4)) for n in (1, 2, 50, 7)]
    n, mean, squares = TR.merged_moments([(len(v), v.mean(0), ((v - v.mean(0)) ** 2).sum(0)) for v in parts])
    whole = np.concatenate(parts)
    assert n == 60 and np.allclose(mean, whole.mean(0), rtol=1e-12) and np.allclose(squares / n, whole.var(0), rtol=1e-6)


def test_a_resumed_run_leaves_one_history_row_for_each_key(spark, emb):
    """Killed after the evaluation of epoch 2, resumed from the snapshot of epoch 0: epochs 1 and 2 run again."""
    from headstart.session import scratch_path
    from headstart.sources.models import read_model

    history, snaps = scratch_path(spark, "t-hist-resume"), scratch_path(spark, "t-snap-resume")
    p = FitParams(epochs=3, workers=2, batch_size=50, avg_freq=2, rate=0.01, eval_interval=1)
    m = init_params(head("predictions", 64, 10), seed=4)
    kw = {"id_col": "vec_id", "features": "embedding", "valid": emb.filter("vec_id < 50"), "history_path": history}
    fit(emb, m, p.replace(epochs=1), snapshot_path=snaps, **kw)
    whole = fit(emb, m, p, **kw)
    model, state, meta = read_model(spark, snaps)
    fit(emb, model, p.replace(epochs=2), state=state, iterations=int(meta["iterations"]), updater_steps=int(meta["updater_steps"]),
        start_epoch=int(meta["epoch"]) + 1, **kw)
    got = sorted((r.epoch, r.split, r.loss) for r in TR.read_history(spark, history).collect())
    want = sorted((r.epoch, r.split, r.loss) for r in whole.history.itertuples())
    assert [g[:2] for g in got] == [w[:2] for w in want] == [(e, s) for e in range(3) for s in ("train", "valid")]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-9)
    assert spark.read.parquet(history).filter("_epoch = 1").count() == 2


def test_rounds_of_little_work_wait_for_no_barrier(spark, emb, monkeypatch):
    """In turn in one task, by barrier and by a job a round: the same bits, with a barrier only for long rounds."""
    p = FitParams(epochs=2, workers=3, batch_size=16, avg_freq=3, rate=0.05, updater="adam", l2=0.01, eval_interval=2)
    model = init_params(head("fc2", 64, 10, keep_prob=0.9), seed=1)
    layout = TR.prepare_layout(emb, p, id_col="vec_id", features="embedding", rounds_per_block=2)
    barriers, run = [], TR._run_rounds
    monkeypatch.setattr(TR, "_run_rounds", lambda *a, **k: (barriers.append(a[7]), run(*a, **k))[1])
    got = []
    for turn_seconds, slots, barrier in ((1.0, 4, {False}), (1.0, 0, {False}), (-1.0, 4, {True}), (-1.0, 0, set())):
        barriers.clear()
        monkeypatch.setattr(TR, "TURN_SECONDS", turn_seconds)
        monkeypatch.setattr(TR, "barrier_slots", lambda s, n=slots: n)
        res = fit(emb, model, p, id_col="vec_id", features="embedding", layout=layout)
        assert set(barriers) == barrier
        got.append((res.iterations, TR.flatten(res.model, res.state).tobytes()))
    layout.release()
    assert got[0] == got[1] == got[2] == got[3]
    wide = init_params(head("fc2", 4096, 1000), seed=1)
    assert TR.turn_seconds(model, p) < 0.1 and TR.turn_seconds(wide, p.replace(batch_size=256, avg_freq=10)) > 1


def test_narrow_rows_go_into_blocks_of_more_rounds(emb, monkeypatch):
    monkeypatch.setattr(TR, "ROUNDS_PER_BLOCK", 2)
    p = FitParams(workers=2, batch_size=5, avg_freq=2)
    for width, per_block in ((None, 2), (64, 7), (4096, 2)):
        monkeypatch.setattr(TR, "BLOCK_BYTES", 7 * 20 * 64 * 8)
        layout = TR.prepare_layout(emb, p, id_col="vec_id", features="embedding", width=width)
        assert layout.per_block == per_block and layout.rounds == 25
        assert [r for b in range(layout.blocks) for r in layout.rounds_of(b)] == list(range(25))
        assert sum(layout.read(b).count() for b in range(layout.blocks)) == 500
        layout.release()


def test_a_sweep_gives_what_each_fit_gives(spark, emb):
    p = FitParams(epochs=1, workers=2, batch_size=50, avg_freq=2, rate=0.01, eval_interval=1)
    layout = TR.prepare_layout(emb, p, id_col="vec_id", features="embedding", width=64)
    runs = [lambda u=u: fit(emb, _zero_model(), p.replace(updater=u), id_col="vec_id", features="embedding", layout=layout,
                            valid=emb.filter("vec_id < 50")) for u in ("sgd", "adam")]
    for a, b in zip(TR.fit_all(spark, runs), [run() for run in runs]):
        assert TR.flatten(a.model, a.state).tobytes() == TR.flatten(b.model, b.state).tobytes()
        assert np.allclose(a.history.loss, b.history.loss, rtol=1e-12) and len(a.history) == 2
    layout.release()
