"""Distributed training of a classifier head by parameter averaging.

Plan of one fit:

1. seeded order → dense position → ``round, worker, batch`` (T4); the positions come in sorted
   ranges, so a task holds consecutive rounds;
2. the table is written once below the checkpoint folder, partitioned by blocks of consecutive
   rounds, ``BLOCK_BYTES`` of features or ``ROUNDS_PER_BLOCK`` rounds, whichever is more: an
   epoch reads every block once, and a lost executor costs a re-read;
3. a block's size is set by the parameters, not by the data; the rounds of a block run in one job
   (``run_block``), from the model that the block before left:

   * a round takes a barrier a second or more, whatever its work (Spark looks for the answer
     once a second). Where the workers' batches of a round take less than that one after another
     (``turn_seconds``), one task takes the block and trains the workers in turn (``run_turns``);
   * else the block is dealt to its workers by one exchange, each worker alone in a partition
     of a barrier stage: a task holds its worker's rows, trains its batches of a round, and gets the
     other workers' parameter + optimizer state vectors by ``allGather``.

4. the mean of a round is added in worker order, so every task has the same bits and goes on with
   the next round. The first task emits the last mean. A lost executor costs a rerun of the
   block from the model it began with, with the same result;
   beyond ``BARRIER_BYTES`` gathered in a round, or with rounds of long work and fewer task slots than
   workers, the block is persisted and a round is a job (``run_round``: filter → ``mapInArrow`` →
   mean per chunk → broadcast), with the same bits;
5. every ``eval_interval`` epochs of the run: train rows (from the layout) and valid rows
   (persisted for the run) are scored in one pass and evaluated grouped by split; the
   metrics replace their (epoch, split) in the history table at once;
6. optionally every ``snapshot_every`` epochs: model, optimizer state and counters are
   written to a new folder, so a run can resume exactly after losing its driver.

Workers without rows in the last round are absent from the mean (equal weight per active
worker); a short last batch uses its own length. Jobs per epoch = blocks; a single block runs
up to ``EPOCHS_PER_JOB`` epochs in a job.

``full_batch_round`` is the other shape of a round: every worker takes one step on all its
rows, whose gradient sums are accumulated over Arrow batches in any number of tasks.
"""

from __future__ import annotations

import base64
import dataclasses
import math
from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext, StorageLevel, TaskContext, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.random import dropout_mask_np
from ..model import BATCHNORM, DENSE, DROPOUT, TRAINABLE, Layer, Model, loss_and_grads, pack, replace
from ..session import remove_path, scratch_path, ship_package
from . import evaluation as E
from .arrowbatch import list_matrix
from .ordering import assign_minibatches, with_position
from .schedule import rate_at
from .scoring import check_model_size, predict

UPDATERS = ("sgd", "nesterovs", "adam", "adadelta", "rmsprop")
STATE_SLOTS = {"sgd": (), "nesterovs": ("v",), "adam": ("m", "v"), "adadelta": ("g2", "dx2"),
               "rmsprop": ("g2",)}
CHUNK = 16384  # doubles per averaged row (128 KB)
ROUNDS_PER_BLOCK = 32
#: Features (as float64) that a block of more rounds than that holds at most.
BLOCK_BYTES = 64 << 20
#: Seconds of work up to which the workers of a round train in turn: what a barrier waits for a round at least.
TURN_SECONDS = 1.0
#: Bytes that the workers of a barrier stage gather at most in a round, all together: the
#: messages meet on the driver's side of the barrier. Larger models average by a job a round.
BARRIER_BYTES = 16 << 20
#: Epochs of a single block in one job at most: what a lost executor can cost.
EPOCHS_PER_JOB = 8

# Fixed optimizer constants.
ADAM_B1, ADAM_B2, ADAM_EPS = 0.9, 0.999, 1e-8
RMS_DECAY, RMS_EPS = 0.95, 1e-8
ADADELTA_RHO, ADADELTA_EPS = 0.95, 1e-6


@dataclass(frozen=True)
class FitParams:
    epochs: int = 1
    workers: int = 4
    batch_size: int = 8
    avg_freq: int = 5
    rate: float = 0.001
    schedule: dict[int, float] | None = None
    updater: str = "nesterovs"
    momentum: float = 0.9
    l2: float = 0.0
    seed: int = 42
    eval_interval: int = 4
    keep_prob: float | None = None  # overrides the dropout layers' keep probability

    def __post_init__(self):
        object.__setattr__(self, "updater", self.updater.lower())
        if self.updater not in UPDATERS:
            raise ValueError(f"unknown updater {self.updater!r}, not one of {', '.join(UPDATERS)}")
        for name in ("epochs", "workers", "batch_size", "avg_freq", "eval_interval"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        if not self.rate > 0:
            raise ValueError("rate must be > 0")
        if self.l2 < 0 or self.momentum < 0:
            raise ValueError("l2 and momentum must be >= 0")
        if self.keep_prob is not None and not 0 < self.keep_prob <= 1:
            raise ValueError("keep_prob must be in (0, 1]")
        for it, r in (self.schedule or {}).items():
            if it < 0 or not r > 0:
                raise ValueError("schedule needs iteration >= 0 and rate > 0")

    def replace(self, **kw) -> "FitParams":
        return dataclasses.replace(self, **kw)


# ---- optimizer ---------------------------------------------------------------------

def init_state(model: Model, updater: str) -> dict[str, np.ndarray]:
    """Zero state; keys name the updater, so one rule never reads another's state."""
    return {f"{k}@{updater}.{s}": np.zeros_like(model.params[k])
            for k in _trainable(model) for s in STATE_SLOTS[updater]}


def _trainable(model: Model) -> list[str]:
    return [k for k in model.keys() if k.rsplit("/", 1)[1] in TRAINABLE]


def apply_update(params: dict, grads: dict, state: dict, p: FitParams, lr: float, step: int) -> None:
    """One optimizer step in place (L2 on weight matrices only); ``step`` counts this
    updater's steps from 0."""
    for k, g in grads.items():
        if p.l2 and k.endswith("/W"):
            g = g + p.l2 * params[k]
        slot = f"{k}@{p.updater}."
        if p.updater == "sgd":
            params[k] = params[k] - lr * g
        elif p.updater == "nesterovs":
            before = state[slot + "v"]
            v = state[slot + "v"] = p.momentum * before - lr * g
            params[k] = params[k] - p.momentum * before + (1 + p.momentum) * v
        elif p.updater == "adam":
            m = state[slot + "m"] = ADAM_B1 * state[slot + "m"] + (1 - ADAM_B1) * g
            v = state[slot + "v"] = ADAM_B2 * state[slot + "v"] + (1 - ADAM_B2) * g * g
            mhat, vhat = m / (1 - ADAM_B1 ** (step + 1)), v / (1 - ADAM_B2 ** (step + 1))
            params[k] = params[k] - lr * mhat / (np.sqrt(vhat) + ADAM_EPS)
        elif p.updater == "rmsprop":
            r = state[slot + "g2"] = RMS_DECAY * state[slot + "g2"] + (1 - RMS_DECAY) * g * g
            params[k] = params[k] - lr * g / np.sqrt(r + RMS_EPS)
        else:  # adadelta
            eg = state[slot + "g2"] = ADADELTA_RHO * state[slot + "g2"] + (1 - ADADELTA_RHO) * g * g
            dx = -np.sqrt(state[slot + "dx2"] + ADADELTA_EPS) / np.sqrt(eg + ADADELTA_EPS) * g
            state[slot + "dx2"] = ADADELTA_RHO * state[slot + "dx2"] + (1 - ADADELTA_RHO) * dx * dx
            params[k] = params[k] + dx


def train_batches(model: Model, state: dict, batches, p: FitParams, it0: int, epoch: int, step0: int | None = None):
    """Sequential mini-batch steps of one worker. ``batches`` yields ``(ids, x, y)``.

    ``it0`` counts iterations (schedule), ``step0`` the updater's own steps (same by default).

    Returns the new model, state, number of steps and the summed batch loss.
    """
    step0 = it0 if step0 is None else step0
    params = {k: v.copy() for k, v in model.params.items()}
    state = {k: v.copy() for k, v in state.items()}
    steps, loss_sum = 0, 0.0
    cur = Model(model.layers, params)  # sees every change of params
    for ids, x, y in batches:
        loss, grads, running = loss_and_grads(cur, x, y, _masks(model, ids, p, epoch))
        lr = rate_at(it0 + steps, p.schedule, p.rate)
        apply_update(params, grads, state, p, lr, step0 + steps)
        params.update(running)
        steps += 1
        loss_sum += loss
    return cur, state, steps, loss_sum


def with_keep_prob(model: Model, keep_prob: float | None) -> Model:
    if keep_prob is None:
        return model
    layers = tuple(replace(l, keep_prob=keep_prob) if l.kind == DROPOUT else l for l in model.layers)
    return Model(layers, model.params)


# ---- vector layout -----------------------------------------------------------------

def state_keys(state: dict) -> list[str]:
    return sorted(state)


def flatten(model: Model, state: dict) -> np.ndarray:
    parts = [pack(model)] + [state[k].ravel() for k in state_keys(state)]
    return np.concatenate(parts) if parts else np.zeros(0)


def unflatten(model: Model, state: dict, vec: np.ndarray) -> tuple[Model, dict]:
    off, params = 0, {}
    for k in model.keys():
        a = model.params[k]
        params[k] = vec[off: off + a.size].reshape(a.shape).copy()
        off += a.size
    new_state = {}
    for k in state_keys(state):
        a = state[k]
        new_state[k] = vec[off: off + a.size].reshape(a.shape).copy()
        off += a.size
    return Model(model.layers, params), new_state


# ---- distributed round ---------------------------------------------------------------

#: A chunk of a worker's vector, packed as little-endian float64 bytes.
ROUND_OUT = "worker int, chunk int, steps int, loss_sum double, values binary"
AVERAGED = "chunk int, workers int, steps int, loss_sum double, values binary"


def _chunk_rows(worker: int, steps: int, loss_sum: float, vec: np.ndarray) -> pa.RecordBatch:
    n = max(1, math.ceil(len(vec) / CHUNK))
    return pa.record_batch({
        "worker": pa.array([worker] * n, pa.int32()), "chunk": pa.array(range(n), pa.int32()),
        "steps": pa.array([steps] * n, pa.int32()), "loss_sum": pa.array([loss_sum] * n, pa.float64()),
        "values": pa.array([vec[c * CHUNK:(c + 1) * CHUNK].astype("<f8").tobytes() for c in range(n)], pa.binary())})


def _rows_of(t: pa.Table, model: Model, id_col: str, features: str, label: str):
    """Checked (ids, features, labels) of a table of training rows."""
    if t.column(label).null_count:
        raise ValueError(f"null in column {label}")
    y = t.column(label).to_numpy().astype(np.int64)
    if len(y) and (y.min() < 0 or y.max() >= model.n_out):
        raise ValueError(f"label outside 0..{model.n_out - 1}")
    return t.column(id_col).to_numpy(), list_matrix(t.column(features), model.n_in), y


def _round_fn(bc, id_col: str, features: str, label: str):
    """Train one worker's rows of the round; a task holds exactly one worker's rows."""
    def fn(batches):
        model, state, p, it0, step0, epoch = bc.value
        tables = [rb for rb in batches if rb.num_rows]
        if not tables:
            return
        t = pa.Table.from_batches(tables).combine_chunks().sort_by("pos")
        workers = np.unique(t.column("worker").to_numpy())
        if len(workers) != 1:
            raise RuntimeError(f"a training task got rows of workers {workers.tolist()}")
        ids, x, y = _rows_of(t, model, id_col, features, label)
        batch = t.column("batch").to_numpy()
        groups = ((ids[batch == k], x[batch == k], y[batch == k]) for k in np.unique(batch))
        new_model, new_state, steps, loss_sum = train_batches(model, state, groups, p, it0, epoch, step0)
        yield _chunk_rows(int(workers[0]), steps, loss_sum, flatten(new_model, new_state))
    return fn


def _mean_of_workers(t: pa.Table) -> pa.Table:
    t = t.sort_by("worker")  # a fixed order of addition
    vecs = [np.frombuffer(v, "<f8") for v in t.column("values").to_pylist()]
    return pa.table({"chunk": t.column("chunk").slice(0, 1), "workers": pa.array([len(vecs)], pa.int32()),
                     "steps": pa.array([max(t.column("steps").to_pylist())], pa.int32()),
                     "loss_sum": pa.array([math.fsum(t.column("loss_sum").to_pylist())]),
                     "values": pa.array([(np.sum(vecs, axis=0) / len(vecs)).astype("<f8").tobytes()], pa.binary())})


def average_chunks(worker_chunks: DataFrame) -> DataFrame:
    """Mean parameter vector over the workers, chunk by chunk (A6): a group holds ``workers``
    chunks of 128 KB, so it is bounded by the parameters."""
    return worker_chunks.groupBy("chunk").applyInArrow(_mean_of_workers, AVERAGED)


def _averaged(worker_chunks: DataFrame, model: Model, state: dict):
    """(model, state, steps, mean batch loss) from the workers' chunks; the model comes to
    the driver by design, to be broadcast again."""
    agg = average_chunks(worker_chunks).toArrow().sort_by("chunk")  # a row per 128 KB of the model
    if agg.num_rows == 0:
        return model, state, 0, float("nan")
    vec = np.frombuffer(b"".join(agg.column("values").to_pylist()), "<f8")
    steps, n = agg.column("steps")[0].as_py(), agg.column("workers")[0].as_py()
    new_model, new_state = unflatten(model, state, vec)
    return new_model, new_state, steps, agg.column("loss_sum")[0].as_py() / max(1, n * steps)


def run_round(part: DataFrame, model: Model, state: dict, p: FitParams, it0: int, epoch: int,
              *, id_col: str, features: str, label: str, step0: int | None = None):
    """One parameter-averaging round over ``part`` (one partition per worker, already
    filtered to the round) → (model, state, steps, mean batch loss)."""
    spark = part.sparkSession
    check_model_size(spark, model.nbytes() + sum(v.nbytes for v in state.values()))
    ship_package(spark)
    bc = spark.sparkContext.broadcast((model, state, p, it0, it0 if step0 is None else step0, epoch))
    try:
        return _averaged(part.mapInArrow(_round_fn(bc, id_col, features, label), ROUND_OUT), model, state)
    finally:
        bc.destroy()  # the round's job is over: free executors and driver alike


def barrier_slots(spark) -> int:
    """Tasks that surely run side by side; 0 where that isn't known."""
    conf = spark.sparkContext.getConf()
    if conf.get("spark.dynamicAllocation.enabled", "false") == "true" or conf.contains("spark.default.parallelism"):
        return 0
    return spark.sparkContext.defaultParallelism


def _message_bytes(model: Model, state: dict) -> int:
    return (flatten(model, state).nbytes + 3 * 8) * 4 // 3


def turn_seconds(model: Model, p: FitParams) -> float:
    """About what a round's batches of all workers take one after another: three products and the
    update of every parameter at 10⁹ operations a second, and a tenth of a millisecond a step."""
    return p.workers * p.avg_freq * (1e-4 + model.size() * (3 * p.batch_size + 20) / 1e9)


def _by_round(t: pa.Table, model: Model, id_col: str, features: str, label: str) -> dict[int, dict[int, list]]:
    """``{round: {worker: batches}}`` of training rows, by position."""
    t = t.combine_chunks().sort_by("pos")
    ids, x, y = _rows_of(t, model, id_col, features, label)
    of_round, worker, batch = (t.column(c).to_numpy() for c in ("round", "worker", "batch"))
    cuts = np.flatnonzero(np.any([np.diff(k, prepend=-1) != 0 for k in (of_round, worker, batch)], axis=0))
    out: dict[int, dict[int, list]] = {}
    for a, b in zip(cuts, [*cuts[1:], len(ids)]):
        out.setdefault(int(of_round[a]), {}).setdefault(int(worker[a]), []).append((ids[a:b], x[a:b], y[a:b]))
    return out


def _block_fn(bc, id_col: str, features: str, label: str, barrier: bool):
    """Train the rows of all rounds of a block, averaging the workers after each: one worker's rows and
    the other workers' means by the barrier, or with no barrier all workers' rows."""
    def fn(batches):
        model, state, p, it, step, epochs, rounds = bc.value
        task = BarrierTaskContext.get() if barrier else TaskContext.get()
        tables = [rb for rb in batches if rb.num_rows]
        mine = _by_round(pa.Table.from_batches(tables), model, id_col, features, label) if tables else {}
        workers = sorted({w for of_round in mine.values() for w in of_round})
        if barrier and len(workers) > 1:
            raise RuntimeError(f"a training task got rows of workers {workers}")
        total, loss_sum, n_batches = 0, 0.0, 0
        for epoch in epochs:
            for r in rounds:
                got = []
                for w, own in mine.get(r, {}).items():
                    new_model, new_state, steps, loss = train_batches(model, state, own, p, it + total, epoch, step + total)
                    got.append(np.concatenate([np.array([w, steps, loss]), flatten(new_model, new_state)]))
                if barrier:
                    message = base64.b64encode(got[0].astype("<f8").tobytes()).decode() if got else ""
                    got = [np.frombuffer(base64.b64decode(m), "<f8") for m in task.allGather(message) if m]
                if not got:
                    continue
                got.sort(key=lambda v: v[0])  # a fixed order of addition
                model, state = unflatten(model, state, np.sum([v[3:] for v in got], axis=0) / len(got))
                steps = int(max(v[1] for v in got))
                total, n_batches = total + steps, n_batches + len(got) * steps
                loss_sum += math.fsum(v[2] for v in got)
        if task.partitionId() == 0:
            yield _chunk_rows(0, total, loss_sum / max(1, n_batches), flatten(model, state))
    return fn


def _run_rounds(rows: DataFrame, model: Model, state: dict, p: FitParams, it0: int, epochs: range, rounds: range,
                barrier: bool, *, id_col: str, features: str, label: str, step0: int | None = None):
    spark = rows.sparkSession
    check_model_size(spark, model.nbytes() + sum(v.nbytes for v in state.values()))
    ship_package(spark)
    bc = spark.sparkContext.broadcast((model, state, p, it0, it0 if step0 is None else step0, epochs, rounds))
    try:
        out = rows.mapInArrow(_block_fn(bc, id_col, features, label, barrier), ROUND_OUT, barrier=barrier).toArrow().sort_by("chunk")
    finally:
        bc.destroy()
    new_model, new_state = unflatten(model, state, np.frombuffer(b"".join(out.column("values").to_pylist()), "<f8"))
    return new_model, new_state, out.column("steps")[0].as_py(), out.column("loss_sum")[0].as_py()


def run_turns(layout: "Layout", b: int, model: Model, state: dict, p: FitParams, it0: int, epochs: range, **names):
    """All rounds of block ``b``, ``epochs`` times, in one task that trains the workers of a round in turn →
    (model, state, steps, mean batch loss). The same bits as ``run_round`` round by round."""
    return _run_rounds(layout.read(b).coalesce(1), model, state, p, it0, epochs, layout.rounds_of(b), False, **names)


def run_block(layout: "Layout", b: int, model: Model, state: dict, p: FitParams, it0: int, epochs: range, **names):
    """All rounds of block ``b``, ``epochs`` times, in one job: in turn where that takes less than the
    barrier waits, else in a barrier stage with a partition per worker. The same bits either way."""
    if turn_seconds(model, p) <= TURN_SECONDS:
        return run_turns(layout, b, model, state, p, it0, epochs, **names)
    return _run_rounds(layout.dealt(b, p.workers), model, state, p, it0, epochs, layout.rounds_of(b), True, **names)


def leading_norm(model: Model) -> Layer | None:
    """The model's batch-norm layer if only dropout stands before it; ``ValueError`` if layers
    that need the gradient below a batch-norm (or of a second one) are there."""
    norms = [k for k, l in enumerate(model.layers) if l.kind == BATCHNORM]
    if not norms:
        return None
    if len(norms) > 1 or any(l.kind != DROPOUT for l in model.layers[:norms[0]]):
        raise ValueError("a full-batch round takes one batch-norm layer, with only dropout before it")
    return model.layers[norms[0]]


def _by_worker(t: pa.Table, model: Model, worker: str, id_col: str, features: str, label: str):
    """(worker, ids, features, labels) of each worker's rows of ``t``."""
    workers = t.column(worker).to_numpy()
    for w in np.unique(workers):
        mine = t.filter(pa.array(workers == w)).combine_chunks()
        yield (int(w), *_rows_of(mine, model, id_col, features, label))


def merged_moments(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, mean, sum of squared distances from it) of the union of parts that have the same three."""
    n, mean, squares = parts[0]
    for m, other, more in parts[1:]:
        away = other - mean
        mean = mean + away * (m / (n + m))
        squares = squares + more + away * away * (n * m / (n + m))
        n += m
    return n, mean, squares


def _worker_moments(df: DataFrame, bc, p: FitParams, epoch: int, columns: dict[str, str]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean and variance of each worker's inputs to the leading batch-norm: partial moments where
    the rows are, merged per worker in task order. Two vectors of the layer's width per worker come back."""
    width = leading_norm(bc.value[0]).n_in

    def parts(batches):
        model, _ = bc.value
        total: dict[int, tuple] = {}
        for b in batches:
            for w, ids, x, _ in _by_worker(pa.Table.from_batches([b]), model, **columns):
                x = _dropped(model, x, _masks(model, ids, p, epoch))
                mean = x.mean(axis=0)
                mine = len(x), mean, ((x - mean) ** 2).sum(axis=0)
                total[w] = merged_moments([total[w], mine]) if w in total else mine
        for w, (n, mean, squares) in total.items():
            yield pa.record_batch({"worker": pa.array([w], pa.int32()), "task": pa.array([TaskContext.get().partitionId()], pa.int32()),
                                   "n": pa.array([n], pa.int64()), "values": pa.array([np.concatenate([mean, squares]).astype("<f8").tobytes()], pa.binary())})

    def merge(t: pa.Table) -> pa.Table:
        t = t.sort_by("task")
        cut = [(n, v[:width], v[width:]) for n, v in zip(t.column("n").to_pylist(), (np.frombuffer(v, "<f8") for v in t.column("values").to_pylist()))]
        n, mean, squares = merged_moments(cut)
        return pa.table({"worker": t.column("worker").slice(0, 1),
                         "values": pa.array([np.concatenate([mean, squares / n]).astype("<f8").tobytes()], pa.binary())})

    found = df.mapInArrow(parts, "worker int, task int, n long, values binary").groupBy("worker") \
        .applyInArrow(merge, "worker int, values binary").toArrow().to_pylist()
    return {r["worker"]: (v[:width], v[width:]) for r in found for v in [np.frombuffer(r["values"], "<f8")]}


def _masks(model: Model, ids: np.ndarray, p: FitParams, epoch: int) -> dict[str, np.ndarray]:
    return {l.name: dropout_mask_np(ids, l.n_in, l.keep_prob, p.seed + 7919 * li, epoch)
            for li, l in enumerate(model.layers) if l.kind == DROPOUT and l.keep_prob < 1.0}


def _dropped(model: Model, x: np.ndarray, masks: dict[str, np.ndarray]) -> np.ndarray:
    """What the dropout layers before the batch-norm leave of ``x``."""
    for l in model.layers:
        if l.kind == BATCHNORM:
            break
        if l.name in masks:
            x = x * masks[l.name] / l.keep_prob
    return x


def full_batch_round(df: DataFrame, model: Model, state: dict, p: FitParams, it0: int = 0, step0: int | None = None,
                     *, features: str, label: str, worker: str = "worker", id_col: str | None = None, epoch: int = 0):
    """One round in which every worker takes one step on all its rows → (model, state, mean loss).

    Gradient sums are accumulated over Arrow batches wherever the rows are, then added per
    worker in task order: no task holds a worker's rows. A batch-norm that only dropout
    precedes gets each worker's moments by a pass of its own, before the gradients.
    ``id_col`` keys the dropout masks; models without dropout need none.
    """
    norm = leading_norm(model)
    if id_col is None and any(l.kind == DROPOUT and l.keep_prob < 1.0 for l in model.layers):
        raise ValueError("dropout masks need id_col")
    spark = df.sparkSession
    check_model_size(spark, model.nbytes() + sum(v.nbytes for v in state.values()))
    ship_package(spark)
    bc = spark.sparkContext.broadcast((model, state))
    step = it0 if step0 is None else step0
    names = _trainable(model)
    columns = {"worker": worker, "id_col": id_col or worker, "features": features, "label": label}
    df = df.select(*dict.fromkeys(columns.values()))
    moments = _worker_moments(df, bc, p, epoch, columns) if norm else {}

    def sums(batches):
        model, _ = bc.value
        total: dict[int, list] = {}
        for b in batches:
            for w, ids, x, y in _by_worker(pa.Table.from_batches([b]), model, **columns):
                loss, grads, _ = loss_and_grads(model, x, y, _masks(model, ids, p, epoch), {norm.name: moments[w]} if norm else None)
                vec = np.concatenate([grads[k].ravel() for k in names]) * len(y)
                n, s, v = total.get(w, (0, 0.0, 0.0))
                total[w] = n + len(y), s + loss * len(y), v + vec
        for w, (n, s, v) in total.items():
            yield pa.record_batch({"worker": pa.array([w], pa.int32()), "task": pa.array([TaskContext.get().partitionId()], pa.int32()),
                                   "n": pa.array([n], pa.int64()), "loss": pa.array([s]),
                                   "values": pa.array([np.asarray(v, "<f8").tobytes()], pa.binary())})

    def one_step(t: pa.Table) -> pa.Table:
        model, state = bc.value
        t = t.sort_by("task")
        n = sum(t.column("n").to_pylist())
        mean = np.sum([np.frombuffer(v, "<f8") for v in t.column("values").to_pylist()], axis=0) / n
        params, new_state, grads, at = dict(model.params), dict(state), {}, 0
        for k in names:
            grads[k] = mean[at:at + params[k].size].reshape(params[k].shape)
            at += params[k].size
        apply_update(params, grads, new_state, p, rate_at(it0, p.schedule, p.rate), step)
        if norm:
            for name, now in zip(("mean", "var"), moments[t.column("worker")[0].as_py()]):
                params[f"{norm.name}/{name}"] = norm.decay * params[f"{norm.name}/{name}"] + (1 - norm.decay) * now
        return pa.Table.from_batches([_chunk_rows(t.column("worker")[0].as_py(), 1, math.fsum(t.column("loss").to_pylist()) / n,
                                                  flatten(Model(model.layers, params), new_state))])

    try:
        partial = df.mapInArrow(sums, "worker int, task int, n long, loss double, values binary")
        new_model, new_state, _, loss = _averaged(partial.groupBy("worker").applyInArrow(one_step, ROUND_OUT), model, state)
        return new_model, new_state, loss
    finally:
        bc.destroy()


def worker_keys(spark, workers: int) -> list[int]:
    """For each worker ``j`` a bigint key whose hash partition among ``workers``
    partitions is exactly ``j`` (Spark's own ``hash`` = the shuffle's Murmur3, seed 42),
    so ``repartition(workers, key)`` puts every worker alone in its own partition."""
    span = workers * 64
    while True:
        rows = (spark.range(span).select("id", F.pmod(F.hash("id"), F.lit(workers)).alias("p"))
                .groupBy("p").agg(F.min("id").alias("k")).collect())
        keys = {int(r["p"]): int(r["k"]) for r in rows}
        if len(keys) == workers:
            return [keys[j] for j in range(workers)]
        span *= 4


# ---- fit -----------------------------------------------------------------------------

@dataclass
class FitResult:
    model: Model
    state: dict
    iterations: int
    history: pd.DataFrame
    updater_steps: int = 0

    def meta(self) -> dict[str, float]:
        """Counters to save with the model, for a warm start."""
        return {"iterations": self.iterations, "updater_steps": self.updater_steps}

    def history_df(self, spark) -> DataFrame:
        return spark.createDataFrame(self.history, schema=HISTORY_SCHEMA)


HISTORY_SCHEMA = T.StructType([
    T.StructField("epoch", T.IntegerType(), False),
    T.StructField("split", T.StringType(), False),
    T.StructField("n", T.LongType(), True),
    T.StructField("loss", T.DoubleType(), True),
    T.StructField("accuracy", T.DoubleType(), True),
    T.StructField("precision", T.DoubleType(), True),
    T.StructField("recall", T.DoubleType(), True),
    T.StructField("l2_penalty", T.DoubleType(), True),
])


def l2_penalty(model: Model, l2: float) -> float:
    """½·λ·Σ W² over the weight matrices (reported apart from the loss)."""
    return 0.5 * l2 * float(sum((model.params[k] ** 2).sum() for k in model.keys() if k.endswith("/W")))


@dataclass
class Layout:
    """A prepared training layout, reusable by fits that share the data, seed, workers, batch
    size and averaging frequency (e.g. a sweep over updaters)."""
    table: DataFrame
    path: str
    rounds: int
    key: tuple
    per_block: int

    @property
    def blocks(self) -> int:
        return -(-self.rounds // self.per_block)

    def rounds_of(self, b: int) -> range:
        return range(b * self.per_block, min(self.rounds, (b + 1) * self.per_block))

    def read(self, b: int) -> DataFrame:
        return self.table.sparkSession.read.schema(self.table.drop("block").schema).parquet(f"{self.path}/block={b}")

    def dealt(self, b: int, workers: int) -> DataFrame:
        """Block ``b`` with each worker alone in its partition."""
        keys = F.array(*[F.lit(k).cast("bigint") for k in worker_keys(self.table.sparkSession, workers)])
        return self.read(b).withColumn("_wkey", F.element_at(keys, F.col("worker") + 1)).repartition(workers, "_wkey").drop("_wkey")

    def block(self, b: int, workers: int, rows: int) -> DataFrame:
        """Block ``b`` dealt to its workers and persisted, for a job per round; cached in column
        batches of one round's ``rows`` of a worker, so a round's filter skips the others."""
        spark = self.table.sparkSession
        laid = self.dealt(b, workers).sortWithinPartitions("round", "pos")
        # the setting must hold until the count below has built the cache
        conf = "spark.sql.inMemoryColumnarStorage.batchSize"
        before = spark.conf.get(conf)
        spark.conf.set(conf, str(max(1, rows)))
        try:
            laid = laid.persist(StorageLevel.MEMORY_AND_DISK)
            laid.count()
        finally:
            spark.conf.set(conf, before)
        return laid

    def release(self) -> None:
        remove_path(self.table.sparkSession, self.path)


def layout_key(p: FitParams) -> tuple:
    return (p.seed, p.workers, p.batch_size, p.avg_freq)


def prepare_layout(df: DataFrame, p: FitParams, *, id_col: str = "id", features: str = "features",
                   label: str = "label", rounds_per_block: int | None = None, width: int | None = None) -> Layout:
    """Seeded order + mini-batch assignment, written once for all epochs in blocks of rounds.

    ``width``: features of a row, as far as known; narrow rows then go into blocks of more rounds."""
    spark = df.sparkSession
    if rounds_per_block is None:
        round_bytes = 8 * (width or 0) * p.workers * p.batch_size * p.avg_freq
        rounds_per_block = max(ROUNDS_PER_BLOCK, BLOCK_BYTES // round_bytes if round_bytes else 0)
    assigned = assign_minibatches(with_position(df.select(id_col, features, label), id_col, p.seed),
                                  p.workers, p.batch_size, p.avg_freq)
    path = scratch_path(spark, "layout")
    blocked = assigned.withColumn("block", F.floor(F.col("round") / rounds_per_block).cast("int"))
    blocked.write.partitionBy("block").parquet(path)
    table = spark.read.schema(blocked.schema).parquet(path)
    top = table.agg(F.max("round").alias("r")).first()["r"]
    return Layout(table, path, 0 if top is None else int(top) + 1, layout_key(p), rounds_per_block)


def write_history(rows: DataFrame, path: str) -> None:
    """Put history rows into the table at ``path``, one folder per (epoch, split) (K3).

    Dynamic partition overwrite replaces exactly the folders that get rows, so an epoch that a
    resumed run evaluates again leaves one row for each key, and the other epochs stay.
    """
    rows.withColumns({"_epoch": F.col("epoch"), "_split": F.col("split")}).repartition("_epoch", "_split") \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_epoch", "_split").parquet(path)


def read_history(spark, path: str) -> DataFrame:
    """The history table at ``path``: one row for each (epoch, split)."""
    return spark.read.schema(HISTORY_SCHEMA).parquet(path).select(*HISTORY_SCHEMA.fieldNames())


def evaluate_splits(frames: dict[str, DataFrame | None], model: Model, *, features: str,
                    label: str) -> dict[str, dict]:
    """Metrics of several tables in one job: the tables are tagged and unioned, scored
    once, and the confusion aggregate is grouped by the tag."""
    parts = [d.select(features, label).withColumn("_split", F.lit(name))
             for name, d in frames.items() if d is not None]
    if not parts:
        return {}
    union = parts[0]
    for d in parts[1:]:
        union = union.unionByName(d)
    scored = predict(union, model, features=features, label=label, keep=[label, "_split"])
    got = {r["_split"]: r.asDict() for r in E.evaluate(scored, by=("_split",)).collect()}
    empty = {"n": 0, "loss": None, "accuracy": None, "precision": None, "recall": None}
    return {name: got.get(name, empty) for name, d in frames.items() if d is not None}


def fit(df: DataFrame, model: Model, p: FitParams, *, id_col: str = "id", features: str = "features",
        label: str = "label", valid: DataFrame | None = None, state: dict | None = None,
        iterations: int = 0, updater_steps: int | None = None, history_path: str | None = None,
        layout: Layout | None = None, snapshot_path: str | None = None,
        snapshot_every: int = 1, start_epoch: int = 0) -> FitResult:
    """Train ``model`` on ``df`` for ``p.epochs`` epochs.

    Warm start (T10): pass a saved model, its ``state``, ``iterations`` and ``updater_steps``.
    State of another updater isn't used: the new one starts from zero state and zero steps.
    History rows every ``eval_interval`` epochs of this run go to ``history_path`` as they come, each
    replacing an earlier row of its epoch and split. ``layout``: a :class:`Layout` prepared from the same ``df`` (kept for the caller).
    ``snapshot_path``: every ``snapshot_every`` epochs a model table is written to its folder
    ``epoch=N``; a run that loses its driver resumes from the newest complete one
    (``read_model`` finds it) with ``start_epoch`` = its epoch + 1, so dropout masks (keyed by
    epoch) continue where they stopped."""
    from ..sources.models import write_snapshot

    if snapshot_every <= 0:
        raise ValueError("snapshot_every must be positive")
    last = model.layers[-1]
    if last.kind != DENSE or last.activation != "softmax":
        raise ValueError("the model must end in a softmax dense layer")
    if not isinstance(df.schema[id_col].dataType, T.IntegralType):
        raise ValueError(f"id column {id_col!r} must be an integer type (e.g. xxhash64 of a path), "
                         f"not {df.schema[id_col].dataType.simpleString()}")
    model = with_keep_prob(model, p.keep_prob)
    fresh, it = init_state(model, p.updater), iterations
    if state is None or any(k not in state for k in fresh):
        state, steps_done = fresh, 0
    else:
        state, steps_done = {k: state[k] for k in fresh}, iterations if updater_steps is None else updater_steps
    if layout is not None and layout.key != layout_key(p):
        raise ValueError(f"layout was prepared for (seed, workers, batch, avg_freq) = {layout.key}, not {layout_key(p)}")
    own = layout is None
    layout = layout or prepare_layout(df, p, id_col=id_col, features=features, label=label, width=model.n_in)
    spark, hist = df.sparkSession, []
    # training rows are evaluated from the layout (no recomputation of df's lineage); validation
    # rows are kept for the run as well
    train_eval = layout.table.select(features, label)
    valid_eval = valid.select(features, label).persist(StorageLevel.MEMORY_AND_DISK) if valid is not None else None
    held, block = None, None
    slots = barrier_slots(spark) >= p.workers
    together = p.workers * _message_bytes(model, state) <= BARRIER_BYTES and (slots or turn_seconds(model, p) <= TURN_SECONDS)
    names = {"id_col": id_col, "features": features, "label": label}
    end, epoch = start_epoch + p.epochs, start_epoch - 1
    try:
        while epoch + 1 < end:
            done = epoch + 1 - start_epoch
            if together:
                # a single block goes on until the next evaluation or snapshot
                stops = [p.eval_interval] + [snapshot_every] * bool(snapshot_path)
                span = 1 if layout.blocks > 1 else min(EPOCHS_PER_JOB, end - epoch - 1, *(n - done % n for n in stops))
                run = run_block if slots else run_turns
                for b in range(layout.blocks):
                    model, state, steps, _ = run(layout, b, model, state, p, it, range(epoch + 1, epoch + 1 + span),
                                                 step0=steps_done, **names)
                    it, steps_done = it + steps, steps_done + steps
                epoch += span
            else:
                epoch += 1
                for r in range(layout.rounds):
                    if r // layout.per_block != held:  # a single block stays for all epochs
                        if block is not None:
                            block.unpersist()
                        held = r // layout.per_block
                        block = layout.block(held, p.workers, p.batch_size * p.avg_freq)
                    model, state, steps, _ = run_round(block.filter(F.col("round") == r), model, state, p, it, epoch,
                                                       step0=steps_done, **names)
                    it, steps_done = it + steps, steps_done + steps
            done = epoch - start_epoch + 1
            if snapshot_path and done % snapshot_every == 0:
                write_snapshot(spark, model, snapshot_path, epoch, state=state,
                               meta={"iterations": it, "updater_steps": steps_done, "epoch": epoch})
            if done % p.eval_interval == 0:
                metrics = evaluate_splits({"train": train_eval, "valid": valid_eval}, model, features=features,
                                          label=label)
                rows = [{"epoch": epoch, "split": split, "n": m.get("n"), "loss": m.get("loss"),
                         "accuracy": m.get("accuracy"), "precision": m.get("precision"),
                         "recall": m.get("recall"), "l2_penalty": l2_penalty(model, p.l2)} for split, m in metrics.items()]
                hist += rows
                if history_path and rows:
                    write_history(spark.createDataFrame([tuple(r.values()) for r in rows], HISTORY_SCHEMA), history_path)
    finally:
        if block is not None:
            block.unpersist()
        if own:
            layout.release()
        if valid_eval is not None:
            valid_eval.unpersist()
    return FitResult(model, state, it, pd.DataFrame(hist, columns=HISTORY_SCHEMA.fieldNames()), steps_done)


def fit_all(spark, fits: list[Callable[[], FitResult]]) -> list[FitResult]:
    """The results of fits that don't depend on each other (a sweep), run side by side: each goes on
    round by round, so their jobs together use more of the cluster."""
    ship_package(spark)
    with ThreadPool(len(fits)) as pool:
        return pool.map(lambda run: run(), [inheritable_thread_target(spark)(f) for f in fits])
