"""Whole fits as DuckDB SQL: a recursive query that carries every worker's weights and
optimizer state from step to step.

One step of the recursion is one mini-batch of every worker: softmax probabilities of the
batch's rows, mean gradient, L2, the update rule with its state; behind a round's last batch
the workers that had rows are averaged, weights and state alike. Learning rate, L2 and the
counters of a step come from a table of steps, so a warm start is just more steps.
"""

from __future__ import annotations

from dataclasses import dataclass

CLASSES = 10
#: New (w, s1, s2) of each update rule; ``gl`` is the gradient with L2, ``lr`` the rate, ``t`` counts steps from 0.
RULES = {
    "sgd": ("w - lr * gl", "s1", "s2"),
    "nesterovs": ("w - 0.9 * s1 + 1.9 * (0.9 * s1 - lr * gl)", "0.9 * s1 - lr * gl", "s2"),
    "adam": ("w - lr * ((0.9 * s1 + (1 - 0.9) * gl) / (1 - power(0.9, t + 1))) "
             "/ (sqrt((0.999 * s2 + (1 - 0.999) * gl * gl) / (1 - power(0.999, t + 1))) + 1e-8)",
             "0.9 * s1 + (1 - 0.9) * gl", "0.999 * s2 + (1 - 0.999) * gl * gl"),
    "rmsprop": ("w - lr * gl / sqrt(0.95 * s1 + (1 - 0.95) * gl * gl + 1e-8)", "0.95 * s1 + (1 - 0.95) * gl * gl", "s2"),
    "adadelta": ("w - sqrt(s2 + 1e-6) / sqrt(0.95 * s1 + (1 - 0.95) * gl * gl + 1e-6) * gl", "0.95 * s1 + (1 - 0.95) * gl * gl",
                 "0.95 * s2 + (1 - 0.95) * (s2 + 1e-6) / (0.95 * s1 + (1 - 0.95) * gl * gl + 1e-6) * gl * gl"),
}


@dataclass(frozen=True)
class Phase:
    """Epochs run with one setting; ``rate`` is SQL over ``it``, the iterations before the step."""
    epochs: int
    rate: str
    l2: float = 0.0


def fit_states(positions: str, updater: str, phases: list[Phase], *, workers: int, batch: int, freq: int) -> str:
    """``epoch, param, i, j, v``: the averaged weights at the end of every epoch, from zero weights.

    ``positions`` gives ``vec_id, pos`` (dense from 0) of the training rows.
    """
    w, s1, s2 = RULES[updater]
    per_worker, per_round = batch * freq, workers * batch * freq
    epochs, first = [], 0
    for p in phases:
        epochs.append(f"SELECT range AS epoch, {float(p.l2)} AS l2, {len(epochs)} AS phase FROM range({first}, {first + p.epochs})")
        first += p.epochs
    rates = " ".join(f"WHEN {n} THEN {p.rate}" for n, p in enumerate(phases))
    return f"""
WITH RECURSIVE placed AS MATERIALIZED (
  SELECT vec_id, pos // {per_round} AS round, pos % {per_round} // {per_worker} AS worker, pos % {per_worker} // {batch} AS batch FROM ({positions})),
x AS MATERIALIZED (
  SELECT p.*, e.label, CAST(unnest(e.embedding) AS DOUBLE) AS v, unnest(range(len(e.embedding))) AS i
  FROM embeddings e JOIN placed p ON p.vec_id = e.vec_id),
batches AS (SELECT round, max(batch) + 1 AS n FROM placed GROUP BY round),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY epoch, round, batch) AS g FROM (
    SELECT e.*, b.round, unnest(range(b.n)) AS batch, b.n FROM ({" UNION ALL ".join(epochs)}) e, batches b)),
steps AS MATERIALIZED (
  SELECT g, epoch, round, batch, batch = n - 1 AS ends, g = max(g) OVER (PARTITION BY epoch) AS ends_epoch, l2, t,
         CASE phase {rates} END AS lr FROM (SELECT *, g - 1 AS t, g - 1 AS it FROM numbered)),
here AS MATERIALIZED (SELECT DISTINCT round, worker FROM placed),
state AS (
  SELECT CAST(0 AS BIGINT) AS g, worker, param, i, j, CAST(0 AS DOUBLE) AS w, CAST(0 AS DOUBLE) AS s1, CAST(0 AS DOUBLE) AS s2
  FROM (SELECT range AS worker FROM range({workers})), (SELECT range AS j FROM range({CLASSES})),
       (SELECT 'W' AS param, i FROM (SELECT DISTINCT i FROM x) UNION ALL SELECT 'b', 0)
  UNION ALL
  SELECT g, worker, param, i, j,
    CASE WHEN ends THEN avg(w) FILTER (WHERE active) OVER (PARTITION BY param, i, j) ELSE w END,
    CASE WHEN ends THEN avg(s1) FILTER (WHERE active) OVER (PARTITION BY param, i, j) ELSE s1 END,
    CASE WHEN ends THEN avg(s2) FILTER (WHERE active) OVER (PARTITION BY param, i, j) ELSE s2 END
  FROM (
    SELECT g, worker, param, i, j, ends, active, CASE WHEN raw IS NULL THEN w ELSE {w} END AS w,
           CASE WHEN raw IS NULL THEN s1 ELSE {s1} END AS s1, CASE WHEN raw IS NULL THEN s2 ELSE {s2} END AS s2
    FROM (
      SELECT st.g, s.worker, s.param, s.i, s.j, st.ends, st.lr, st.t, s.w, s.s1, s.s2, h.worker IS NOT NULL AS active, d.raw,
             d.raw + CASE WHEN s.param = 'W' THEN st.l2 * s.w ELSE 0 END AS gl
      FROM state s JOIN steps st ON st.g = s.g + 1
      LEFT JOIN here h ON h.round = st.round AND h.worker = s.worker
      LEFT JOIN (
        SELECT r.worker, 'W' AS param, r.i, e.j, avg(r.v * e.d) AS raw
        FROM (SELECT x.* FROM x, steps st WHERE x.round = st.round AND x.batch = st.batch AND st.g = (SELECT max(g) + 1 FROM state)) r
        JOIN ({_errors()}) e ON e.vec_id = r.vec_id GROUP BY ALL
        UNION ALL
        SELECT worker, 'b' AS param, 0 AS i, j, avg(d) AS raw FROM ({_errors()}) GROUP BY ALL
      ) d ON d.worker = s.worker AND d.param = s.param AND d.i = s.i AND d.j = s.j
    ))
)
SELECT st.epoch, s.param, s.i, s.j, s.w AS v FROM state s JOIN steps st ON st.g = s.g WHERE s.worker = 0 AND st.ends_epoch
"""


def _errors() -> str:
    """``worker, vec_id, j, d``: probability minus one-hot of the rows of the step after ``state``."""
    z = ("SELECT x.worker, x.vec_id, x.label, s.j, sum(x.v * s.w) + max(c.w) AS z FROM x "
         "JOIN steps st ON x.round = st.round AND x.batch = st.batch "
         "JOIN state s ON st.g = s.g + 1 AND s.worker = x.worker AND s.param = 'W' AND s.i = x.i "
         "JOIN state c ON c.worker = x.worker AND c.param = 'b' AND c.j = s.j GROUP BY ALL")
    e = f"SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM ({z})"
    return f"SELECT worker, vec_id, j, e / sum(e) OVER (PARTITION BY vec_id) - CASE WHEN label = j THEN 1 ELSE 0 END AS d FROM ({e})"
