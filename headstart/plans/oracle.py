"""DuckDB oracle SQL for the registered queries (same column names, same rounding).

Tables are the pre-registered views (``embeddings`` …). Fixture weights are generated with
``range`` from the formula ``((31*i + 17*j) % 13 - 6) / 20``; elements are cast to DOUBLE
before arithmetic; integer sums are cast back to BIGINT.
"""

from __future__ import annotations

from .oracle_training import RULES, Phase, fit_states

R = 6


def rnd(x: str) -> str:
    """Round to 6 places; ``+ 0.0`` turns -0.0 into 0.0 (as on the Spark side)."""
    return f"(round({x}, {R}) + 0.0)"


def _weights(n_in: int, n_out: int) -> str:
    return (f"SELECT range // {n_out} AS i, range % {n_out} AS j, "
            f"CAST(((31 * (range // {n_out}) + 17 * (range % {n_out})) % 13) - 6 AS DOUBLE) / 20.0 AS w "
            f"FROM range({n_in * n_out})")


# exploded features: one row per (vec_id, i)
X = ("SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, "
     "unnest(range(len(embedding))) AS i FROM embeddings")


def _dense(src: str, n_in: int, n_out: int) -> str:
    """``src`` has vec_id, label, i, v → vec_id, label, j, z."""
    return (f"SELECT s.vec_id, s.label, w.j, sum(s.v * w.w) AS z FROM ({src}) s "
            f"JOIN ({_weights(n_in, n_out)}) w ON s.i = w.i GROUP BY s.vec_id, s.label, w.j")


def _softmax(zsql: str) -> str:
    return (f"SELECT vec_id, label, j, z, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM "
            f"(SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM ({zsql}))")


P1 = _softmax(_dense(X, 64, 10))  # one-layer head probabilities

PRED = (f"WITH p AS ({P1}), "
        "top AS (SELECT vec_id, label, CAST(j AS INTEGER) AS pred, p AS prob, "
        "row_number() OVER (PARTITION BY vec_id ORDER BY z DESC, j) AS rk FROM p) "
        "SELECT t.vec_id, t.label, t.pred, t.prob, -ln(q.p) AS nll FROM top t "
        "JOIN p q ON q.vec_id = t.vec_id AND q.j = t.label WHERE t.rk = 1")

CONF = f"SELECT label, pred, count(*) AS n, sum(nll) AS nll_sum FROM ({PRED}) GROUP BY label, pred"

CLASSES = (f"WITH c AS ({CONF}), s AS ("
           "SELECT label AS cls, CASE WHEN label = pred THEN n ELSE 0 END AS tp, 0 AS predicted, "
           "n AS actual, nll_sum FROM c UNION ALL "
           "SELECT pred AS cls, 0 AS tp, n AS predicted, 0 AS actual, NULL AS nll_sum FROM c) "
           "SELECT cls, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(predicted) AS BIGINT) AS predicted, "
           "CAST(sum(actual) AS BIGINT) AS actual, sum(nll_sum) AS nll_sum, "
           "sum(tp) / nullif(sum(predicted), 0) AS precision, "
           "sum(tp) / nullif(sum(actual), 0) AS recall FROM s GROUP BY cls")


def _exploded(zsql: str, value: str) -> str:
    return f"SELECT vec_id, CAST(j AS INTEGER) AS j, {rnd(value)} AS value FROM ({zsql})"


def _path_sql() -> str:
    d3 = "lpad(CAST(label + 1 AS VARCHAR), 3, '0')"
    d4 = "lpad(CAST(vec_id % 10000 AS VARCHAR), 4, '0')"
    split = "CASE WHEN vec_id % 5 = 0 THEN 'valid' ELSE 'train' END"
    return (f"SELECT vec_id, label, '/img/' || {split} || '/' || {d3} || '.c' || CAST(vec_id // 10000 AS VARCHAR) || '/' || {d3} || '_' || {d4} "
            f"|| '.jpg' AS path FROM embeddings")


PATH_RE = r"^.+/(\d{3})_\d{4}\.jpg$"

SPOILED = (
    "SELECT vec_id, CASE WHEN vec_id % 10 <> 0 THEN path "
    "WHEN (vec_id // 10) % 4 = 0 THEN path || '.bak' "
    "WHEN (vec_id // 10) % 4 = 1 THEN regexp_replace(path, '/', '', 'g') "
    r"WHEN (vec_id // 10) % 4 = 2 THEN regexp_replace(path, '\d{3}_(\d{4})\.jpg$', '000_\1.jpg') "
    r"ELSE regexp_replace(path, '/\d(\d{2})_(\d{4})\.jpg$', '/\1_\2.jpg') END AS path "
    f"FROM ({_path_sql()})")

POS = ("SELECT vec_id, label, row_number() OVER (ORDER BY md5('42:' || CAST(vec_id AS VARCHAR)), vec_id) - 1 "
       "AS pos FROM embeddings")

ORACLES: dict[str, str] = {
    "scan_features": "SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dim FROM embeddings",
    "predict": f"SELECT vec_id, label, pred, {rnd('prob')} AS prob, {rnd('nll')} AS nll FROM ({PRED})",
    "confusion_matrix": f"SELECT label, pred, n FROM ({CONF})",
    "accuracy": (f"SELECT {rnd('sum(CASE WHEN label = pred THEN n ELSE 0 END) / sum(n)')} AS accuracy "
                 f"FROM ({CONF})"),
    "per_class_stats": (f"SELECT cls, tp, predicted, actual, {rnd('precision')} AS precision, "
                        f"{rnd('recall')} AS recall FROM ({CLASSES})"),
    "macro_precision_recall": (f"SELECT {rnd('avg(precision)')} AS precision, "
                               f"{rnd('avg(recall)')} AS recall FROM ({CLASSES})"),
    "mean_nll": f"SELECT {rnd('avg(nll)')} AS loss FROM ({PRED})",
    "evaluate": (f"SELECT CAST(sum(actual) AS BIGINT) AS n, {rnd('sum(tp) / sum(actual)')} AS accuracy, "
                 f"{rnd('avg(precision)')} AS precision, {rnd('avg(recall)')} AS recall, "
                 f"{rnd('sum(nll_sum) / sum(actual)')} AS loss FROM ({CLASSES})"),
    "dense_layer": _exploded(_dense(X, 64, 16), "z"),
    "relu_layer": _exploded(_dense(X, 64, 16), "greatest(z, 0.0)"),
    "softmax_probs": _exploded(P1, "p"),
    "featurize_upto": _exploded(_dense(X, 64, 16), "greatest(z, 0.0)"),
    "onehot_encode": ("SELECT vec_id, CAST(10 AS INTEGER) AS n, label AS hot, CAST(1.0 AS DOUBLE) AS total "
                      "FROM embeddings"),
    "onehot_decode": "SELECT vec_id, label FROM embeddings",
    "ml_bridge": (f"SELECT vec_id, CAST(label AS DOUBLE) AS label, "
                  f"{rnd('list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))')} "
                  f"AS sq_norm FROM embeddings"),
    "label_from_path": (f"SELECT vec_id, path, CAST(regexp_extract(path, '{PATH_RE}', 1) AS INTEGER) - 1 "
                        f"AS label FROM ({_path_sql()})"),
    "label_from_path_reject": (
        f"SELECT CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS good, "
        f"CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS bad FROM ("
        f"SELECT coalesce(regexp_matches(path, '{PATH_RE}') AND "
        f"TRY_CAST(regexp_extract(path, '{PATH_RE}', 1) AS INTEGER) - 1 BETWEEN 0 AND 9, false) AS ok "
        f"FROM ({SPOILED}))"),
    "shuffle_order": "SELECT vec_id, md5('42:' || CAST(vec_id AS VARCHAR)) AS order_key FROM embeddings",
    "shuffle_position": f"SELECT vec_id, pos FROM ({POS})",
    "split_fixed": (f"SELECT vec_id, CASE WHEN pos < 50 THEN 'valid' WHEN pos < 110 THEN 'test' "
                    f"ELSE 'train' END AS split FROM ({POS})"),
    "minibatch_assign": (f"SELECT vec_id, CAST(pos // 160 AS INTEGER) AS round, "
                         f"CAST((pos % 160) // 40 AS INTEGER) AS worker, "
                         f"CAST((pos % 40) // 8 AS INTEGER) AS batch FROM ({POS})"),
    "dropout_mask": None,  # filled below
}


# ---- training, models, moments, schedule, staged featurization, sinks, sources ----------

def _exploded_rows(where: str) -> str:
    """vec_id, label, worker (quarters of the seeded order of the chosen rows), i, v."""
    chosen = (f"SELECT vec_id, CAST((row_number() OVER (ORDER BY pos) - 1) * 4 // count(*) OVER () AS BIGINT) AS worker "
              f"FROM ({POS}) WHERE {where}")
    return ("SELECT e.vec_id, e.label, p.worker, CAST(unnest(e.embedding) AS DOUBLE) AS v, "
            f"unnest(range(len(e.embedding))) AS i FROM embeddings e JOIN ({chosen}) p ON p.vec_id = e.vec_id")


def _zero_gradients(where: str) -> tuple[str, str]:
    """Each worker's mean gradient at zero weights: (worker, i, j, g) and (worker, j, g)."""
    x = _exploded_rows(where)
    d = "0.1 - CASE WHEN label = j THEN 1 ELSE 0 END"
    w = (f"SELECT worker, i, j, avg(v * ({d})) AS g FROM (SELECT worker, i, v, label, unnest(range(10)) AS j FROM ({x})) "
         "GROUP BY worker, i, j")
    b = (f"SELECT worker, j, avg({d}) AS g FROM (SELECT worker, label, unnest(range(10)) AS j FROM ({x}) WHERE i = 0) "
         "GROUP BY worker, j")
    return w, b


def _zero_round(where: str = "true", step: str = "-g") -> str:
    """Weights after one averaging round from zero: the mean over workers of ``step`` of g."""
    w, b = _zero_gradients(where)
    return (f"SELECT 'W' AS param, i, j, avg({step}) AS v FROM ({w}) GROUP BY i, j "
            f"UNION ALL SELECT 'b' AS param, 0 AS i, j, avg({step}) AS v FROM ({b}) GROUP BY j")


ZERO_ROUND = _zero_round()


def _logits(x: str, model: str) -> str:
    """vec_id, label, j, z of rows ``x`` under a model (param, i, j, v)."""
    return (f"SELECT x.vec_id, x.label, w.j, sum(x.v * w.v) + max(b.v) AS z FROM ({x}) x "
            f"JOIN (SELECT * FROM ({model}) WHERE param = 'W') w ON w.i = x.i "
            f"JOIN (SELECT j, v FROM ({model}) WHERE param = 'b') b ON b.j = w.j GROUP BY x.vec_id, x.label, w.j")


#: One step of each update rule from zero state.
FIRST_STEPS = {
    "sgd": "-0.01 * g",
    "nesterovs": "-1.9 * 0.01 * g",
    "adam": "-0.01 * g / (abs(g) + 1e-8)",
    "adadelta": "-sqrt(1e-6) / sqrt(0.05 * g * g + 1e-6) * g",
    "rmsprop": "-0.01 * g / sqrt(0.05 * g * g + 1e-8)",
}

# a second round from ZERO_ROUND, rate 0.5, L2 0.01
_D2 = (f"SELECT vec_id, j, p - CASE WHEN label = j THEN 1 ELSE 0 END AS d FROM ({_softmax(_logits(X, ZERO_ROUND))})")
_XD2 = f"SELECT x.vec_id, x.worker, x.i, x.v, d.j, d.d FROM ({_exploded_rows('true')}) x JOIN ({_D2}) d ON d.vec_id = x.vec_id"
WARM_ROUND = (
    f"SELECT m.param, m.i, m.j, m.v - 0.5 * (avg(g.g) + CASE WHEN m.param = 'W' THEN 0.01 * m.v ELSE 0 END) AS v "
    f"FROM ({ZERO_ROUND}) m JOIN (SELECT 'W' AS param, worker, i, j, avg(v * d) AS g FROM ({_XD2}) GROUP BY worker, i, j "
    f"UNION ALL SELECT 'b' AS param, worker, 0 AS i, j, avg(d) AS g FROM ({_XD2}) WHERE i = 0 GROUP BY worker, j) g "
    "ON g.param = m.param AND g.i = m.i AND g.j = m.j GROUP BY m.param, m.i, m.j, m.v")

# metrics on train and valid after one round on the train split
_TRAIN = "pos >= 110"
_SPLITS = (f"SELECT x.*, CASE WHEN p.pos < 50 THEN 'valid' ELSE 'train' END AS split FROM ({X}) x "
           f"JOIN ({POS}) p ON p.vec_id = x.vec_id WHERE p.pos < 50 OR p.pos >= 110")


def _history(models: str, l2: float) -> str:
    """Metrics of every epoch's weights (epoch, param, i, j, v) on the train and valid rows."""
    one = f"SELECT DISTINCT epoch FROM ({models})"
    x = f"SELECT x.vec_id, x.label, x.split, x.i, x.v, e.epoch FROM ({_SPLITS}) x, ({one}) e"
    z = (f"SELECT x.epoch, x.split, x.vec_id, x.label, w.j, sum(x.v * w.v) + max(b.v) AS z FROM ({x}) x "
         f"JOIN (SELECT * FROM ({models}) WHERE param = 'W') w ON w.i = x.i AND w.epoch = x.epoch "
         f"JOIN (SELECT * FROM ({models}) WHERE param = 'b') b ON b.j = w.j AND b.epoch = x.epoch GROUP BY ALL")
    q = (f"SELECT *, e / sum(e) OVER (PARTITION BY epoch, vec_id) AS p, row_number() OVER (PARTITION BY epoch, vec_id ORDER BY z DESC, j) AS rk "
         f"FROM (SELECT *, exp(z - max(z) OVER (PARTITION BY epoch, vec_id)) AS e FROM ({z}))")
    pred = (f"SELECT epoch, split, vec_id, label, max(CASE WHEN rk = 1 THEN j END) AS pred, "
            f"max(CASE WHEN j = label THEN -ln(p) END) AS nll FROM ({q}) GROUP BY ALL")
    classes = (f"SELECT epoch, split, cls, sum(tp) AS tp, sum(predicted) AS predicted, sum(actual) AS actual FROM ("
               f"SELECT epoch, split, label AS cls, CASE WHEN label = pred THEN 1 ELSE 0 END AS tp, 0 AS predicted, 1 AS actual FROM preds "
               f"UNION ALL SELECT epoch, split, pred AS cls, 0 AS tp, 1 AS predicted, 0 AS actual FROM preds) GROUP BY ALL")
    penalty = f"SELECT epoch, 0.5 * {l2} * sum(v * v) AS penalty FROM ({models}) WHERE param = 'W' GROUP BY epoch"
    return (
        f"WITH preds AS MATERIALIZED ({pred}) "
        f"SELECT CAST(a.epoch AS INTEGER) AS epoch, a.split, a.n, {rnd('a.loss')} AS loss, {rnd('a.accuracy')} AS accuracy, "
        f"{rnd('c.precision')} AS precision, {rnd('c.recall')} AS recall, {rnd('p.penalty')} AS l2_penalty "
        f"FROM (SELECT epoch, split, count(*) AS n, avg(nll) AS loss, avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) AS accuracy "
        f"FROM preds GROUP BY ALL) a JOIN (SELECT epoch, split, avg(tp / nullif(predicted, 0)) AS precision, "
        f"avg(tp / nullif(actual, 0)) AS recall FROM ({classes}) GROUP BY ALL) c ON c.split = a.split AND c.epoch = a.epoch "
        f"JOIN ({penalty}) p ON p.epoch = a.epoch")


HISTORY = _history(f"SELECT 0 AS epoch, * FROM ({_zero_round(_TRAIN)})", 0.05)

_MOM = "SELECT i, avg(v) AS mean, var_pop(v) AS var FROM ({X}) GROUP BY i".replace("{X}", X)

_H = f"SELECT vec_id, label, j AS i, greatest(z, 0.0) AS v FROM ({_dense(X, 64, 16)})"
P2 = _softmax(_dense(_H, 16, 10))  # two-stage chain probabilities

SPLIT = "CASE WHEN pos < 50 THEN 'valid' WHEN pos < 110 THEN 'test' ELSE 'train' END"

_SCHED = ("SELECT CAST(split_part(pair, ',', 1) AS INTEGER) AS iteration, "
          "max_by(CAST(split_part(pair, ',', 2) AS DOUBLE), ord) AS rate FROM ("
          "SELECT unnest(string_split(t, '|')) AS pair, unnest(range(len(string_split(t, '|')))) AS ord "
          "FROM (SELECT '0,0.1|3,0.01|3,0.05|7,0.001' AS t)) GROUP BY 1")

_PX = ("SELECT vec_id, label, k, CAST(least(greatest(floor((x + 0.5) * 256), 0), 255) AS BIGINT) AS p FROM "
       "(SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(len(embedding))) AS k "
       "FROM embeddings)")

# the 8 x 8 pixels doubled to 16 x 16, three colours each, in reading order
_TENSOR = (f"SELECT x.vec_id, x.label, x.p, t.range AS t FROM ({_PX}) x JOIN range(768) t "
           "ON x.k = (t.range // 3 // 16 // 2) * 8 + (t.range // 3 % 16) // 2")
_ALL_SPLITS = f"SELECT x.vec_id, x.label, x.i, x.v, {SPLIT} AS split FROM ({X}) x JOIN ({POS}) p ON p.vec_id = x.vec_id"

ORACLES.update({
    "param_average": (f"SELECT param, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, {rnd('v')} AS value "
                      f"FROM ({ZERO_ROUND})"),
    "model_roundtrip": (f"SELECT param, CAST(i AS INTEGER) AS row, CAST(count(*) AS INTEGER) AS n, "
                        f"{rnd('sum(v)')} AS s FROM ({ZERO_ROUND}) GROUP BY param, i"),
    "model_scan_layers": (f"SELECT param, CAST(i AS INTEGER) AS row, CAST(count(*) AS INTEGER) AS n, "
                          f"{rnd('sum(v)')} AS s FROM ({ZERO_ROUND}) GROUP BY param, i"),
    "l2_penalty": f"SELECT {rnd('0.5 * 0.05 * sum(v * v)')} AS penalty FROM ({ZERO_ROUND}) WHERE param = 'W'",
    "lr_schedule_asof": (f"SELECT r.vec_id, r.iteration, coalesce(s.rate, 0.001) AS rate FROM "
                         f"(SELECT vec_id, CAST(pos // 8 AS INTEGER) AS iteration FROM ({POS})) r "
                         f"ASOF LEFT JOIN ({_SCHED}) s ON r.iteration >= s.iteration"),
    "feature_moments": (f"SELECT CAST(i AS INTEGER) AS i, {rnd('mean')} AS mean, {rnd('var')} AS var "
                        f"FROM ({_MOM})"),
    "batchnorm_apply": (f"SELECT x.vec_id, CAST(x.i AS INTEGER) AS j, "
                        f"{rnd('(x.v - m.mean) / sqrt(m.var + 1e-5)')} AS value "
                        f"FROM ({X}) x JOIN ({_MOM}) m ON m.i = x.i"),
    "featurize_stage2": _exploded(P2, "p"),
    "feature_table_roundtrip": (
        f"SELECT e.vec_id, e.label, {SPLIT} AS split, "
        f"{rnd('list_sum(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE)))')} AS s "
        f"FROM embeddings e JOIN ({POS}) p ON p.vec_id = e.vec_id"),
    "scan_splits": f"SELECT e.vec_id, e.label, {SPLIT} AS split FROM embeddings e JOIN ({POS}) p ON p.vec_id = e.vec_id",
    "featurize_rejects": (
        "SELECT count(*) + count(*) FILTER (vec_id % 100 = 0) AS files, count(*) FILTER (vec_id % 100 = 0) AS bad_images, "
        "count(*) FILTER (vec_id % 10 = 3) AS bad_paths, count(*) FILTER (vec_id % 10 <> 3) AS written, "
        "CAST(sum(label) FILTER (vec_id % 10 <> 3) AS BIGINT) AS labels FROM embeddings"),
    "scan_binary": ("SELECT label, CAST(sum(len(CAST(vec_id AS VARCHAR)) + 1) AS BIGINT) AS bytes FROM embeddings GROUP BY label"),
    "scan_image": (f"SELECT x.vec_id, x.label, {SPLIT} AS split, CAST(8 AS INTEGER) AS height, "
                   f"CAST(8 AS INTEGER) AS width, CAST(3 AS INTEGER) AS n_channels, "
                   f"CAST(max(CASE WHEN x.t = 0 THEN x.p END) AS INTEGER) AS first_red, "
                   f"md5(string_agg(CAST(CASE x.t % 3 WHEN 0 THEN x.p WHEN 1 THEN x.p // 2 ELSE 25 * x.label END AS VARCHAR), "
                   f"',' ORDER BY x.t)) AS pixels "
                   f"FROM ({_TENSOR}) x JOIN ({POS}) p ON p.vec_id = x.vec_id GROUP BY x.vec_id, x.label, p.pos"),
    "train_updaters": " UNION ALL ".join(
        f"SELECT param, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, {rnd('v')} AS value, '{u}' AS updater "
        f"FROM ({_zero_round('true', step)})" for u, step in FIRST_STEPS.items()),
    "train_history": HISTORY,
    "train_warm_start": (f"SELECT param, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, {rnd('v')} AS value "
                         f"FROM ({WARM_ROUND})"),
    "ml_baseline": (
        f"SELECT s.split, s.label, count(DISTINCT s.vec_id) AS n, {rnd('sum(CASE WHEN s.i = 0 THEN s.x END)')} AS first, "
        f"{rnd('sum(s.x * s.x)')} AS squares FROM (SELECT a.vec_id, a.label, a.split, a.i, (a.v - m.mean) / m.sd AS x "
        f"FROM ({_ALL_SPLITS}) a JOIN (SELECT i, avg(v) AS mean, stddev_samp(v) AS sd FROM ({_ALL_SPLITS}) "
        f"WHERE split = 'train' GROUP BY i) m ON m.i = a.i) s GROUP BY s.split, s.label"),
})


# whole fits: mini-batches, averaging rounds, optimizer state, warm start, schedule
_SHAPE = {"workers": 4, "batch": 16, "freq": 2}
_TRAIN_POS = f"SELECT vec_id, row_number() OVER (ORDER BY pos) - 1 AS pos FROM ({POS}) WHERE {_TRAIN}"
_RATE_AT = "CASE WHEN it >= 7 THEN 0.001 WHEN it >= 3 THEN 0.05 ELSE 0.1 END"


def _last_weights(states: str, more: str = "") -> str:
    return (f"WITH m AS MATERIALIZED ({states}) SELECT param, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, {rnd('v')} AS value{more} "
            "FROM m WHERE epoch = (SELECT max(epoch) FROM m)")


ORACLES.update({
    "fit_minibatch": " UNION ALL ".join(
        f"SELECT * FROM ({_last_weights(fit_states(POS, u, [Phase(1, '0.01', 0.01)], **_SHAPE), f", '{u}' AS updater")})" for u in RULES),
    "fit_warm_state": _last_weights(fit_states(POS, "adam", [Phase(1, "0.01"), Phase(2, _RATE_AT, 0.01)], **_SHAPE)),
    "fit_minibatch_history": (f"WITH models AS MATERIALIZED ({fit_states(_TRAIN_POS, 'nesterovs', [Phase(2, '0.05', 0.05)], **_SHAPE)}) "
                              f"SELECT * FROM ({_history('SELECT * FROM models', 0.05)})"),
})


def _mix_steps(src: str, cols: str) -> str:
    """Apply the 32-bit mixer to column ``x`` of ``src`` as nested selects."""
    for _ in range(2):
        src = f"SELECT {cols}, (xor(x >> 16, x) * 73244475) & 4294967295 AS x FROM ({src})"
    return f"SELECT {cols}, xor(x >> 16, x) AS x FROM ({src})"


def _dropout_sql(keep: float, seed: int, step: int) -> str:
    cols = "vec_id, i"
    s = (f"SELECT vec_id, CAST(i AS INTEGER) AS i, CAST(({seed} * 65537 + {step}) % 4294967296 AS BIGINT) AS x "
         f"FROM (SELECT vec_id, unnest(range(len(embedding))) AS i FROM embeddings)")
    s = _mix_steps(s, cols)
    s = _mix_steps(f"SELECT {cols}, xor(x, vec_id & 4294967295) AS x FROM ({s})", cols)
    s = _mix_steps(f"SELECT {cols}, xor(x, (vec_id >> 32) & 4294967295) AS x FROM ({s})", cols)
    s = _mix_steps(f"SELECT {cols}, xor(x, CAST(i AS BIGINT)) AS x FROM ({s})", cols)
    return f"SELECT vec_id, i, x < {int(keep * 4294967296)} AS kept FROM ({s})"


ORACLES["dropout_mask"] = _dropout_sql(0.9, 42, 0)

# the fc2 head from zero softmax weights: masked inputs, each worker's batch moments, one step
_MASKED = (f"SELECT x.worker, x.vec_id, x.label, x.i, CASE WHEN m.kept THEN x.v / 0.9 ELSE 0 END AS v FROM ({_exploded_rows('true')}) x "
           f"JOIN ({_dropout_sql(0.9, 42, 0)}) m ON m.vec_id = x.vec_id AND m.i = x.i")
_WORKER_MOMENTS = "SELECT worker, i, avg(v) AS mean, var_pop(v) AS var FROM masked GROUP BY worker, i"
_D0 = "0.1 - CASE WHEN label = j THEN 1 ELSE 0 END"
ORACLES["fc2_batchnorm_round"] = (
    f"WITH masked AS MATERIALIZED ({_MASKED}), mom AS MATERIALIZED ({_WORKER_MOMENTS}), "
    "xhat AS MATERIALIZED (SELECT x.worker, x.label, x.i, (x.v - m.mean) / sqrt(m.var + 1e-5) AS v FROM masked x JOIN mom m ON m.worker = x.worker AND m.i = x.i), "
    f"w AS (SELECT i, j, avg(g) AS g FROM (SELECT worker, i, j, avg(v * ({_D0})) AS g FROM (SELECT *, unnest(range(10)) AS j FROM xhat) GROUP BY worker, i, j) GROUP BY i, j), "
    f"b AS (SELECT j, avg(g) AS g FROM (SELECT worker, j, avg({_D0}) AS g FROM (SELECT *, unnest(range(10)) AS j FROM xhat WHERE i = 0) GROUP BY worker, j) GROUP BY j), "
    "p AS (SELECT 'W' AS param, i, j, -g AS v FROM w UNION ALL SELECT 'b', 0, j, -g FROM b "
    "UNION ALL SELECT 'gamma', 0, i, 1.0 FROM mom GROUP BY i UNION ALL SELECT 'beta', 0, i, 0.0 FROM mom GROUP BY i "
    "UNION ALL SELECT 'mean', 0, i, 0.1 * avg(mean) FROM mom GROUP BY i UNION ALL SELECT 'var', 0, i, 0.9 + 0.1 * avg(var) FROM mom GROUP BY i) "
    f"SELECT param, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, {rnd('v')} AS value FROM p")
ORACLES["ml_optimality"] = f"SELECT label, count(*) AS n, true AS optimal FROM ({_ALL_SPLITS}) WHERE split = 'train' AND i = 0 GROUP BY label"
ORACLES["lr_schedule_parse"] = (
    "SELECT vec_id, CAST(iteration AS INTEGER) AS iteration, max_by(rate, n) AS rate FROM ("
    "SELECT vec_id, 0 AS n, 0 AS iteration, CAST(0.1 AS DOUBLE) AS rate FROM embeddings "
    "UNION ALL SELECT vec_id, 1, vec_id % 7, CAST(label + 1 AS DOUBLE) / 8 FROM embeddings "
    "UNION ALL SELECT vec_id, 2, vec_id % 5, CAST(0.05 AS DOUBLE) FROM embeddings "
    "UNION ALL SELECT vec_id, 3, 10 + vec_id, CAST(0.001 AS DOUBLE) FROM embeddings) GROUP BY vec_id, iteration")
