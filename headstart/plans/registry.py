"""The registered queries: one per operator of the inventory, each over the whole table.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose columns are named
exactly like the matching oracle SQL in :mod:`headstart.plans.oracle`. Floating values
are rounded to 6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.random import dropout_mask
from ..model import Model, dense, head, init_params, initial_preset
from ..operators import evaluation as E
from ..operators import ordering as O
from ..operators.schedule import parse_schedule, parse_schedules, rate_asof, schedule_frame
from ..operators.scoring import predict, score
from ..operators.stats import batchnorm_from_moments, feature_moments, moments_long
from ..operators.training import (HISTORY_SCHEMA, UPDATERS, FitParams, evaluate_splits, fit, fit_all, full_batch_round, init_state,
                                  l2_penalty, prepare_layout, read_history)
from ..session import remove_path, scratch_path
from ..sources.features import read_features, read_split_folders, write_features, write_split_folders
from ..sources.files import scan_binary, scan_images, to_tensor, with_split_from_path
from ..sources.models import model_to_df, read_model, write_model
from . import derived_images as DI
from . import fixtures as FX
from .derived_images import write_images
from .programs import featurize_images

R = 6  # rounding places for floating outputs


def _rnd(c):
    """Round to 6 places and turn -0.0 into 0.0."""
    return F.round(c, R) + F.lit(0.0)


def _emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_features(spark, f"{sf_dir}/embeddings.parquet", features="embedding",
                         label="label", columns=["vec_id"])


def _exploded(df: DataFrame, col: str = "output") -> DataFrame:
    return df.select("vec_id", F.posexplode(col).alias("j", "v")) \
        .select("vec_id", "j", _rnd(F.col("v")).alias("value"))


def q_scan_features(spark, sf_dir):
    return _emb(spark, sf_dir).select("vec_id", "label", F.size("embedding").alias("dim"))


def _predicted(spark, sf_dir, keep=("label",)):
    """Scored rows; only ``keep`` columns cross the Python boundary (no pruning through it)."""
    return predict(_emb(spark, sf_dir), FX.one_layer(), features="embedding", label="label",
                   keep=list(keep))


def q_predict(spark, sf_dir):
    return _predicted(spark, sf_dir, ("vec_id", "label")).select("vec_id", "label", "pred", _rnd(F.col("prob")).alias("prob"),
                                            _rnd(F.col("nll")).alias("nll"))


def _conf(spark, sf_dir):
    return E.confusion(_predicted(spark, sf_dir), nll="nll")


def q_confusion_matrix(spark, sf_dir):
    return _conf(spark, sf_dir).select("label", "pred", "n")


def q_accuracy(spark, sf_dir):
    return E.accuracy(_conf(spark, sf_dir)).select(_rnd(F.col("accuracy")).alias("accuracy"))


def q_per_class_stats(spark, sf_dir):
    return E.per_class_stats(_conf(spark, sf_dir)).select(
        "cls", "tp", "predicted", "actual",
        _rnd(F.col("precision")).alias("precision"), _rnd(F.col("recall")).alias("recall"))


def q_macro_precision_recall(spark, sf_dir):
    return E.macro_precision_recall(_conf(spark, sf_dir)).select(
        _rnd(F.col("precision")).alias("precision"), _rnd(F.col("recall")).alias("recall"))


def q_mean_nll(spark, sf_dir):
    return E.mean_loss(_predicted(spark, sf_dir)).select(_rnd(F.col("loss")).alias("loss"))


def q_evaluate(spark, sf_dir):
    return E.evaluate(_predicted(spark, sf_dir)).select(
        "n", *[_rnd(F.col(c)).alias(c) for c in ("accuracy", "precision", "recall", "loss")])


def q_dense_layer(spark, sf_dir):
    return _exploded(score(_emb(spark, sf_dir), FX.dense_only(), features="embedding", keep=["vec_id"]))


def q_relu_layer(spark, sf_dir):
    return _exploded(score(_emb(spark, sf_dir), FX.dense_only(activation="relu"),
                           features="embedding", keep=["vec_id"]))


def q_softmax_probs(spark, sf_dir):
    return _exploded(score(_emb(spark, sf_dir), FX.one_layer(), features="embedding", keep=["vec_id"]))


def q_featurize_upto(spark, sf_dir):
    return _exploded(score(_emb(spark, sf_dir), FX.two_stage().upto("fc1"), features="embedding",
                           keep=["vec_id"]))


def q_onehot_encode(spark, sf_dir):
    hot = _emb(spark, sf_dir).select("vec_id", L.onehot_encode(F.col("label"), FX.N_CLASSES).alias("y"))
    return hot.select("vec_id", F.size("y").alias("n"),
                      (F.array_position("y", F.lit(1.0).cast("float")) - 1).cast("int").alias("hot"),
                      _rnd(F.aggregate("y", F.lit(0.0), lambda a, x: a + x)).alias("total"))


def q_onehot_decode(spark, sf_dir):
    hot = _emb(spark, sf_dir).select("vec_id", L.onehot_encode(F.col("label"), FX.N_CLASSES).alias("y"))
    return hot.select("vec_id", L.onehot_decode("y").alias("label"))


def q_ml_bridge(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    pts = L.to_labeled_points(_emb(spark, sf_dir), features="embedding", keep=("vec_id",))
    arr = vector_to_array(F.col("features"))
    return pts.select("vec_id", "label",
                      _rnd(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x * x)).alias("sq_norm"))


def _paths(spark, sf_dir):
    df = _emb(spark, sf_dir)
    d3 = F.lpad((F.col("label") + 1).cast("string"), 3, "0")
    d4 = F.lpad(F.pmod(F.col("vec_id"), F.lit(10000)).cast("string"), 4, "0")
    split = F.when(F.pmod(F.col("vec_id"), F.lit(5)) == 0, "valid").otherwise("train")
    hi = F.floor(F.col("vec_id") / 10000).cast("string")  # a folder level keeps names apart at any id
    path = F.concat(F.lit("/img/"), split, F.lit("/"), d3, F.lit(".c"), hi, F.lit("/"), d3, F.lit("_"), d4, F.lit(".jpg"))
    return df.select("vec_id", path.alias("path"))


def q_label_from_path(spark, sf_dir):
    return _paths(spark, sf_dir).select("vec_id", "path", L.checked_path_label("path").alias("label"))


def _spoiled(spark, sf_dir):
    p = _paths(spark, sf_dir)
    kind = F.pmod((F.col("vec_id") / 10).cast("long"), F.lit(4))
    bad = (F.when(kind == 0, F.concat("path", F.lit(".bak")))
           .when(kind == 1, F.regexp_replace("path", "/", ""))
           .when(kind == 2, F.regexp_replace("path", r"\d{3}_(\d{4})\.jpg$", "000_$1.jpg"))
           .otherwise(F.regexp_replace("path", r"/\d(\d{2})_(\d{4})\.jpg$", "/$1_$2.jpg")))
    return p.select("vec_id", F.when(F.pmod(F.col("vec_id"), F.lit(10)) == 0, bad)
                    .otherwise(F.col("path")).alias("path"))


def q_label_from_path_reject(spark, sf_dir):
    p = _spoiled(spark, sf_dir)
    ok = L.path_is_valid("path", FX.N_CLASSES)
    return p.agg(F.sum(F.when(ok, 1).otherwise(0)).cast("bigint").alias("good"),
                 F.sum(F.when(ok, 0).otherwise(1)).cast("bigint").alias("bad"))


def q_shuffle_order(spark, sf_dir):
    o = O.shuffle_order(_emb(spark, sf_dir).select("vec_id"), "vec_id", FX.SEED)
    return o.select("vec_id", F.col(O.KEY).alias("order_key"))


def _positioned(spark, sf_dir):
    return O.with_position(_emb(spark, sf_dir).select("vec_id", "label"), "vec_id", FX.SEED)


def q_shuffle_position(spark, sf_dir):
    return _positioned(spark, sf_dir).select("vec_id", "pos")


def q_split_fixed(spark, sf_dir):
    return O.split_fixed(_positioned(spark, sf_dir), 50, 60).select("vec_id", "split")


def q_minibatch_assign(spark, sf_dir):
    return O.assign_minibatches(_positioned(spark, sf_dir), 4, 8, 5).select(
        "vec_id", "round", "worker", "batch")


def q_dropout_mask(spark, sf_dir):
    mask = dropout_mask("vec_id", FX.WIDTH, 0.9, FX.SEED, 0)  # hashes the row once
    return _emb(spark, sf_dir).select("vec_id", F.posexplode(mask).alias("i", "kept"))


WORKERS = 4


def _zeros():
    return init_params([dense("predictions", FX.WIDTH, FX.N_CLASSES, "softmax")], scheme="zeros")


def _with_worker(df):
    """``worker`` 0 to 3: quarters of the seeded order, whatever the table's size."""
    n = max(1, df.count())
    return O.with_position(df, "vec_id", FX.SEED).withColumn("worker", F.expr(f"int((pos * {WORKERS}) div {n})"))


def _full_round(df, model, p, it=0, state=None):
    """One averaging round: every worker takes one step on all its rows, then the mean."""
    state = init_state(model, p.updater) if state is None else state
    return full_batch_round(df, model, state, p, it, features="embedding", label="label")[0]


SGD = FitParams(rate=1.0, updater="sgd", seed=FX.SEED)


def _zero_one_round(spark, sf_dir):
    """One round over the whole table from zero weights (plain SGD, rate 1)."""
    return _full_round(_with_worker(_emb(spark, sf_dir)), _zeros(), SGD)


def _model_long(spark, model):
    return model_to_df(spark, model).filter("param <> ''") \
        .select("param", F.col("row").alias("i"), F.posexplode("values").alias("j", "v")) \
        .select("param", "i", "j", _rnd(F.col("v")).alias("value"))


def q_param_average(spark, sf_dir):
    return _model_long(spark, _zero_one_round(spark, sf_dir))


def q_model_roundtrip(spark, sf_dir):
    model = _zero_one_round(spark, sf_dir)
    path = scratch_path(spark, "model")
    write_model(spark, model, path, meta={"iterations": 1})
    back, _, _ = read_model(spark, path)
    remove_path(spark, path)
    table = model_to_df(spark, back)
    return table.select("param", "row", F.size("values").alias("n"),
                        _rnd(F.aggregate("values", F.lit(0.0), lambda acc, x: acc + x)).alias("s"))


def q_model_scan_layers(spark, sf_dir):
    """The trained layer alone, read from the table of a chain with a dense layer before it."""
    model = _zero_one_round(spark, sf_dir)
    first = init_params([dense("fc1", model.n_in, model.n_in, "relu")], seed=1)
    chain = Model((*first.layers, *model.layers), {**first.params, **model.params})
    path = scratch_path(spark, "model")
    write_model(spark, chain, path)
    back, _, _ = read_model(spark, path, after="fc1")
    remove_path(spark, path)
    return model_to_df(spark, back).select("param", "row", F.size("values").alias("n"),
                                           _rnd(F.aggregate("values", F.lit(0.0), lambda acc, x: acc + x)).alias("s"))


def q_l2_penalty(spark, sf_dir):
    weights = model_to_df(spark, _zero_one_round(spark, sf_dir)).filter("param = 'W'").select(F.explode("values").alias("w"))
    return weights.agg(_rnd(F.lit(0.5 * 0.05) * F.sum(F.col("w") * F.col("w"))).alias("penalty"))


SCHEDULE_TEXT = "0,0.1|3,0.01|3,0.05|7,0.001"


def q_lr_schedule_asof(spark, sf_dir):
    it = (F.col("pos") / 8).cast("long").cast("int")
    return rate_asof(_positioned(spark, sf_dir).select("vec_id", it.alias("iteration")), schedule_frame(spark, SCHEDULE_TEXT), base=0.001)


def q_lr_schedule_parse(spark, sf_dir):
    """Schedules as a column: one text for each row, with duplicate iterations in most."""
    text = F.expr("concat('0,0.1|', vec_id % 7, ',', (label + 1) / 8.0D, '|', vec_id % 5, ',0.05|', 10 + vec_id, ',0.001')")
    return parse_schedules(_emb(spark, sf_dir).select("vec_id", text.alias("text")), "text", "vec_id")


def _moments(spark, sf_dir):
    return feature_moments(_emb(spark, sf_dir), features="embedding")


def q_feature_moments(spark, sf_dir):
    return moments_long(_moments(spark, sf_dir)).select(
        "i", _rnd(F.col("mean")).alias("mean"), _rnd(F.col("var")).alias("var"))


def q_batchnorm_apply(spark, sf_dir):
    bn = batchnorm_from_moments(_moments(spark, sf_dir))
    out = score(_emb(spark, sf_dir), bn, features="embedding", keep=["vec_id"])
    return out.select("vec_id", F.posexplode("output").alias("j", "v")) \
        .select("vec_id", "j", _rnd(F.col("v")).alias("value"))


def q_featurize_stage2(spark, sf_dir):
    chain = FX.two_stage()
    stage1 = scratch_path(spark, "stage1")
    stage2 = scratch_path(spark, "stage2")
    s1 = score(_emb(spark, sf_dir), chain.upto("fc1"), features="embedding", output="features",
               keep=["vec_id", "label"])
    write_features(s1, stage1, split=None)
    s2 = score(read_features(spark, stage1, features="features", columns=["vec_id"]), chain.after("fc1"),
               features="features", output="features", keep=["vec_id", "label"])
    write_features(s2, stage2, split=None)
    out = read_features(spark, stage2, features="features", columns=["vec_id"])
    return _exploded(out, "features")


def _with_split(spark, sf_dir):
    return O.split_fixed(O.with_position(_emb(spark, sf_dir), "vec_id", FX.SEED), 50, 60).drop("pos")


def q_feature_table_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "features")
    write_features(_with_split(spark, sf_dir), path)
    back = spark.read.parquet(path)
    return back.select("vec_id", "label", "split",
                       _rnd(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))).alias("s"))


def q_scan_splits(spark, sf_dir):
    root = scratch_path(spark, "split-folders")
    write_split_folders(_with_split(spark, sf_dir), root)  # one plain folder per split
    back = read_split_folders(spark, root)
    return back.select("vec_id", "label", "split")


def q_scan_binary(spark, sf_dir):
    """Files below a folder tree, by name and length (the content column is never read)."""
    root = scratch_path(spark, "binary")
    _emb(spark, sf_dir).select(F.col("vec_id").cast("string").alias("value"), "label") \
        .write.partitionBy("label").text(root)
    files = scan_binary(spark, root)
    return files.groupBy(F.regexp_extract("path", r"/label=(\d+)/[^/]+$", 1).cast("int").alias("label")) \
        .agg(F.sum("length").alias("bytes"))


def _image_root(spark, sf_dir):
    root = scratch_path(spark, "images")
    write_images(_with_split(spark, sf_dir), root)
    return root


IMAGE_ID = r"\.c(\d+)/\d{3}_(\d{4})\.jpg$"


def q_scan_image(spark, sf_dir):
    imgs = with_split_from_path(scan_images(spark, _image_root(spark, sf_dir)))
    imgs = imgs.withColumn("label", L.checked_path_label("path", FX.N_CLASSES)) \
        .withColumn("vec_id", F.regexp_extract("path", IMAGE_ID, 1).cast("long") * 10000
                    + F.regexp_extract("path", IMAGE_ID, 2).cast("long"))
    t = to_tensor(imgs, height=2 * DI.SIDE, width=2 * DI.SIDE, keep=["vec_id", "label", "split", "height",
                                                                    "width", "n_channels"])
    return t.select("vec_id", "label", "split", "height", "width", "n_channels",
                    F.col("features")[0].cast("int").alias("first_red"),
                    F.md5(F.array_join(F.transform("features", lambda x: x.cast("int").cast("string")), ",")).alias("pixels"))


def q_featurize_rejects(spark, sf_dir):
    """Every row as an image, a tenth of them in folders of unknown classes, and for each hundredth
    id a file that is no image: the counts of one featurization and the rows that it wrote."""
    root, out = scratch_path(spark, "images"), scratch_path(spark, "features")
    df = _with_split(spark, sf_dir)
    unknown = F.when(F.pmod(F.col("vec_id"), F.lit(10)) == 3, F.col("label") + 500).otherwise(F.col("label"))
    write_images(df.withColumn("label", unknown), root)
    df.filter(F.pmod(F.col("vec_id"), F.lit(100)) == 0).select("vec_id", F.lit("no image").alias("value")) \
        .write.partitionBy("vec_id").text(f"{root}/train/notes")
    chain = init_params([dense("fc1", 3 * DI.SIDE ** 2, 4, "relu")], scheme="fixture")
    seen = featurize_images(spark, root, out, n_classes=FX.N_CLASSES, model=chain, output_layer="fc1", height=DI.SIDE,
                            width=DI.SIDE, on_bad="drop", split_folders=True)
    written = read_split_folders(spark, out).agg(F.count("*").alias("n"), F.sum("label").alias("labels")).first()
    for p in (root, out):
        remove_path(spark, p)
    return spark.createDataFrame([(seen["files"], seen["bad_images"], seen["bad_paths"], written.n, written.labels)],
                                 "files long, bad_images long, bad_paths long, written long, labels long")


def _history_row(h):
    return h.select("epoch", "split", "n", *[_rnd(F.col(c)).alias(c) for c in
                                             ("loss", "accuracy", "precision", "recall", "l2_penalty")])


def _train_valid(spark, sf_dir):
    df = _with_split(spark, sf_dir)
    return df.filter(F.col("split") == "train"), df.filter(F.col("split") == "valid")


def q_train_history(spark, sf_dir):
    """One full round on the train split from zero weights, then the history rows."""
    train, valid = _train_valid(spark, sf_dir)
    p = SGD.replace(l2=0.05)
    model = _full_round(_with_worker(train), _zeros(), p)
    metrics = evaluate_splits({"train": train, "valid": valid}, model, features="embedding", label="label")
    rows = [(0, k, m["n"], m["loss"], m["accuracy"], m["precision"], m["recall"], l2_penalty(model, p.l2)) for k, m in metrics.items()]
    return _history_row(spark.createDataFrame(rows, HISTORY_SCHEMA))


def q_train_updaters(spark, sf_dir):
    """The weights after one step of each update rule from zero weights and zero state."""
    df, out = _with_worker(_emb(spark, sf_dir)), None
    for u in UPDATERS:
        model = _full_round(df, _zeros(), FitParams(rate=0.01, updater=u, seed=FX.SEED))
        part = _model_long(spark, model).withColumn("updater", F.lit(u))
        out = part if out is None else out.unionByName(part)
    return out


def q_train_warm_start(spark, sf_dir):
    """A second round from a saved model, with another rate and L2."""
    df = _with_worker(_emb(spark, sf_dir))
    path = scratch_path(spark, "warm-model")
    write_model(spark, _full_round(df, _zeros(), SGD), path, meta={"iterations": 1})
    model, state, meta = read_model(spark, path)
    remove_path(spark, path)
    return _model_long(spark, _full_round(df, model, SGD.replace(rate=0.5, l2=0.01), int(meta["iterations"])))


def q_fit_history(spark, sf_dir):
    train, valid = _train_valid(spark, sf_dir)
    model = init_params(head("fc2", FX.WIDTH, FX.N_CLASSES, keep_prob=0.9), seed=FX.SEED)
    p = FitParams(epochs=4, workers=4, batch_size=32, avg_freq=5, rate=0.01, momentum=0.9, l2=0.05,
                  updater="nesterovs", eval_interval=2, seed=FX.SEED)
    res = fit(train, model, p, id_col="vec_id", features="embedding", valid=valid)
    return _history_row(res.history_df(spark))


def q_fit_updaters(spark, sf_dir):
    train, valid = _train_valid(spark, sf_dir)
    frames = []
    base = FitParams(epochs=1, workers=4, batch_size=16, avg_freq=2, rate=0.01, eval_interval=1, seed=FX.SEED)
    layout = prepare_layout(train, base, id_col="vec_id", features="embedding", width=FX.WIDTH)  # shared by the sweep
    model = init_params(head("predictions", FX.WIDTH, FX.N_CLASSES), seed=FX.SEED)
    found = fit_all(spark, [lambda u=u: fit(train, model, base.replace(updater=u), id_col="vec_id", features="embedding", valid=valid,
                                            layout=layout) for u in UPDATERS])
    for u, res in zip(UPDATERS, found):
        frames.append(_history_row(res.history_df(spark)).withColumn("updater", F.lit(u)))
    layout.release()
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def q_fit_warm_start(spark, sf_dir):
    train, valid = _train_valid(spark, sf_dir)
    pre = initial_preset("fc2", FX.WIDTH, FX.N_CLASSES)
    first = fit(train, init_params(pre.layers, seed=pre.seed),
                FitParams(epochs=1, rate=pre.rate, momentum=pre.momentum, l2=pre.l2, eval_interval=1),
                id_col="vec_id", features="embedding", valid=valid)
    path = scratch_path(spark, "warm-model")
    write_model(spark, first.model, path, state=first.state, meta=first.meta())
    model, state, meta = read_model(spark, path)
    remove_path(spark, path)
    p = FitParams(epochs=2, rate=0.01, schedule=parse_schedule(SCHEDULE_TEXT), updater="nesterovs",
                  momentum=0.9, l2=0.01, eval_interval=1, seed=7)
    res = fit(train, model, p, id_col="vec_id", features="embedding", valid=valid, state=state,
              iterations=int(meta["iterations"]), updater_steps=int(meta["updater_steps"]))
    return _history_row(res.history_df(spark)).withColumn("iterations", F.lit(res.iterations))


MINIBATCH = FitParams(epochs=1, workers=4, batch_size=16, avg_freq=2, rate=0.01, l2=0.01, eval_interval=1, seed=FX.SEED)


def q_fit_minibatch(spark, sf_dir):
    """An epoch of mini-batch rounds over the whole table with every updater: the averaged weights."""
    df, out = _emb(spark, sf_dir), None
    layout = prepare_layout(df, MINIBATCH, id_col="vec_id", features="embedding", width=FX.WIDTH)
    found = fit_all(spark, [lambda u=u: fit(df, _zeros(), MINIBATCH.replace(updater=u, eval_interval=2), id_col="vec_id", features="embedding",
                                            layout=layout) for u in UPDATERS])
    for u, res in zip(UPDATERS, found):
        part = _model_long(spark, res.model).withColumn("updater", F.lit(u))
        out = part if out is None else out.unionByName(part)
    layout.release()
    return out


def q_fit_warm_state(spark, sf_dir):
    """An epoch of Adam; model and state saved and loaded; two more epochs on a schedule, with L2."""
    df = _emb(spark, sf_dir)
    p = MINIBATCH.replace(updater="adam", l2=0.0, eval_interval=3)
    first = fit(df, _zeros(), p, id_col="vec_id", features="embedding")
    path = scratch_path(spark, "warm-model")
    write_model(spark, first.model, path, state=first.state, meta=first.meta())
    model, state, meta = read_model(spark, path)
    remove_path(spark, path)
    p = p.replace(epochs=2, l2=0.01, schedule=parse_schedule(SCHEDULE_TEXT))
    res = fit(df, model, p, id_col="vec_id", features="embedding", state=state, iterations=int(meta["iterations"]),
              updater_steps=int(meta["updater_steps"]))
    return _model_long(spark, res.model)


def q_fc2_batchnorm_round(spark, sf_dir):
    """One full round of the dropout → batch-norm → softmax head from zero softmax weights."""
    df = _with_worker(_emb(spark, sf_dir))
    model = init_params(head("fc2", FX.WIDTH, FX.N_CLASSES, keep_prob=0.9), scheme="zeros")
    new = full_batch_round(df, model, init_state(model, "sgd"), SGD, features="embedding", label="label", id_col="vec_id")[0]
    return _model_long(spark, new)


def q_ml_optimality(spark, sf_dir):
    """A certificate of the fitted classifier: its regularised gradient, by class, is next to nothing.

    The gradient comes from this engine's own full-batch round: a step of rate 1 is the gradient.
    """
    from pyspark.ml.functions import vector_to_array

    pts, fitted = _ml_points(spark, sf_dir)
    lr = fitted.stages[-1]
    rows = fitted.stages[0].transform(pts.filter(F.col("split") == "train")).select(
        F.col("label").cast("int").alias("label"), vector_to_array("scaled").alias("x"), F.lit(0).alias("worker"))
    model = init_params([dense("lr", FX.WIDTH, FX.N_CLASSES, "softmax")], scheme="zeros")
    model.params["lr/W"], model.params["lr/b"] = lr.coefficientMatrix.toArray().T.copy(), lr.interceptVector.toArray().copy()
    new = full_batch_round(rows, model, init_state(model, "sgd"), SGD.replace(l2=ML_REG), features="x", label="label")[0]
    away = [abs(model.params[k] - new.params[k]).reshape(-1, FX.N_CLASSES).max(axis=0) for k in ("lr/W", "lr/b")]
    largest = spark.createDataFrame([(j, float(max(a[j] for a in away))) for j in range(FX.N_CLASSES)], "label int, gradient double")
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).join(largest, "label") \
        .select("label", "n", (F.col("gradient") < OPTIMAL).alias("optimal"))


def q_fit_minibatch_history(spark, sf_dir):
    """The history of two epochs of mini-batch rounds on the train split, as the metrics sink holds it."""
    train, valid = _train_valid(spark, sf_dir)
    path = scratch_path(spark, "history")
    fit(train, _zeros(), MINIBATCH.replace(epochs=2, rate=0.05, l2=0.05, updater="nesterovs"), id_col="vec_id", features="embedding",
        valid=valid, history_path=path)
    rows = spark.createDataFrame(read_history(spark, path).collect(), HISTORY_SCHEMA)  # a row for each evaluation and split
    remove_path(spark, path)
    return _history_row(rows)


ML_REG = 0.01
#: Largest component of the regularised gradient at a classifier that counts as optimal.
OPTIMAL = 1e-3


def _ml_points(spark, sf_dir):
    """Labeled points with their split, checkpointed (the fit reads them many times), and the fitted pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler

    pts = L.to_labeled_points(_with_split(spark, sf_dir), features="embedding", keep=("vec_id", "split")).checkpoint(eager=True)
    pipe = Pipeline(stages=[StandardScaler(inputCol="features", outputCol="scaled", withMean=True),
                            LogisticRegression(featuresCol="scaled", labelCol="label", family="multinomial",
                                               maxIter=50, regParam=ML_REG)])
    return pts, pipe.fit(pts.filter(F.col("split") == "train"))


def q_ml_baseline(spark, sf_dir):
    """Rows and standardized features by split and class, as the classifier sees them."""
    from pyspark.ml.functions import vector_to_array

    pts, fitted = _ml_points(spark, sf_dir)
    scaled = fitted.transform(pts).select("split", F.col("label").cast("int").alias("label"),
                                          vector_to_array("scaled").alias("x"))
    return scaled.groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("n"), _rnd(F.sum(F.col("x")[0])).alias("first"),
        _rnd(F.sum(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))).alias("squares"))


def q_ml_accuracy(spark, sf_dir):
    pts, fitted = _ml_points(spark, sf_dir)
    pred = fitted.transform(pts).select("split", F.col("label").cast("int").alias("label"),
                                         F.col("prediction").cast("int").alias("pred"))
    return pred.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                     _rnd(F.avg((F.col("label") == F.col("pred")).cast("double"))).alias("accuracy"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_features": q_scan_features,
    "predict": q_predict,
    "confusion_matrix": q_confusion_matrix,
    "accuracy": q_accuracy,
    "per_class_stats": q_per_class_stats,
    "macro_precision_recall": q_macro_precision_recall,
    "mean_nll": q_mean_nll,
    "evaluate": q_evaluate,
    "dense_layer": q_dense_layer,
    "relu_layer": q_relu_layer,
    "softmax_probs": q_softmax_probs,
    "featurize_upto": q_featurize_upto,
    "onehot_encode": q_onehot_encode,
    "onehot_decode": q_onehot_decode,
    "ml_bridge": q_ml_bridge,
    "label_from_path": q_label_from_path,
    "label_from_path_reject": q_label_from_path_reject,
    "shuffle_order": q_shuffle_order,
    "shuffle_position": q_shuffle_position,
    "split_fixed": q_split_fixed,
    "minibatch_assign": q_minibatch_assign,
    "dropout_mask": q_dropout_mask,
    "param_average": q_param_average,
    "model_roundtrip": q_model_roundtrip,
    "model_scan_layers": q_model_scan_layers,
    "l2_penalty": q_l2_penalty,
    "lr_schedule_asof": q_lr_schedule_asof,
    "feature_moments": q_feature_moments,
    "batchnorm_apply": q_batchnorm_apply,
    "featurize_stage2": q_featurize_stage2,
    "feature_table_roundtrip": q_feature_table_roundtrip,
    "scan_splits": q_scan_splits,
    "featurize_rejects": q_featurize_rejects,
    "scan_binary": q_scan_binary,
    "scan_image": q_scan_image,
    "train_history": q_train_history,
    "train_updaters": q_train_updaters,
    "train_warm_start": q_train_warm_start,
    "ml_baseline": q_ml_baseline,
    "fit_history": q_fit_history,
    "fit_updaters": q_fit_updaters,
    "fit_warm_start": q_fit_warm_start,
    "ml_accuracy": q_ml_accuracy,
    "lr_schedule_parse": q_lr_schedule_parse,
    "fc2_batchnorm_round": q_fc2_batchnorm_round,
    "ml_optimality": q_ml_optimality,
    "fit_minibatch": q_fit_minibatch,
    "fit_warm_state": q_fit_warm_state,
    "fit_minibatch_history": q_fit_minibatch_history,
}
