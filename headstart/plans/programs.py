"""The reference's programs as plan functions (no command-line layer).

* :func:`featurize_images`   images → labels from paths → truncated model → feature table
* :func:`featurize_features` feature table → a slice of a model → new feature table
* :func:`train_head`         feature tables → classifier head → model table + history
* :func:`train_incrementally` saved model → more epochs with new settings → model table
* :func:`score_model`        saved model + feature table → one metrics row
* :func:`save_initial_model` preset head → model table

Arguments are checked before any job starts. Every step is a DataFrame plan; the only
driver-side data are the model, the metrics and the history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import onehot_encode, path_is_valid, with_path_label
from ..model import Model, head, init_params, initial_preset
from ..operators.evaluation import evaluate
from ..operators.scoring import BatchFn, featurize, layer_chain, broadcast_model, predict
from ..operators.training import FitParams, FitResult, fit
from ..sources.features import read_features, split_paths, write_features, write_split_folders
from ..sources.files import (IMAGE_CHANNELS, IMAGE_HEIGHT, IMAGE_INPUTS, IMAGE_WIDTH, image_decoder, scan_images,
                            with_split_from_path)
from ..session import path_exists
from ..sources.models import read_model, write_model


LAYOUTS = {"float": dict(output_float=True), "double": dict(), "packed": dict(output_packed=True)}


def _layout(layout: str) -> dict:
    """Feature column type of a written table: ``float`` (array<float>, the reference's
    precision, default), ``double`` (array<double>) or ``packed`` (float32 binary)."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {sorted(LAYOUTS)}, not {layout!r}")
    return LAYOUTS[layout]


def _require(**kw) -> None:
    missing = [k for k, v in kw.items() if v is None or v == ""]
    if missing:
        raise ValueError(f"missing required argument(s): {', '.join(missing)}")


# Images decoded per scoring slice: 64 × 224 × 224 × 3 float32 ≈ 38 MB in a Python worker.
IMAGE_BATCH_ROWS = 64


def image_features(imgs: DataFrame, scorer_factory: Callable[[], BatchFn], *, n_classes: int,
                   height: int = IMAGE_HEIGHT, width: int = IMAGE_WIDTH, channels: int = IMAGE_CHANNELS,
                   on_bad: str = "error", with_onehot: bool = False,
                   batch_rows: int = IMAGE_BATCH_ROWS, layout: str = "float") -> DataFrame:
    """Decoded images (batch or stream) → ``id, path, split, label, features`` (+ one-hot):
    split and label from the path, resize, then the scorer, all narrow (no shuffle).
    ``id`` = ``xxhash64(path)``: a deterministic 64-bit row id for seeded order and masks."""
    imgs = with_split_from_path(imgs).withColumn("id", F.xxhash64("path"))
    imgs = with_path_label(imgs, "path", "label", n_classes=n_classes, on_bad=on_bad)
    feats = featurize(imgs, scorer_factory, input_col="data", input_cols=IMAGE_INPUTS,
                      decode=image_decoder(height, width, channels), output_col="features",
                      keep=["id", "path", "split", "label"], batch_rows=batch_rows, **_layout(layout))
    if with_onehot:
        feats = feats.withColumn("label_onehot", onehot_encode(F.col("label"), n_classes))
    return feats


def observe_intake(imgs: DataFrame, n_classes: int) -> tuple[DataFrame, Observation]:
    """``imgs`` and what the next action on it sees of every file: ``files``, ``bad_images`` (not
    decodable), ``bad_paths`` (decoded, but without a class in the path) and ``first_bad`` (the
    smallest path of either; null without one). The metrics ride on the job that reads the files;
    nothing is scanned again and nothing is collected but this one row."""
    broken = F.col("height") < 0
    unlabeled = ~broken & ~path_is_valid("path", n_classes)
    seen = Observation()
    return imgs.observe(seen, F.count(F.lit(1)).alias("files"), F.count_if(broken).alias("bad_images"),
                        F.count_if(unlabeled).alias("bad_paths"),
                        F.min(F.when(broken | unlabeled, F.col("path"))).alias("first_bad")), seen


def image_scorer(spark: SparkSession, *, model: Model | None, output_layer: str | None,
                 scorer_factory: Callable[[], BatchFn] | None, n_in: int) -> Callable[[], BatchFn]:
    """The scorer of a featurization: a truncated layer chain or a user's factory."""
    if (model is None) == (scorer_factory is None):
        raise ValueError("give exactly one of model or scorer_factory")
    if model is None:
        return scorer_factory
    _require(output_layer=output_layer)
    model = model.upto(output_layer)
    if model.n_in != n_in:
        raise ValueError(f"model takes {model.n_in} inputs, images give {n_in}")
    return layer_chain(broadcast_model(spark, model))


def featurize_images(spark: SparkSession, image_root: str, save_path: str, *, n_classes: int = 257,
                     model: Model | None = None, output_layer: str | None = None,
                     scorer_factory: Callable[[], BatchFn] | None = None, height: int = IMAGE_HEIGHT,
                     width: int = IMAGE_WIDTH, channels: int = IMAGE_CHANNELS, on_bad: str = "error",
                     with_onehot: bool = False, mode: str = "errorifexists", layout: str = "float",
                     split_folders: bool = False) -> dict | None:
    """Featurize ``image_root/{train,test,valid}/ddd.name/ddd_dddd.jpg`` in one job.

    The network is either a layer chain ``model`` truncated after ``output_layer`` or any
    ``scorer_factory`` (e.g. a pre-trained convolutional network behind onnxruntime).
    Output: ``id bigint, path, split, label int, features`` (+ ``label_onehot``), features as
    ``array<float>`` by default (see ``layout``), written one folder per split (``split=``
    partitions, or the reference's plain ``train``/``test``/``valid`` folders with
    ``split_folders``); fails if ``save_path`` exists (default mode).

    With ``on_bad="drop"``, files that don't decode or whose path has no class are left out;
    the counts come back (see :func:`observe_intake`), taken in the same pass. ``mode="ignore"``
    with an existing ``save_path`` runs nothing and returns None.
    """
    _require(image_root=image_root, save_path=save_path)
    scorer = image_scorer(spark, model=model, output_layer=output_layer, scorer_factory=scorer_factory,
                          n_in=height * width * channels)
    if mode == "ignore" and path_exists(spark, save_path):
        return None
    imgs, seen = observe_intake(scan_images(spark, split_paths(spark, image_root), on_invalid="keep" if on_bad == "drop" else "error"),
                                n_classes)
    if on_bad == "drop":
        imgs = imgs.filter(F.col("height") >= 0)
    feats = image_features(imgs, scorer, n_classes=n_classes, height=height, width=width, channels=channels,
                           on_bad=on_bad, with_onehot=with_onehot, layout=layout)
    (write_split_folders if split_folders else write_features)(feats, save_path, mode=mode)
    return seen.get


STAGES = {"fc2": ("fc1", "fc2"), "predictions": ("fc2", None)}


def featurize_features(spark: SparkSession, data_path: str, save_path: str, model: Model | str,
                       last_layer: str, *, features: str = "features", mode: str = "errorifexists",
                       layout: str = "float") -> None:
    """Second-stage featurization: ``fc2`` runs the layers after ``fc1`` up to ``fc2``;
    ``predictions`` runs everything after ``fc2``. Other names are refused. Of a model given
    as the path of its table, only the layers that run are read."""
    _require(data_path=data_path, save_path=save_path, last_layer=last_layer)
    if last_layer not in STAGES:
        raise ValueError(f"last layer must be one of {sorted(STAGES)}, not {last_layer!r}")
    start, end = STAGES[last_layer]
    if isinstance(model, str):
        tail = read_model(spark, model, after=start, upto=end)[0]
    else:
        tail = model.after(start)
        tail = tail.upto(end) if end else tail
    df = spark.read.parquet(data_path)
    keep = [c for c in df.columns if c != features]
    out = featurize(df, layer_chain(broadcast_model(spark, tail)), input_col=features, output_col=features,
                    keep=keep, in_dim=tail.n_in, **_layout(layout))
    write_features(out, save_path, split="split" if "split" in keep else None, mode=mode)


def train_head(spark: SparkSession, train_path: str, input_layer: str, *, n_in: int, n_classes: int,
               params: FitParams = FitParams(), valid_path: str | None = None, save_path: str | None = None,
               id_col: str = "id", features: str = "features", label: str = "label",
               history_path: str | None = None, snapshot_path: str | None = None) -> FitResult:
    """Build the head for ``input_layer`` (Xavier init, ``params.seed``), fit, optionally save
    (``snapshot_path``: a model table per epoch, the last two kept, for resuming)."""
    _require(train_path=train_path, input_layer=input_layer)
    model = init_params(head(input_layer, n_in, n_classes, keep_prob=params.keep_prob or 1.0), seed=params.seed)
    train = read_features(spark, train_path, features=features, label=label, columns=[id_col])
    valid = (read_features(spark, valid_path, features=features, label=label, columns=[id_col])
             if valid_path else None)
    res = fit(train, model, params, id_col=id_col, features=features, label=label, valid=valid,
              history_path=history_path, snapshot_path=snapshot_path)
    if save_path:
        write_model(spark, res.model, save_path, state=res.state, meta=res.meta() | {"epoch": params.epochs - 1})
    return res


def train_incrementally(spark: SparkSession, train_path: str, model_path: str, save_path: str, *,
                        params: FitParams = FitParams(), valid_path: str | None = None, id_col: str = "id",
                        features: str = "features", label: str = "label",
                        history_path: str | None = None, snapshot_path: str | None = None) -> FitResult:
    """Warm start: load a model table (a saved model or a snapshot), continue with new
    settings (rate, schedule, updater, momentum, L2, seed, keep probability), save. Epoch
    numbering continues after the saved epoch."""
    _require(train_path=train_path, model_path=model_path, save_path=save_path)
    model, state, meta = read_model(spark, model_path)
    train = read_features(spark, train_path, features=features, label=label, columns=[id_col])
    valid = (read_features(spark, valid_path, features=features, label=label, columns=[id_col])
             if valid_path else None)
    start = int(meta.get("epoch", -1)) + 1
    res = fit(train, model, params, id_col=id_col, features=features, label=label, valid=valid,
              state=state, iterations=int(meta.get("iterations", 0)), history_path=history_path,
              updater_steps=int(meta.get("updater_steps", meta.get("iterations", 0))),
              snapshot_path=snapshot_path, start_epoch=start)
    write_model(spark, res.model, save_path, state=res.state, meta=res.meta() | {"epoch": start + params.epochs - 1})
    return res


def score_model(spark: SparkSession, model_path: str, data_path: str, *, features: str = "features",
                label: str = "label", recursive: bool = True) -> DataFrame:
    """Evaluate a saved model on a feature table → ``n, accuracy, precision, recall, loss``."""
    _require(model_path=model_path, data_path=data_path)
    model, _, _ = read_model(spark, model_path)
    data = read_features(spark, data_path, features=features, label=label, columns=[], recursive=recursive)
    return evaluate(predict(data, model, features=features, label=label, keep=[label]))


def save_initial_model(spark: SparkSession, predict_after: str, save_path: str, *, n_in: int,
                       n_classes: int) -> Model:
    """Write an untrained preset head (Xavier, seed 42) with its optimizer constants."""
    _require(predict_after=predict_after, save_path=save_path)
    pre = initial_preset(predict_after, n_in, n_classes)
    model = init_params(pre.layers, seed=pre.seed)
    write_model(spark, model, save_path, meta={"iterations": 0, "rate": pre.rate, "momentum": pre.momentum,
                                               "l2": pre.l2})
    return model
