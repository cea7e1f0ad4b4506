"""Command line: ``python -m headstart <program> [flags]`` (or the same through spark-submit).

Programs and flags follow the reference's command-line programs, so existing invocations
map over; each runs the matching plan function of :mod:`headstart.plans.programs`.

* ``featurize``          --imagePath --savePath --modelPath (model table or .onnx) --outputLayer --numClasses
* ``featurize-stage2``   --data --save --model --lastLayer
* ``train``              --train [--valid] [--save] --inputLayer --numIn --numClasses + training flags
* ``train-incremental``  --train [--valid] --model --save [--learningRateSchedule] + training flags
* ``score``              --test --model
* ``save-initial-model`` --save --predictAfter --numIn --numClasses
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .model import layer_width
from .operators.schedule import parse_schedule
from .operators.training import FitParams
from .plans import programs as P
from .sources.models import read_model


def _training_flags(p: argparse.ArgumentParser, incremental: bool) -> None:
    # The reference's training flags and their defaults.
    p.add_argument("--train", required=True)
    p.add_argument("--valid")
    p.add_argument("--save", required=incremental)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--epochs", type=int, default=1)
    p.add_argument("--validationInterval", type=int, default=4)
    p.add_argument("--rate", type=float, default=0.001)
    p.add_argument("--batchSize", type=int, default=8)
    p.add_argument("--averagingFrequency", type=int, default=5)
    p.add_argument("--momentum", type=float, default=0.9)
    p.add_argument("--reg", type=float, default=0.0)
    p.add_argument("--dropout", type=float, default=0.0, help="drop probability; 0 = off")
    p.add_argument("--updater", default="nesterovs")
    p.add_argument("--workers", type=int, default=0, help="0 = the session's default parallelism")
    p.add_argument("--idCol", default="id")
    p.add_argument("--featuresCol", default="features")
    p.add_argument("--labelCol", default="label")
    p.add_argument("--snapshot", help="folder for a model table per epoch (the last two stay)")
    p.add_argument("--history", help="append the metrics history here (Parquet)")


def _fit_params(a, spark: SparkSession, schedule: dict | None = None) -> FitParams:
    workers = a.workers or spark.sparkContext.defaultParallelism
    keep = None if not a.dropout else 1.0 - a.dropout
    return FitParams(epochs=a.epochs, workers=workers, batch_size=a.batchSize, avg_freq=a.averagingFrequency,
                     rate=a.rate, schedule=schedule, updater=a.updater, momentum=a.momentum, l2=a.reg,
                     seed=a.seed, eval_interval=a.validationInterval, keep_prob=keep)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="python -m headstart")
    sub = root.add_subparsers(dest="program", required=True)
    f = sub.add_parser("featurize")
    f.add_argument("--imagePath", required=True)
    f.add_argument("--savePath", required=True)
    f.add_argument("--modelPath", required=True, help="a model table, or an .onnx file")
    f.add_argument("--outputLayer", help="cut a model table after this layer")
    f.add_argument("--numClasses", type=int, default=257)
    f.add_argument("--height", type=int, default=224)
    f.add_argument("--width", type=int, default=224)
    f.add_argument("--layout", default="float", choices=sorted(P.LAYOUTS))
    f.add_argument("--channelsFirst", action="store_true", help="feed an ONNX model NCHW tensors")
    f.add_argument("--splitFolders", action="store_true",
                   help="write savePath/train, /test, /valid (the reference's layout) instead of split=…")
    s2 = sub.add_parser("featurize-stage2")
    s2.add_argument("--data", required=True)
    s2.add_argument("--save", required=True)
    s2.add_argument("--model", required=True)
    s2.add_argument("--lastLayer", required=True)
    s2.add_argument("--layout", default="float", choices=sorted(P.LAYOUTS))
    t = sub.add_parser("train")
    _training_flags(t, incremental=False)
    t.add_argument("--inputLayer", required=True)
    t.add_argument("--numIn", type=int, help="features per row; by default the input layer's width")
    t.add_argument("--numClasses", type=int, default=257)
    ti = sub.add_parser("train-incremental")
    _training_flags(ti, incremental=True)
    ti.add_argument("--model", required=True)
    ti.add_argument("--learningRateSchedule")
    sc = sub.add_parser("score")
    sc.add_argument("--test", required=True)
    sc.add_argument("--model", required=True)
    sc.add_argument("--featuresCol", default="features")
    sc.add_argument("--labelCol", default="label")
    si = sub.add_parser("save-initial-model")
    si.add_argument("--save", required=True)
    si.add_argument("--predictAfter", required=True)
    si.add_argument("--numIn", type=int, help="features per row; by default the layer's width")
    si.add_argument("--numClasses", type=int, default=257)
    return root


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = parser().parse_args(argv)  # arguments are checked before the session starts
    spark = spark or SparkSession.builder.appName(f"headstart {a.program}").getOrCreate()
    out: dict = {"program": a.program}
    if a.program == "featurize":
        if a.modelPath.endswith(".onnx"):
            from .operators.onnx_scorer import onnx_scorer

            kw = dict(scorer_factory=onnx_scorer(spark, a.modelPath, input_shape=(a.height, a.width, 3),
                                                 channels_first=a.channelsFirst))
        else:
            kw = dict(model=read_model(spark, a.modelPath)[0], output_layer=a.outputLayer)
        out["intake"] = P.featurize_images(spark, a.imagePath, a.savePath, n_classes=a.numClasses, height=a.height,
                                           width=a.width, layout=a.layout, split_folders=a.splitFolders, **kw)
    elif a.program == "featurize-stage2":
        P.featurize_features(spark, a.data, a.save, a.model, a.lastLayer, layout=a.layout)
    elif a.program == "train":
        res = P.train_head(spark, a.train, a.inputLayer, n_in=a.numIn or layer_width(a.inputLayer), n_classes=a.numClasses,
                           params=_fit_params(a, spark), valid_path=a.valid, save_path=a.save,
                           id_col=a.idCol, features=a.featuresCol, label=a.labelCol,
                           history_path=a.history, snapshot_path=a.snapshot)
        out["history"] = res.history.to_dict(orient="records")
    elif a.program == "train-incremental":
        schedule = parse_schedule(a.learningRateSchedule) if a.learningRateSchedule else None
        res = P.train_incrementally(spark, a.train, a.model, a.save, params=_fit_params(a, spark, schedule),
                                    valid_path=a.valid, id_col=a.idCol, features=a.featuresCol,
                                    label=a.labelCol, history_path=a.history, snapshot_path=a.snapshot)
        out["history"] = res.history.to_dict(orient="records")
    elif a.program == "score":
        out["metrics"] = P.score_model(spark, a.model, a.test, features=a.featuresCol,
                                       label=a.labelCol).first().asDict()
    elif a.program == "save-initial-model":
        P.save_initial_model(spark, a.predictAfter, a.save, n_in=a.numIn or layer_width(a.predictAfter),
                             n_classes=a.numClasses)
    return out


if __name__ == "__main__":
    print(json.dumps(main(sys.argv[1:]), default=str))
