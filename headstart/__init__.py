"""headstart — transfer learning on feature tables, built on Spark DataFrames.

Featurize images or read feature tables, derive and check labels, score rows with a
broadcast layer-chain model (or a plugged-in scorer) through Arrow batches, shuffle and
split reproducibly, train a classifier head by distributed parameter averaging, and
evaluate it with plain aggregations.
"""

from .functions.labels import (checked_path_label, onehot_decode, onehot_encode, path_label,
                               to_labeled_points, with_path_label)
from .model import Layer, Model, batchnorm, dense, dropout, head, init_params, initial_preset
from .operators.evaluation import confusion, evaluate, per_class_stats
from .operators.ordering import assign_minibatches, shuffle_order, split_fixed, with_position
from .operators.schedule import parse_schedule, rate_column
from .operators.scoring import featurize, predict, score
from .operators.training import FitParams, FitResult, fit, prepare_layout
from .plans.programs import (featurize_features, featurize_images, save_initial_model, score_model,
                             train_head, train_incrementally)
from .session import local_session
from .sources.features import (read_features, read_split_folders, to_array, to_packed, write_features,
                               write_split_folders)
from .sources.files import scan_binary, scan_images
from .sources.models import read_model, write_model

__all__ = [
    "Layer", "Model", "batchnorm", "dense", "dropout", "head", "init_params", "initial_preset",
    "checked_path_label", "onehot_decode", "onehot_encode", "path_label", "to_labeled_points",
    "with_path_label", "confusion", "evaluate", "per_class_stats", "assign_minibatches",
    "shuffle_order", "split_fixed", "with_position", "parse_schedule", "rate_column", "featurize",
    "predict", "score", "FitParams", "FitResult", "fit", "prepare_layout", "featurize_features",
    "featurize_images", "save_initial_model", "score_model", "train_head", "train_incrementally",
    "local_session", "read_features", "read_split_folders", "to_array", "to_packed", "write_features",
    "write_split_folders", "scan_binary", "scan_images", "read_model", "write_model",
]
