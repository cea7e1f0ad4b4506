"""Named models and settings used by the registered queries, tests and bench.

Weights are the formula of :func:`headstart.model.fixture_weights`, so the same numbers
can be produced in SQL for the oracle checks.
"""

from __future__ import annotations

from ..model import Model, dense, init_params

SEED = 42
N_CLASSES = 10
WIDTH = 64
HIDDEN = 16


def one_layer(n_in: int = WIDTH, n_classes: int = N_CLASSES) -> Model:
    """64 → 10 softmax head with fixture weights."""
    return init_params([dense("predictions", n_in, n_classes, "softmax")], scheme="fixture")


def two_stage(n_in: int = WIDTH, hidden: int = HIDDEN, n_classes: int = N_CLASSES) -> Model:
    """64 → 16 (ReLU, layer ``fc1``) → 10 (softmax, layer ``predictions``)."""
    return init_params([dense("fc1", n_in, hidden, "relu"),
                        dense("predictions", hidden, n_classes, "softmax")], scheme="fixture")


def dense_only(n_in: int = WIDTH, n_out: int = HIDDEN, activation: str = "identity") -> Model:
    return init_params([dense("dense0", n_in, n_out, activation)], scheme="fixture")
