"""Layer-chain models: specs, slicing, numpy forward/backward, presets, weight init.

A model is an ordered chain of layers (every graph the reference builds is a chain):

* ``dense``     ``Z = A @ W + b`` then an activation: ``identity``, ``relu`` or ``softmax``.
                A final softmax dense layer is the output layer (negative log-likelihood).
* ``batchnorm`` inference ``(A - mean) / sqrt(var + eps) * gamma + beta``; in training the
                batch moments are used and running moments updated with ``decay``.
* ``dropout``   identity at inference; in training an inverted mask with ``keep_prob``.

Parameters live in a flat dict ``{"<layer>/<param>": ndarray}``. The same arrays are
packed to one float64 vector for parameter averaging (:func:`pack`).
Everything here runs inside Spark tasks on small arrays (one model, one batch); the data
never comes here whole.
"""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field

import numpy as np

DENSE, BATCHNORM, DROPOUT = "dense", "batchnorm", "dropout"
ACTIVATIONS = ("identity", "relu", "softmax")


@dataclass(frozen=True)
class Layer:
    name: str
    kind: str
    n_in: int
    n_out: int
    activation: str = "identity"
    keep_prob: float = 1.0
    eps: float = 1e-5
    decay: float = 0.9

    def __post_init__(self):
        if self.kind not in (DENSE, BATCHNORM, DROPOUT):
            raise ValueError(f"unknown layer kind: {self.kind!r}")
        if self.activation not in ACTIVATIONS:
            raise ValueError(f"unknown activation: {self.activation!r}")
        if self.kind != DENSE and self.n_in != self.n_out:
            raise ValueError(f"{self.kind} layer {self.name!r} must keep its width")
        if not 0.0 < self.keep_prob <= 1.0:
            raise ValueError("keep_prob must be in (0, 1]")

    def param_shapes(self) -> dict[str, tuple[int, ...]]:
        if self.kind == DENSE:
            return {"W": (self.n_in, self.n_out), "b": (self.n_out,)}
        if self.kind == BATCHNORM:
            n = self.n_out
            return {"gamma": (n,), "beta": (n,), "mean": (n,), "var": (n,)}
        return {}


# Parameters that gradient steps change; batch-norm running moments are averaged but
# updated by the moving average, not by the optimizer.
TRAINABLE = {"W", "b", "gamma", "beta"}


@dataclass
class Model:
    layers: tuple[Layer, ...]
    params: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        self.layers = tuple(self.layers)
        names = [l.name for l in self.layers]
        if len(set(names)) != len(names):
            raise ValueError(f"duplicate layer names: {names}")
        for a, b in zip(self.layers, self.layers[1:]):
            if a.n_out != b.n_in:
                raise ValueError(f"width mismatch: {a.name} gives {a.n_out}, {b.name} takes {b.n_in}")
        for l in self.layers:
            for p, shape in l.param_shapes().items():
                key = f"{l.name}/{p}"
                if key not in self.params:
                    raise ValueError(f"missing parameter {key}")
                arr = np.asarray(self.params[key], dtype=np.float64)
                if arr.shape != shape:
                    raise ValueError(f"parameter {key} has shape {arr.shape}, expected {shape}")
                self.params[key] = arr

    # ---- shape -------------------------------------------------------------------
    @property
    def n_in(self) -> int:
        return self.layers[0].n_in

    @property
    def n_out(self) -> int:
        return self.layers[-1].n_out

    @property
    def layer_names(self) -> list[str]:
        return [l.name for l in self.layers]

    def _index(self, name: str) -> int:
        try:
            return self.layer_names.index(name)
        except ValueError:
            raise ValueError(f"no layer named {name!r}; layers are {self.layer_names}") from None

    def _sub(self, layers) -> "Model":
        keep = {f"{l.name}/{p}" for l in layers for p in l.param_shapes()}
        return Model(tuple(layers), {k: v for k, v in self.params.items() if k in keep})

    def upto(self, name: str) -> "Model":
        """Truncate after the named layer: output = that layer's activations."""
        return self._sub(self.layers[: self._index(name) + 1])

    def after(self, name: str) -> "Model":
        """Layers strictly after the named layer (I4)."""
        rest = self.layers[self._index(name) + 1:]
        if not rest:
            raise ValueError(f"no layers after {name!r}")
        return self._sub(rest)

    def astype(self, dtype) -> "Model":
        return Model(self.layers, {k: v.astype(dtype) for k, v in self.params.items()})

    def copy(self) -> "Model":
        return Model(self.layers, {k: v.copy() for k, v in self.params.items()})

    def nbytes(self) -> int:
        return int(sum(v.nbytes for v in self.params.values()))

    # ---- flat vector ---------------------------------------------------------------
    def keys(self) -> list[str]:
        return [f"{l.name}/{p}" for l in self.layers for p in l.param_shapes()]

    def size(self) -> int:
        return int(sum(self.params[k].size for k in self.keys()))


def pack(model: Model, keys: list[str] | None = None) -> np.ndarray:
    keys = model.keys() if keys is None else keys
    if not keys:
        return np.zeros(0)
    return np.concatenate([model.params[k].ravel() for k in keys])


# ---- numerics -----------------------------------------------------------------------

def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _activate(z: np.ndarray, act: str) -> np.ndarray:
    if act == "relu":
        return np.maximum(z, 0.0)
    if act == "softmax":
        return softmax(z)
    return z


def forward(model: Model, x: np.ndarray, dtype=np.float64) -> np.ndarray:
    """Inference forward pass of a batch ``x`` (rows × n_in) → rows × n_out."""
    a = np.asarray(x, dtype=dtype)
    if a.ndim != 2 or a.shape[1] != model.n_in:
        raise ValueError(f"input has shape {a.shape}, model takes {model.n_in} features")
    p = model.params
    for l in model.layers:
        if l.kind == DENSE:
            a = _activate(a @ p[f"{l.name}/W"] + p[f"{l.name}/b"], l.activation)
        elif l.kind == BATCHNORM:
            a = (a - p[f"{l.name}/mean"]) / np.sqrt(p[f"{l.name}/var"] + l.eps) \
                * p[f"{l.name}/gamma"] + p[f"{l.name}/beta"]
    return a


def loss_and_grads(model: Model, x: np.ndarray, y: np.ndarray,
                   masks: dict[str, np.ndarray] | None = None, moments: dict[str, tuple] | None = None):
    """Training forward + backward for one mini-batch.

    Returns ``(mean_nll, grads, running)`` where ``grads`` maps trainable parameter keys to
    gradients of the *mean* NLL and ``running`` holds the updated batch-norm moments.
    ``masks`` maps dropout layer names to boolean keep masks (rows × width). ``moments`` maps
    batch-norm layers to the (mean, variance) of a whole batch of which ``x`` is a part; parameters
    below such a layer then get no right gradient.
    """
    last = model.layers[-1]
    if last.kind != DENSE or last.activation != "softmax":
        raise ValueError("training needs a softmax dense output layer")
    n = x.shape[0]
    p = model.params
    a = np.asarray(x, dtype=np.float64)
    cache = []
    for l in model.layers:
        if l.kind == DENSE:
            z = a @ p[f"{l.name}/W"] + p[f"{l.name}/b"]
            out = _activate(z, l.activation)
            cache.append((a, z))
        elif l.kind == BATCHNORM:
            mu, var = moments[l.name] if moments else (a.mean(axis=0), a.var(axis=0))
            inv = 1.0 / np.sqrt(var + l.eps)
            xhat = (a - mu) * inv
            out = xhat * p[f"{l.name}/gamma"] + p[f"{l.name}/beta"]
            cache.append((xhat, inv, mu, var))
        else:
            m = None if masks is None else masks.get(l.name)
            if m is None or l.keep_prob >= 1.0:
                out, m = a, None
            else:
                out = a * m / l.keep_prob
            cache.append(m)
        a = out
    probs = a
    idx = np.arange(n)
    nll = float(-np.log(np.clip(probs[idx, y], 1e-300, None)).mean())
    grads: dict[str, np.ndarray] = {}
    running: dict[str, np.ndarray] = {}
    d = probs.copy()
    d[idx, y] -= 1.0
    d /= n  # gradient w.r.t. the output pre-activation (softmax + NLL)
    for l, c in zip(reversed(model.layers), reversed(cache)):
        if l.kind == DENSE:
            a_in, z = c
            if l is not last:
                if l.activation == "relu":
                    d = d * (z > 0)
                elif l.activation == "softmax":
                    raise ValueError("softmax is only supported on the output layer")
            grads[f"{l.name}/W"] = a_in.T @ d
            grads[f"{l.name}/b"] = d.sum(axis=0)
            d = d @ p[f"{l.name}/W"].T
        elif l.kind == BATCHNORM:
            xhat, inv, mu, var = c
            g = p[f"{l.name}/gamma"]
            grads[f"{l.name}/gamma"] = (d * xhat).sum(axis=0)
            grads[f"{l.name}/beta"] = d.sum(axis=0)
            dx = d * g
            d = inv * (dx - dx.mean(axis=0) - xhat * (dx * xhat).mean(axis=0))
            running[f"{l.name}/mean"] = l.decay * p[f"{l.name}/mean"] + (1 - l.decay) * mu
            running[f"{l.name}/var"] = l.decay * p[f"{l.name}/var"] + (1 - l.decay) * var
        else:
            if c is not None:
                d = d * c / l.keep_prob
    return nll, grads, running


# ---- construction ------------------------------------------------------------------

def fixture_weights(n_in: int, n_out: int) -> np.ndarray:
    """Deterministic test weights ``((31*i + 17*j) % 13 - 6) / 20`` (also computable in SQL)."""
    i = np.arange(n_in)[:, None]
    j = np.arange(n_out)[None, :]
    return ((31 * i + 17 * j) % 13 - 6) / 20.0


def dense(name: str, n_in: int, n_out: int, activation: str = "identity") -> Layer:
    return Layer(name, DENSE, n_in, n_out, activation)


def batchnorm(name: str, n: int, eps: float = 1e-5, decay: float = 0.9) -> Layer:
    return Layer(name, BATCHNORM, n, n, eps=eps, decay=decay)


def dropout(name: str, n: int, keep_prob: float) -> Layer:
    return Layer(name, DROPOUT, n, n, keep_prob=keep_prob)


def init_params(layers, *, seed: int = 42, scheme: str = "xavier") -> Model:
    """Fresh parameters: Xavier normal (var 2/(in+out)), ``zeros`` or ``fixture`` weights.

    Biases and beta start at 0, gamma and running variance at 1, running mean at 0.
    """
    rng = np.random.default_rng(seed)
    params: dict[str, np.ndarray] = {}
    for l in layers:
        if l.kind == DENSE:
            if scheme == "xavier":
                w = rng.normal(0.0, np.sqrt(2.0 / (l.n_in + l.n_out)), size=(l.n_in, l.n_out))
            elif scheme == "zeros":
                w = np.zeros((l.n_in, l.n_out))
            elif scheme == "fixture":
                w = fixture_weights(l.n_in, l.n_out)
            else:
                raise ValueError(f"unknown init scheme {scheme!r}")
            params[f"{l.name}/W"] = w
            params[f"{l.name}/b"] = np.zeros(l.n_out)
        elif l.kind == BATCHNORM:
            params[f"{l.name}/gamma"] = np.ones(l.n_out)
            params[f"{l.name}/beta"] = np.zeros(l.n_out)
            params[f"{l.name}/mean"] = np.zeros(l.n_out)
            params[f"{l.name}/var"] = np.ones(l.n_out)
    return Model(tuple(layers), params)


#: Width of the named featurizer layers' output.
LAYER_WIDTHS = {"predictions": 1000, "fc2": 4096, "fc1": 4096}


def layer_width(input_layer: str) -> int:
    """Features that the named layer gives."""
    if input_layer.lower() not in LAYER_WIDTHS:
        raise ValueError(f"layer {input_layer} not supported")
    return LAYER_WIDTHS[input_layer.lower()]


# Fixed values in the heads and presets below: layer names, rates, momenta, penalties.

def head(input_layer: str, n_in: int, n_classes: int, *, keep_prob: float = 1.0,
         hidden: int | None = None) -> list[Layer]:
    """Classifier head stacked on a featurizer layer (names compared lower-case).

    ``predictions``: batch-norm → softmax; ``fc2``: dropout → batch-norm → softmax;
    ``fc1``: dropout → batch-norm → dense+ReLU → dropout → batch-norm → softmax.
    Widths are arguments (``hidden`` defaults to ``n_in``).
    """
    name = input_layer.lower()
    if name == "predictions":
        return [batchnorm("batchNorm0", n_in), dense("layer0", n_in, n_classes, "softmax")]
    if name == "fc2":
        return [dropout("dropout0", n_in, keep_prob), batchnorm("batchNorm0", n_in),
                dense("predictions", n_in, n_classes, "softmax")]
    if name == "fc1":
        h = hidden or n_in
        return [dropout("dropout0", n_in, keep_prob), batchnorm("batchNorm0", n_in),
                dense("fc2", n_in, h, "relu"), dropout("dropout1", h, keep_prob),
                batchnorm("batchNorm1", h), dense("predictions", h, n_classes, "softmax")]
    raise ValueError(f"layer {input_layer} not supported")


@dataclass(frozen=True)
class Preset:
    """Training constants of the initial-model variant of a head."""
    layers: tuple[Layer, ...]
    rate: float
    momentum: float
    l2: float
    seed: int = 42


def initial_preset(predict_after: str, n_in: int, n_classes: int) -> Preset:
    """Initial-model presets; names are case-sensitive here and ``fc2`` is a bare softmax."""
    if predict_after == "predictions":
        return Preset(tuple(head("predictions", n_in, n_classes)), 0.001, 0.98, 0.00005)
    if predict_after == "fc2":
        return Preset((dense("layer0", n_in, n_classes, "softmax"),), 0.001, 0.98, 0.00005)
    if predict_after == "fc1":
        return Preset(tuple(head("fc1", n_in, n_classes, keep_prob=0.9)), 0.01, 0.9, 0.01)
    raise ValueError(f"layer {predict_after} not supported")


def replace(layer: Layer, **kw) -> Layer:
    return dataclasses.replace(layer, **kw)
