"""Batch inference over a distributed table (I1, I2, I11, I12) and the scorer plug-in point.

The model is shipped once per executor as a torrent broadcast (size checked first) and
rebuilt once per task; rows stream through ``mapInArrow`` in Arrow batches, each batch is
one matrix product per layer. No shuffle: scoring is a narrow map, so it scales with the
number of executor cores. Filters and projections are *not* pushed through the Python
boundary, so callers select the columns they need and filter before scoring.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..model import Model, forward
from ..session import ship_package
from .arrowbatch import list_matrix, matrix_list, pack_rows

# Upper bound for a broadcast model; the model's size is known before it is shipped.
MAX_MODEL_BYTES_CONF = "headstart.model.maxBroadcastBytes"
DEFAULT_MAX_MODEL_BYTES = 4 << 30
DEFAULT_BATCH_ROWS = 1024

BatchFn = Callable[[np.ndarray], np.ndarray]


def check_model_size(spark: SparkSession, size: int) -> None:
    """Refuse to ship a model above ``headstart.model.maxBroadcastBytes`` (default 4 GiB)."""
    limit = int(spark.conf.get(MAX_MODEL_BYTES_CONF, str(DEFAULT_MAX_MODEL_BYTES)))
    if size > limit:
        raise ValueError(f"model has {size} bytes, above the broadcast limit {limit} "
                         f"({MAX_MODEL_BYTES_CONF})")


def broadcast_model(spark: SparkSession, model: Model):
    """Broadcast a model after checking its size; its size is known before shipping."""
    check_model_size(spark, model.nbytes())
    ship_package(spark)
    return spark.sparkContext.broadcast(model)


def _field(df: DataFrame, name: str) -> T.StructField:
    return df.schema[name]


def _rows(rb: pa.RecordBatch, batch_rows: int) -> Iterator[pa.RecordBatch]:
    for start in range(0, rb.num_rows, batch_rows):
        yield rb.slice(start, batch_rows)


def _column(rb: pa.RecordBatch, name: str) -> pa.Array:
    return rb.column(rb.schema.get_field_index(name))


def featurize(df: DataFrame, scorer_factory: Callable[[], BatchFn], *, input_col: str,
              output_col: str, keep: list[str] | None = None, in_dim: int | None = None,
              batch_rows: int = DEFAULT_BATCH_ROWS, output_float: bool = False,
              output_packed: bool = False, input_cols: list[str] | None = None,
              decode: Callable[[pa.RecordBatch], np.ndarray] | None = None, dtype=np.float64) -> DataFrame:
    """Run a batch function over ``input_col`` and append ``output_col``.

    ``scorer_factory`` is called once per task and returns ``f(x: n×d) -> n×k``; this is
    where a user plugs in a pre-trained network (e.g. an ONNX session). ``keep`` columns
    ride along unchanged (default: all but the input); one output row per input row.
    The input may be ``array<float|double>`` or packed float32 ``binary``; the output is
    ``array<double>`` (``array<float>`` with ``output_float``; packed float32 ``binary``
    with ``output_packed``, the fastest layout to move between the JVM and Python).
    ``decode`` turns a batch of ``input_cols`` into the input matrix (e.g. image bytes →
    resized tensors), so decoding and scoring share one pass through Python.
    """
    ship_package(df.sparkSession)
    input_cols = list(input_cols or [input_col])
    keep = [c for c in df.columns if c not in input_cols] if keep is None else list(keep)
    src = df.select(*keep, *[c for c in input_cols if c not in keep])
    value_t = T.FloatType() if output_float else T.DoubleType()
    out_t = T.BinaryType() if output_packed else T.ArrayType(value_t, False)
    schema = T.StructType([_field(src, c) for c in keep] + [T.StructField(output_col, out_t, False)])
    arrow_t = pa.float32() if output_float else pa.float64()
    encode = pack_rows if output_packed else (lambda y: matrix_list(y, arrow_t))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = scorer_factory()
        for rb in batches:
            for part in _rows(rb, batch_rows):
                x = decode(part) if decode is not None else list_matrix(_column(part, input_col), in_dim, dtype)
                y = np.asarray(fn(x))
                y = y if output_float or output_packed else y.astype(np.float64, copy=False)
                if y.ndim != 2 or y.shape[0] != part.num_rows:
                    raise ValueError(f"scorer returned shape {y.shape} for {part.num_rows} rows")
                cols = [_column(part, c) for c in keep] + [encode(y)]
                yield pa.RecordBatch.from_arrays(cols, names=keep + [output_col])

    return src.mapInArrow(run, schema)


def layer_chain(bc, dtype=np.float64) -> Callable[[], BatchFn]:
    """Scorer factory for a broadcast :class:`Model` (rebuilt once per task)."""

    def factory() -> BatchFn:
        model: Model = bc.value if dtype == np.float64 else bc.value.astype(dtype)
        return lambda x: forward(model, x, dtype)

    return factory


def score(df: DataFrame, model: Model, *, features: str = "features", output: str = "output",
          keep: list[str] | None = None, batch_rows: int = DEFAULT_BATCH_ROWS,
          output_float: bool = False, output_packed: bool = False, dtype=np.float64) -> DataFrame:
    """Append the model's output activations as ``output`` (I1 with I3/I4 slices), computed in
    ``dtype`` (``np.float32`` is the reference's precision and about twice as fast)."""
    bc = broadcast_model(df.sparkSession, model)
    return featurize(df, layer_chain(bc, dtype), input_col=features, output_col=output, keep=keep,
                     in_dim=model.n_in, batch_rows=batch_rows, output_float=output_float,
                     output_packed=output_packed, dtype=dtype)


def predict(df: DataFrame, model: Model, *, features: str = "features", label: str | None = "label",
            keep: list[str] | None = None, with_probs: bool = False,
            batch_rows: int = DEFAULT_BATCH_ROWS, dtype=np.float64) -> DataFrame:
    """Score and classify: appends ``pred int`` (argmax, ties to the lowest index),
    ``prob double`` (its probability) and, when ``label`` is given, ``nll double``
    (``-ln p[label]``); ``probs array<double>`` on request.
    """
    keep = [c for c in df.columns if c != features] if keep is None else list(keep)
    if label is not None and label not in keep:
        keep.append(label)
    src = df.select(*keep, features)
    bc = broadcast_model(df.sparkSession, model)
    n_in, n_out = model.n_in, model.n_out
    fields = [_field(src, c) for c in keep] + [
        T.StructField("pred", T.IntegerType(), False),
        T.StructField("prob", T.DoubleType(), False)]
    if label is not None:
        fields.append(T.StructField("nll", T.DoubleType(), False))
    if with_probs:
        fields.append(T.StructField("probs", T.ArrayType(T.DoubleType(), False), False))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = bc.value if dtype == np.float64 else bc.value.astype(dtype)
        for rb in batches:
            for part in _rows(rb, batch_rows):
                out = forward(m, list_matrix(_column(part, features), n_in, dtype), dtype).astype(np.float64, copy=False)
                pred = out.argmax(axis=1)
                idx = np.arange(len(pred))
                cols = [_column(part, c) for c in keep]
                cols += [pa.array(pred.astype(np.int32)), pa.array(out[idx, pred])]
                names = keep + ["pred", "prob"]
                if label is not None:
                    ycol = _column(part, label)
                    if ycol.null_count:
                        raise ValueError(f"null in column {label}")
                    y = ycol.to_numpy(zero_copy_only=False)
                    if part.num_rows and (np.isnan(y.astype(np.float64)).any()
                                          or y.min() < 0 or y.max() >= n_out):
                        raise ValueError(f"label outside 0..{n_out - 1}")
                    y = y.astype(np.int64)
                    nll = -np.log(np.clip(out[idx, y], 1e-300, None))
                    cols.append(pa.array(nll))
                    names.append("nll")
                if with_probs:
                    cols.append(matrix_list(out))
                    names.append("probs")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return src.mapInArrow(run, schema)
