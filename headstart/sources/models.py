"""Model table: save (K2) and load (S6) a layer-chain model with optimizer state.

Layout (Parquet, through Spark's file systems, so a shared folder works from any node):
``layer int, name string, kind string, activation string, n_in int, n_out int,
keep_prob double, eps double, decay double, param string, row int, values array<double>``.
A matrix is one row per input index; vectors are ``row = 0``; optimizer state rides in
``param = '<param>@<updater>.<slot>'``; run counters are ``layer = -1, name = '_meta'``.
The model goes back to the driver by design: it is broadcast to score or train.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import Layer, Model
from ..session import remove_path

SCHEMA = T.StructType([
    T.StructField("layer", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("activation", T.StringType(), False),
    T.StructField("n_in", T.IntegerType(), False),
    T.StructField("n_out", T.IntegerType(), False),
    T.StructField("keep_prob", T.DoubleType(), False),
    T.StructField("eps", T.DoubleType(), False),
    T.StructField("decay", T.DoubleType(), False),
    T.StructField("param", T.StringType(), False),
    T.StructField("row", T.IntegerType(), False),
    T.StructField("values", T.ArrayType(T.DoubleType(), False), False),
])


def model_table(model: Model, state: dict[str, np.ndarray] | None = None,
                meta: dict[str, float] | None = None) -> pa.Table:
    """The model table as Arrow, built array by array (no per-value Python objects)."""
    cols: dict[str, list] = {f.name: [] for f in SCHEMA.fields if f.name != "values"}
    values: list[pa.Array] = []

    def put(base: tuple, param: str, rows: np.ndarray) -> None:
        n, width = rows.shape
        for name, v in zip(list(cols)[:9], base):
            cols[name] += [v] * n
        cols["param"] += [param] * n
        cols["row"] += range(n)
        offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
        values.append(pa.ListArray.from_arrays(offsets, pa.array(rows.ravel(), pa.float64())))

    for li, l in enumerate(model.layers):
        base = (li, l.name, l.kind, l.activation, l.n_in, l.n_out, float(l.keep_prob), float(l.eps), float(l.decay))
        entries = [(p, model.params[f"{l.name}/{p}"]) for p in l.param_shapes()]
        entries += [(k.split("/", 1)[1], v) for k, v in (state or {}).items() if k.startswith(f"{l.name}/")]
        for p, arr in entries or [("", np.zeros((1, 0)))]:
            arr = np.asarray(arr, np.float64)
            put(base, p, arr.reshape(1, -1) if arr.ndim == 1 else arr)
    for k, v in (meta or {}).items():
        put((-1, "_meta", "", "identity", 0, 0, 1.0, 0.0, 0.0), k, np.array([[float(v)]]))
    # one chunk per array: a list array's values stay below 2^31
    table = [pa.array(c, {"string": pa.string(), "double": pa.float64()}.get(SCHEMA[n].dataType.simpleString(), pa.int32()))
             for n, c in cols.items()]
    return pa.table([*table, pa.chunked_array(values, pa.list_(pa.float64()))], names=[*cols, "values"])


def model_to_df(spark: SparkSession, model: Model, state: dict[str, np.ndarray] | None = None,
                meta: dict[str, float] | None = None) -> DataFrame:
    return spark.createDataFrame(model_table(model, state, meta), schema=SCHEMA)


def write_model(spark: SparkSession, model: Model, path: str, *, state=None, meta=None,
                mode: str = "errorifexists") -> None:
    """Save a model (and optimizer state) as a Parquet model table (K2)."""
    model_to_df(spark, model, state, meta).write.mode(mode).parquet(path)


def model_from_rows(pdf: pd.DataFrame) -> tuple[Model, dict[str, np.ndarray], dict[str, float]]:
    meta = {r.param: float(r.values[0]) for r in pdf[pdf.layer < 0].itertuples()}
    body = pdf[pdf.layer >= 0].sort_values(["layer", "param", "row"])
    layers, params, state = [], {}, {}
    for li, g in body.groupby("layer", sort=True):
        r0 = g.iloc[0]
        layers.append(Layer(r0["name"], r0["kind"], int(r0["n_in"]), int(r0["n_out"]),
                            r0["activation"], float(r0["keep_prob"]), float(r0["eps"]),
                            float(r0["decay"])))
        shapes = layers[-1].param_shapes()
        for p, gp in g[g.param != ""].groupby("param", sort=False):
            mat = np.array([np.asarray(v, dtype=np.float64) for v in gp.sort_values("row")["values"]])
            base = p.split("@", 1)[0]
            arr = mat.reshape(shapes[base]) if base in shapes else mat
            (state if "@" in p else params)[f"{r0['name']}/{p}"] = arr
    return Model(tuple(layers), params), state, meta


def write_snapshot(spark: SparkSession, model: Model, path: str, epoch: int, *, state=None, meta=None) -> None:
    """Save a model table as ``path/epoch=N``; the last complete one stays until this one is."""
    write_model(spark, model, f"{path}/epoch={epoch}", state=state, meta=meta, mode="overwrite")
    for n in snapshots(spark, path):
        if n < epoch - 1:
            remove_path(spark, f"{path}/epoch={n}")


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """Epochs of the complete snapshots below ``path``, ascending."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/epoch=*/_SUCCESS")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def scan_layers(spark: SparkSession, path: str, *, after: str | None = None, upto: str | None = None) -> DataFrame:
    """The rows of a model table for the layers behind ``after`` up to ``upto`` (and the run
    counters). The layer range is a pushed filter: row groups of other layers aren't read."""
    table = spark.read.schema(SCHEMA).parquet(path)
    if after is None and upto is None:
        return table
    place = {r.name: r.layer for r in table.filter("layer >= 0").select("layer", "name").distinct().collect()}  # one a layer
    for name in (after, upto):
        if name is not None and name not in place:
            raise ValueError(f"no layer named {name!r}; layers are {sorted(place, key=place.get)}")
    lo = place[after] + 1 if after is not None else 0
    hi = place[upto] if upto is not None else max(place.values())
    if lo > hi:
        raise ValueError(f"no layers after {after!r}" + (f" up to {upto!r}" if upto is not None else ""))
    layer = F.col("layer")
    return table.filter((layer < 0) | ((layer >= lo) & (layer <= hi)))


def read_model(spark: SparkSession, path: str, *, after: str | None = None,
               upto: str | None = None) -> tuple[Model, dict[str, np.ndarray], dict[str, float]]:
    """Load a model table (S6), or the newest complete snapshot below ``path`` → (model,
    optimizer state, meta counters). With ``after`` / ``upto`` only those layers are read:
    ``Model.after(...)``, ``Model.upto(...)`` of the whole model."""
    if done := snapshots(spark, path):
        path = f"{path}/epoch={done[-1]}"
    return model_from_rows(scan_layers(spark, path, after=after, upto=upto).toPandas())
