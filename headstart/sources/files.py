"""File sources: recursive binary scan (S1), image decode + resize (S2), split folders.

Decoding is Spark's own ``image`` source (JVM, one file per row, BGR bytes). The resize
to the network's input size is an Arrow batch operator (numpy), one output row per file.
A file that does not decode fails the job by default (the reference has no handler);
``on_invalid="drop"`` leaves it out, ``"keep"`` keeps it with a height of -1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .features import SPLIT_FROM_IMAGE_PATH

# Fixed values of the reference's input: 224 × 224 pixels, 3 channels.
IMAGE_HEIGHT, IMAGE_WIDTH, IMAGE_CHANNELS = 224, 224, 3
#: Images decoded at a time: 64 × 224 × 224 × 3 floats are 38 MB.
TENSOR_ROWS = 64


def scan_binary(spark: SparkSession, path: str, *, recursive: bool = True,
                glob: str | None = None) -> DataFrame:
    """Every file below ``path`` as ``path, modificationTime, length, content``.

    No name filter by default: stray files must reach the label check, which rejects them.
    """
    r = spark.read.format("binaryFile")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def scan_images(spark: SparkSession, path: str | list[str], *, recursive: bool = True,
                on_invalid: str = "error") -> DataFrame:
    """Decoded images ``path, height, width, n_channels, mode, data`` (BGR, row-wise)."""
    r = spark.read.format("image")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return _image_columns(r.load(path), on_invalid)


def stream_images(spark: SparkSession, path: str, *, recursive: bool = True, on_invalid: str = "error",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """The same columns as :func:`scan_images` from a streaming file source: new files in
    the folder are picked up by the next trigger."""
    from pyspark.ml.image import ImageSchema

    r = spark.readStream.format("image").schema(ImageSchema.imageSchema)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _image_columns(r.load(path), on_invalid)


def _image_columns(raw: DataFrame, on_invalid: str) -> DataFrame:
    df = raw.select(F.col("image.origin").alias("path"), F.col("image.height").alias("height"),
                    F.col("image.width").alias("width"), F.col("image.nChannels").alias("n_channels"),
                    F.col("image.mode").alias("mode"), F.col("image.data").alias("data"))
    bad = F.col("height") < 0
    if on_invalid == "drop":
        return df.filter(~bad)
    if on_invalid == "keep":
        return df
    if on_invalid != "error":
        raise ValueError("on_invalid must be 'error', 'drop' or 'keep'")
    return df.withColumn("height", F.when(~bad, F.col("height")).otherwise(
        F.raise_error(F.concat(F.lit("Could not decode image: "), F.col("path"))).cast("int")))


def with_split_from_path(df: DataFrame, path: str = "path", out: str = "split") -> DataFrame:
    """``split`` = the ``train``/``test``/``valid`` folder the file sits in."""
    return df.withColumn(out, F.regexp_extract(F.col(path), SPLIT_FROM_IMAGE_PATH, 1))


def _resize_nearest(img: np.ndarray, h: int, w: int) -> np.ndarray:
    src_h, src_w = img.shape[:2]
    rows = (np.arange(h) * src_h // h).clip(0, src_h - 1)
    cols = (np.arange(w) * src_w // w).clip(0, src_w - 1)
    return img[rows][:, cols]


def _resize_bilinear(img: np.ndarray, h: int, w: int) -> np.ndarray:
    src_h, src_w = img.shape[:2]
    y = (np.arange(h) + 0.5) * src_h / h - 0.5
    x = (np.arange(w) + 0.5) * src_w / w - 0.5
    y0 = np.floor(y).astype(int).clip(0, src_h - 1)
    x0 = np.floor(x).astype(int).clip(0, src_w - 1)
    y1, x1 = (y0 + 1).clip(0, src_h - 1), (x0 + 1).clip(0, src_w - 1)
    wy = (y - np.floor(y)).clip(0, 1)[:, None, None]
    wx = (x - np.floor(x)).clip(0, 1)[None, :, None]
    a, b = img[y0][:, x0], img[y0][:, x1]
    c, d = img[y1][:, x0], img[y1][:, x1]
    return (a * (1 - wx) + b * wx) * (1 - wy) + (c * (1 - wx) + d * wx) * wy


IMAGE_INPUTS = ["height", "width", "n_channels", "data"]


def image_decoder(height: int = IMAGE_HEIGHT, width: int = IMAGE_WIDTH, channels: int = IMAGE_CHANNELS,
                  method: str = "nearest"):
    """Batch function: decoded-image columns → ``rows × (height·width·channels)`` RGB floats
    (0–255, row-major). Grey images are repeated to 3 channels, alpha is dropped."""
    if method not in ("nearest", "bilinear"):
        raise ValueError("method must be 'nearest' or 'bilinear'")
    resize = _resize_nearest if method == "nearest" else _resize_bilinear

    def decode(rb: pa.RecordBatch) -> np.ndarray:
        hs = rb.column(rb.schema.get_field_index("height")).to_numpy(zero_copy_only=False)
        ws = rb.column(rb.schema.get_field_index("width")).to_numpy(zero_copy_only=False)
        cs = rb.column(rb.schema.get_field_index("n_channels")).to_numpy(zero_copy_only=False)
        data = rb.column(rb.schema.get_field_index("data"))
        out = np.empty((rb.num_rows, height * width * channels), dtype=np.float32)
        for k in range(rb.num_rows):
            h, w, c = int(hs[k]), int(ws[k]), int(cs[k])
            img = np.frombuffer(data[k].as_buffer(), dtype=np.uint8).reshape(h, w, c).astype(np.float32)
            img = img[:, :, [2, 1, 0]] if c >= 3 else np.repeat(img[:, :, :1], 3, axis=2)  # BGR(A) → RGB
            out[k] = resize(img[:, :, :channels], height, width).reshape(-1)
        return out

    return decode


def to_tensor(images: DataFrame, *, height: int = IMAGE_HEIGHT, width: int = IMAGE_WIDTH,
              channels: int = IMAGE_CHANNELS, method: str = "nearest", out: str = "features",
              keep: list[str] | None = None) -> DataFrame:
    """Resized images as ``array<float>`` (S2). To score images, pass :func:`image_decoder`
    to ``featurize`` instead: decoding and scoring then share one pass through Python."""
    decode = image_decoder(height, width, channels, method)
    ship_package(images.sparkSession)
    keep = [c for c in images.columns if c not in IMAGE_INPUTS + ["mode"]] if keep is None else list(keep)
    src = images.select(*keep, *[c for c in IMAGE_INPUTS if c not in keep])
    schema = T.StructType([src.schema[c] for c in keep]
                          + [T.StructField(out, T.ArrayType(T.FloatType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for at in range(0, rb.num_rows, TENSOR_ROWS):
                part = rb.slice(at, TENSOR_ROWS)
                m = decode(part)
                offsets = pa.array(np.arange(0, m.size + 1, max(1, m.shape[1]), dtype=np.int32)[: part.num_rows + 1])
                arr = pa.ListArray.from_arrays(offsets, pa.array(m.ravel(), type=pa.float32()))
                cols = [part.column(part.schema.get_field_index(c)) for c in keep] + [arr]
                yield pa.RecordBatch.from_arrays(cols, names=keep + [out])

    return src.mapInArrow(run, schema)
