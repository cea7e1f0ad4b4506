"""Labelled image folders derived from a feature table, for the image-source queries.

Each row becomes an 8 × 8 RGB PNG at ``{root}/{split}/{ddd}.c{id div 10000}/{ddd}_{dddd}.jpg``
(``ddd`` = label + 1, ``dddd`` = id mod 10000; the extra folder level keeps names unique
at any id range). Pixel ``k`` (row-major) of row ``x``: ``p = clamp(floor((x[k] + 0.5)·256),
0, 255)``, colour ``(p, p div 2, 25·label)``. Pixels are computed by Spark; tasks only
encode and write, with deterministic names and bytes, so a retried task rewrites the same
files. The decoder sniffs content, so PNG bytes under a ``.jpg`` name load.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import arrow_uri, ship_package

SIDE = 8


def png_bytes(rgb: np.ndarray) -> bytes:
    """Minimal 8-bit RGB PNG encoder (one IDAT chunk, filter 0)."""
    h, w, _ = rgb.shape
    raw = b"".join(b"\x00" + rgb[r].astype(np.uint8).tobytes() for r in range(h))

    def chunk(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def pixel_column(features: str = "embedding") -> F.Column:
    return F.transform(F.col(features), lambda x: F.least(F.greatest(F.floor((x.cast("double") + 0.5) * 256),
                                                                     F.lit(0)), F.lit(255)).cast("int"))


def image_path_column(root: str, id_col: str = "vec_id", label: str = "label",
                      split: str = "split") -> F.Column:
    d3 = F.lpad((F.col(label) + 1).cast("string"), 3, "0")
    hi = (F.col(id_col) / 10000).cast("long").cast("string")
    d4 = F.lpad(F.pmod(F.col(id_col), F.lit(10000)).cast("string"), 4, "0")
    return F.concat(F.lit(root.rstrip("/") + "/"), F.col(split), F.lit("/"), d3, F.lit(".c"), hi,
                    F.lit("/"), d3, F.lit("_"), d4, F.lit(".jpg"))


def write_images(df: DataFrame, root: str, *, id_col: str = "vec_id", features: str = "embedding",
                 label: str = "label", split: str = "split") -> int:
    """Write one PNG per row below ``root``; returns the number of files written."""
    ship_package(df.sparkSession)
    src = df.select(image_path_column(root, id_col, label, split).alias("path"),
                    pixel_column(features).alias("px"), F.col(label).alias("label"))
    schema = T.StructType([T.StructField("n", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        n = 0
        filesystems: dict[str, pafs.FileSystem] = {}  # one per scheme + authority in a task
        made: set[str] = set()
        for rb in batches:
            paths = rb.column(0).to_pylist()
            px = rb.column(1).to_pylist()
            labels = rb.column(2).to_pylist()
            for path, p, lab in zip(paths, px, labels):
                uri = arrow_uri(path)
                scheme, _, rest = uri.partition("://")
                root = scheme + "://" + (rest.split("/", 1)[0] if scheme != "file" else "")
                if root not in filesystems:
                    filesystems[root] = pafs.FileSystem.from_uri(uri)[0]
                filesystem = filesystems[root]
                rel = pafs.FileSystem.from_uri(uri)[1] if scheme != "file" else rest
                folder = rel.rsplit("/", 1)[0]
                if folder not in made:
                    filesystem.create_dir(folder, recursive=True)
                    made.add(folder)
                p = np.asarray(p, dtype=np.int64).reshape(SIDE, SIDE)
                rgb = np.stack([p, p // 2, np.full_like(p, 25 * lab)], axis=2)
                with filesystem.open_output_stream(rel) as out:
                    out.write(png_bytes(rgb))
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], type=pa.int64())], names=["n"])

    return int(src.mapInArrow(run, schema).agg(F.sum("n")).first()[0] or 0)
