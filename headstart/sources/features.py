"""Feature tables: scan (S3), split-wise scan (S4), write one folder per split (K1).

A feature table is Parquet with a row id, ``array<float>`` features and an ``int`` label
(no opaque blobs), so Catalyst prunes columns and pushes label / split filters into the
scan. Splits are a ``split`` column written with ``partitionBy`` (partition pruning gives
the reference's one-folder-per-split I/O).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .commits import commit_splits, committed

SPLITS = ("train", "test", "valid")
# Fixed value: split folders are named train, test and valid. Patterns are anchored at the
# end of the path, so a parent folder with one of those names is never taken for the split.
SPLIT_FOLDER = r"/(train|test|valid)/[^/]+$"            # root/{split}/part-….parquet
SPLIT_FROM_IMAGE_PATH = r"/(train|test|valid)/[^/]+/[^/]+$"  # root/{split}/{ddd}.{name}/{file}


def require_not_null(df: DataFrame, cols: list[str], on_null: str = "error") -> DataFrame:
    """Null in any of ``cols``: fail the job (default, like the reference) or drop the row."""
    if on_null == "drop":
        cond = None
        for c in cols:
            cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
        return df.filter(cond)
    if on_null != "error":
        raise ValueError(f"on_null must be 'error' or 'drop', not {on_null!r}")
    for c in cols:
        df = df.withColumn(c, F.when(F.col(c).isNotNull(), F.col(c)).otherwise(
            F.raise_error(F.lit(f"null in column {c}"))))
    return df


def read_features(spark: SparkSession, path: str, *, features: str = "embedding", label: str = "label",
                  columns: list[str] | None = None, recursive: bool = False,
                  on_null: str = "error") -> DataFrame:
    """Scan a feature table; ``columns`` = extra columns to keep (e.g. the id).

    ``on_null="error"`` (default): a null feature vector or label fails the job where it is
    consumed (scoring, training and the label functions refuse nulls). No check is added
    to the plan here, so label filters still reach the Parquet reader and an id-only query
    still reads only the id. ``"drop"`` adds ``IsNotNull`` filters (pushed to the reader).
    """
    if on_null not in ("error", "drop"):
        raise ValueError(f"on_null must be 'error' or 'drop', not {on_null!r}")
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.parquet(path)
    keep = list(columns if columns is not None else [c for c in df.columns if c not in (features, label)])
    df = df.select(*keep, features, label)
    return require_not_null(df, [features, label], "drop") if on_null == "drop" else df


def split_paths(spark: SparkSession, root: str) -> list[str]:
    """The split folders that exist below ``root``."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [f"{root.rstrip('/')}/{s}" for s in SPLITS if fs.exists(jvm.org.apache.hadoop.fs.Path(base, s))]
    if not found:
        raise FileNotFoundError(f"none of the folders {', '.join(SPLITS)} in {root}")
    return found


def read_split_folders(spark: SparkSession, root: str, *, fmt: str = "parquet") -> DataFrame:
    """One scan of the folders ``train``, ``test`` and ``valid`` below ``root`` with a ``split``
    column taken from each file's path (S4); a single job, and nothing else below ``root`` is read.
    Where :func:`write_split_folders` wrote them, only files of committed writes are read, and
    a root whose first write was never committed is refused."""
    manifest = committed(spark, root)
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true")
    if manifest is None:
        paths = split_paths(spark, root)
    else:
        paths = [f"{root.rstrip('/')}/{s}" for s in SPLITS if s in manifest["splits"]]
        if not paths:
            raise FileNotFoundError(f"none of the folders {', '.join(SPLITS)} in {root}")
        reader = reader.option("pathGlobFilter", "*{" + ",".join(manifest["writes"]) + "}*")
    return reader.load(paths).withColumn("split", F.regexp_extract(F.col("_metadata.file_path"), SPLIT_FOLDER, 1))


def write_features(df: DataFrame, path: str, *, split: str | None = "split",
                   mode: str = "errorifexists") -> None:
    """Write a feature table, one folder per split; fails when the target exists (K1)."""
    w = df.write.mode(mode)
    if split is not None:
        w = w.partitionBy(split)
    w.parquet(path)


def write_split_folders(df: DataFrame, root: str, *, split: str = "split",
                        mode: str = "errorifexists") -> None:
    """The reference's layout: ``root/train``, ``root/test``, ``root/valid`` as plain folders
    (no ``split=`` prefix), whatever the names. One partitioned write (the input's lineage runs
    once) to a staging folder, renames through Spark's Hadoop file system (a metadata operation
    on a file system, a copy on an object store), and a manifest written last: see
    :func:`headstart.sources.commits.commit_splits`. Read back with :func:`read_split_folders`."""
    commit_splits(df, root, split, mode)


def to_packed(df: DataFrame, features: str = "features", out: str | None = None) -> DataFrame:
    """``array<float|double>`` features → packed little-endian float32 ``binary`` (the
    layout that crosses the JVM/Python boundary fastest: one copy per row, no per-element
    conversion). Values are rounded to float32."""
    return _convert(df, features, out or features, packed=True)


def to_array(df: DataFrame, features: str = "features", out: str | None = None) -> DataFrame:
    """Packed float32 ``binary`` features → ``array<float>`` (readable from SQL)."""
    return _convert(df, features, out or features, packed=False)


def _convert(df: DataFrame, src: str, out: str, packed: bool) -> DataFrame:
    import pyarrow as pa
    from pyspark.sql import types as T

    from ..operators.arrowbatch import list_matrix, matrix_list, pack_rows
    from ..session import ship_package

    ship_package(df.sparkSession)
    keep = [c for c in df.columns if c not in (src, out)]
    out_t = T.BinaryType() if packed else T.ArrayType(T.FloatType(), False)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, out_t, False)])

    def run(batches):
        for rb in batches:
            m = list_matrix(rb.column(rb.schema.get_field_index(src)))
            enc = pack_rows(m) if packed else matrix_list(m, pa.float32())
            cols = [rb.column(rb.schema.get_field_index(c)) for c in keep] + [enc]
            yield pa.RecordBatch.from_arrays(cols, names=keep + [out])

    return df.select(*keep, src).mapInArrow(run, schema)
