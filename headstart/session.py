"""Session helpers: a tuned local session for tests/bench and the shared scratch folder.

Scratch data (checkpointed training tables, saved models in examples) goes below the
folder the cluster names in ``spark.checkpoint.dir``. Only when that is unset *and* the
master is local do we create one under the system temp folder (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# Settings recommended for any session that runs the engine (cluster or local):
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # bound Python-side memory for wide rows (4096 floats = 16 KB, images more)
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # remove checkpointed training layouts once their DataFrame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "headstart",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session with the settings the engine expects (AQE on, UI off, UTC, Arrow on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set a local one only in local mode."""
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder "
                           "(HDFS/S3/...) so scratch tables survive executor loss")
    local = tempfile.mkdtemp(prefix="headstart-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name below the checkpoint root (not created)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/headstart/{name}-{uuid.uuid4().hex[:12]}"


def arrow_uri(path: str) -> str:
    """A Hadoop-style path (``/x``, ``file:/x``, ``s3a://b/x``) as a URI pyarrow.fs accepts."""
    if path.startswith("file:") and not path.startswith("file://"):
        return "file://" + path[len("file:"):]
    if path.startswith("/"):
        return "file://" + path
    if path.startswith("s3a://") or path.startswith("s3n://"):
        return "s3://" + path.split("://", 1)[1]
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``headstart`` importable in Python workers: zip it once per application and
    ``addPyFile`` it (Spark distributes the file to every executor)."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(pkg)
    zpath = os.path.join(tempfile.mkdtemp(prefix="headstart-pkg-"), "headstart.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, parent))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a scratch folder through Spark's Hadoop file system (any shared store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(p, True))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its Hadoop file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))
