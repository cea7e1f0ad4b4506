"""Two-phase commits of split folders.

A write stages its files in ``root/_staging-<id>``, moves them to ``root/<split>`` and then
creates ``root/_commit-<number>.json``, which names the writes (by the id that Spark puts into
every file name of a job) that the folders consist of. Creating it is one rename, so a reader
sees all of a write or nothing: it takes the manifest with the highest number and only files of
the writes named there. What a crash leaves behind is never read; the next write removes it.
One writer at a time: of two that race for a number, the second fails.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

_MANIFEST = re.compile(r"^_commit-(\d+)\.json$")
_STAGING = "_staging-"
_WRITE_ID = re.compile(r"^part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})")


class Folder:
    """A root folder of splits on Spark's Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.base = self.jvm.org.apache.hadoop.fs.Path(root)
        self.fs = self.base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, *names: str):
        p = self.base
        for n in names:
            p = self.jvm.org.apache.hadoop.fs.Path(p, n)
        return p

    def names(self, *below: str) -> list[str]:
        p = self.path(*below)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def manifest(self) -> dict | None:
        """The newest manifest, ``{"number", "writes", "splits"}``; None if nothing was committed."""
        numbers = [int(m[1]) for m in map(_MANIFEST.match, self.names()) if m]
        if not numbers:
            return None
        stream = self.fs.open(self.path(f"_commit-{max(numbers)}.json"))
        try:
            text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def unfinished(self) -> bool:
        """Whether a write was begun and not committed, or not cleaned up after."""
        return any(n.startswith(_STAGING) for n in self.names())

    def move(self, src, dst) -> None:
        if not self.fs.rename(src, dst):
            raise RuntimeError(f"could not rename {src} to {dst}")

    def publish(self, manifest: dict) -> None:
        tmp = self.path(f"_new-{uuid.uuid4().hex}")
        out = self.fs.create(tmp)
        out.write(json.dumps(manifest, sort_keys=True).encode())
        out.close()
        target = self.path(f"_commit-{manifest['number']}.json")
        if self.fs.exists(target):
            raise RuntimeError(f"another writer has committed {target}")
        self.move(tmp, target)

    def clean(self, manifest: dict) -> None:
        """Remove whatever the manifest doesn't name: staged, replaced and abandoned files, older manifests."""
        for n in self.names():
            m = _MANIFEST.match(n)
            if n.startswith((_STAGING, "_new-")) or (m and int(m[1]) < manifest["number"]):
                self.fs.delete(self.path(n), True)
            elif not n.startswith(("_", ".")):
                for f in self.names(n):
                    w = _WRITE_ID.match(f)
                    if w and w[1] not in manifest["writes"]:
                        self.fs.delete(self.path(n, f), False)
                if not self.names(n):
                    self.fs.delete(self.path(n), True)


def commit_splits(df: DataFrame, root: str, split: str, mode: str) -> None:
    """Write ``df`` to one plain folder per value of ``split`` below ``root``, all or nothing.

    ``mode``: ``errorifexists``, ``ignore``, ``overwrite`` or ``append``, decided by what is
    committed: the rest of a failed write doesn't count as existing. The input's lineage runs
    once. A new folder is moved as a whole, files for an existing one are moved one by one.
    """
    if mode not in ("error", "errorifexists", "ignore", "overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    at = Folder(df.sparkSession, root)
    old = at.manifest()
    foreign = old is None and bool(at.names()) and not at.unfinished()
    if old is not None or foreign:
        if mode == "ignore":
            return
        if mode in ("error", "errorifexists"):
            raise FileExistsError(f"{root} already exists")
        if foreign and mode == "append":
            raise ValueError(f"{root} has no commit to append to")
    if foreign:  # overwrite of a folder that wasn't written here
        at.fs.delete(at.base, True)
    staging = f"{_STAGING}{uuid.uuid4().hex}"
    df.write.partitionBy(split).parquet(at.path(staging).toString())
    writes, splits = set(), {}
    for folder in at.names(staging):
        if not folder.startswith(f"{split}="):
            continue
        name = folder.split("=", 1)[1]
        files = [f for f in at.names(staging, folder) if _WRITE_ID.match(f)]
        writes |= {_WRITE_ID.match(f)[1] for f in files}
        splits[name] = len(files)
        if at.fs.exists(at.path(name)):
            for f in files:
                at.move(at.path(staging, folder, f), at.path(name, f))
        else:
            at.move(at.path(staging, folder), at.path(name))
    if mode == "append" and old is not None:
        writes |= set(old["writes"])
        splits = {s: splits.get(s, 0) + old["splits"].get(s, 0) for s in splits.keys() | old["splits"].keys()}
    manifest = {"number": (old["number"] if old else 0) + 1, "writes": sorted(writes), "splits": splits}
    at.publish(manifest)
    at.clean(manifest)


def committed(spark: SparkSession, root: str) -> dict | None:
    """The newest manifest below ``root``; None for folders written elsewhere, without one. A
    root with an unfinished first write is refused."""
    at = Folder(spark, root)
    found = at.manifest()
    if found is None and at.unfinished():
        raise FileNotFoundError(f"{root} holds a write that was never committed")
    return found
