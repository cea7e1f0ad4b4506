"""Split folders are committed as a whole: a crash at any step shows the old rows or none."""

import os

import pytest

from headstart.session import scratch_path
from headstart.sources import commits
from headstart.sources.features import read_split_folders, write_split_folders


def _rows(spark, lo, hi):
    return spark.createDataFrame([(i, ("train", "test", "valid")[i % 3]) for i in range(lo, hi)], "id long, split string")


def _read(spark, root):
    return sorted((r.id, r.split) for r in read_split_folders(spark, root).select("id", "split").collect())


def _want(spark, lo, hi):
    return sorted(map(tuple, _rows(spark, lo, hi).collect()))


def _crash_after(monkeypatch, steps):
    """The file system fails once ``steps`` moves are done (the manifest's is the last one)."""
    done, move = [], commits.Folder.move

    def failing(self, src, dst):
        if len(done) == steps:
            raise RuntimeError("lost")
        done.append(dst)
        move(self, src, dst)

    monkeypatch.setattr(commits.Folder, "move", failing)


@pytest.mark.parametrize("steps", [0, 1, 2, 3])
def test_crash_of_a_first_write_is_refused_and_a_retry_works(spark, monkeypatch, steps):
    root = scratch_path(spark, "t-commit")
    with monkeypatch.context() as m:
        _crash_after(m, steps)
        with pytest.raises(RuntimeError, match="lost"):
            write_split_folders(_rows(spark, 0, 30), root)
    with pytest.raises(FileNotFoundError, match="never committed"):
        read_split_folders(spark, root)
    write_split_folders(_rows(spark, 100, 130), root)  # nothing was committed, so nothing exists
    assert _read(spark, root) == _want(spark, 100, 130)
    files = spark.read.option("recursiveFileLookup", "true").parquet(root)
    assert files.count() == 30  # the abandoned files are gone


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_crash_of_a_later_write_leaves_the_committed_rows(spark, monkeypatch, mode):
    root = scratch_path(spark, "t-commit")
    write_split_folders(_rows(spark, 0, 30), root)
    with monkeypatch.context() as m:
        _crash_after(m, 2)
        with pytest.raises(RuntimeError, match="lost"):
            write_split_folders(_rows(spark, 30, 60), root, mode=mode)
    assert _read(spark, root) == _want(spark, 0, 30)
    write_split_folders(_rows(spark, 60, 90), root, mode=mode)
    assert _read(spark, root) == (_want(spark, 60, 90) if mode == "overwrite" else _want(spark, 0, 30) + _want(spark, 60, 90))


def test_modes(spark):
    root = scratch_path(spark, "t-commit")
    write_split_folders(_rows(spark, 0, 30), root)
    with pytest.raises(FileExistsError):
        write_split_folders(_rows(spark, 30, 60), root)
    write_split_folders(_rows(spark, 30, 60), root, mode="ignore")
    assert _read(spark, root) == _want(spark, 0, 30)
    write_split_folders(_rows(spark, 30, 60).filter("split = 'test'"), root, mode="overwrite")
    assert {s for _, s in _read(spark, root)} == {"test"}
    with pytest.raises(ValueError, match="unknown mode"):
        write_split_folders(_rows(spark, 0, 1), root, mode="replace")


def test_folders_written_elsewhere_are_read_and_not_appended_to(spark):
    root = scratch_path(spark, "t-foreign")
    for s in ("train", "test"):
        _rows(spark, 0, 30).filter(f"split = '{s}'").drop("split").write.parquet(f"{root}/{s}")
    assert len(_read(spark, root)) == 20
    with pytest.raises(ValueError, match="no commit"):
        write_split_folders(_rows(spark, 0, 30), root, mode="append")
    write_split_folders(_rows(spark, 0, 30), root, mode="overwrite")
    assert _read(spark, root) == _want(spark, 0, 30)


def test_a_second_writer_of_the_same_number_fails(spark):
    root = scratch_path(spark, "t-commit")
    write_split_folders(_rows(spark, 0, 3), root)
    at = commits.Folder(spark, root)
    with pytest.raises(RuntimeError, match="another writer"):
        at.publish(at.manifest())
