import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from headstart.model import dense, init_params
from headstart.plans.derived_images import png_bytes
from headstart.plans.programs import featurize_images
from headstart.sources.files import scan_binary, scan_images, to_tensor, with_split_from_path
from headstart.streaming.featurize_stream import featurize_stream


def _write_tree(root, n=12, junk=True):
    rng = np.random.default_rng(0)
    want = {}
    for k in range(n):
        split = ("train", "test", "valid")[k % 3]
        label = k % 4
        d = os.path.join(root, split, f"{label + 1:03d}.thing")
        os.makedirs(d, exist_ok=True)
        img = rng.integers(0, 256, size=(6, 5, 3))
        p = os.path.join(d, f"{label + 1:03d}_{k:04d}.jpg")
        with open(p, "wb") as f:
            f.write(png_bytes(img))
        want[p] = (split, label, img)
    if junk:
        with open(os.path.join(root, "train", "junk.jpg"), "wb") as f:
            f.write(b"not an image")
    return want


def test_binary_scan_sees_every_file(spark):
    root = tempfile.mkdtemp(prefix="hs-bin-")
    want = _write_tree(root)
    files = scan_binary(spark, root)
    assert files.count() == len(want) + 1
    assert set(files.columns) == {"path", "modificationTime", "length", "content"}


def test_image_decode_rgb_order_and_resize(spark):
    root = tempfile.mkdtemp(prefix="hs-img-")
    want = _write_tree(root, junk=False)
    imgs = with_split_from_path(scan_images(spark, root))
    t = to_tensor(imgs, height=6, width=5, keep=["path", "split"]).collect()
    assert len(t) == len(want)
    for r in t:
        split, _, img = want[r.path.replace("file://", "").replace("file:", "")]
        assert r.split == split
        assert np.array_equal(np.asarray(r.features).reshape(6, 5, 3), img.astype(np.float32))
    big = to_tensor(imgs, height=12, width=10, method="bilinear", keep=["path"]).first()
    assert len(big.features) == 12 * 10 * 3


def test_undecodable_image_fails_or_is_dropped(spark):
    root = tempfile.mkdtemp(prefix="hs-junk-")
    want = _write_tree(root)
    with pytest.raises(Exception, match="Could not decode image"):
        scan_images(spark, root).collect()
    assert scan_images(spark, root, on_invalid="drop").count() == len(want)


def _small_chain():
    return init_params([dense("fc1", 6 * 5 * 3, 7, "relu"), dense("predictions", 7, 4, "softmax")],
                       scheme="fixture")


def test_featurize_images_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="hs-feat-")
    want = _write_tree(root, junk=False)
    out = os.path.join(tempfile.mkdtemp(prefix="hs-out-"), "features")
    featurize_images(spark, root, out, n_classes=4, model=_small_chain(), output_layer="fc1",
                     height=6, width=5, with_onehot=True)
    df = spark.read.parquet(out)
    assert df.count() == len(want)
    assert set(r.split for r in df.select("split").distinct().collect()) == {"train", "test", "valid"}
    r = df.first()
    assert len(r.features) == 7 and sum(r.label_onehot) == 1.0
    with pytest.raises(Exception):  # default mode refuses an existing target
        featurize_images(spark, root, out, n_classes=4, model=_small_chain(), output_layer="fc1",
                         height=6, width=5)
    with pytest.raises(ValueError):
        featurize_images(spark, root, out + "2", n_classes=4, model=_small_chain(), output_layer="nope",
                         height=6, width=5)


def test_bad_path_fails_featurization(spark):
    root = tempfile.mkdtemp(prefix="hs-bad-")
    _write_tree(root, n=3, junk=False)
    os.makedirs(os.path.join(root, "train", "x"), exist_ok=True)
    with open(os.path.join(root, "train", "x", "12_0001.jpg"), "wb") as f:
        f.write(png_bytes(np.zeros((6, 5, 3))))
    out = os.path.join(tempfile.mkdtemp(prefix="hs-out-"), "f")
    with pytest.raises(Exception, match="no class number in image path"):
        featurize_images(spark, root, out, n_classes=4, model=_small_chain(), output_layer="fc1",
                         height=6, width=5)


def test_streaming_featurization_is_incremental(spark):
    root = tempfile.mkdtemp(prefix="hs-stream-")
    _write_tree(root, n=6, junk=False)
    base = tempfile.mkdtemp(prefix="hs-sout-")
    out, ck = os.path.join(base, "f"), os.path.join(base, "ck")
    kw = dict(n_classes=4, model=_small_chain(), output_layer="fc1", height=6, width=5)
    featurize_stream(spark, root, out, ck, **kw).awaitTermination(120)
    assert spark.read.parquet(out).count() == 6
    d = os.path.join(root, "valid", "002.more")
    os.makedirs(d)
    with open(os.path.join(d, "002_0100.jpg"), "wb") as f:
        f.write(png_bytes(np.ones((6, 5, 3))))
    featurize_stream(spark, root, out, ck, **kw).awaitTermination(120)
    df = spark.read.parquet(out)
    assert df.count() == 7 and df.filter(F.col("path").endswith("002_0100.jpg")).first().label == 1


def test_split_comes_from_the_split_folder_not_a_parent(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="hs-"), "test", "images")  # a parent named "test"
    want = _write_tree(root, n=6, junk=False)
    got = {r.path.replace("file://", "").replace("file:", ""): r.split
           for r in with_split_from_path(scan_images(spark, root)).collect()}
    assert got == {p: v[0] for p, v in want.items()}


def test_images_to_trained_head_end_to_end(spark):
    from headstart.operators.training import FitParams
    from headstart.plans.programs import score_model, train_head
    from headstart.session import scratch_path

    root = tempfile.mkdtemp(prefix="hs-e2e-")
    _write_tree(root, n=24, junk=False)
    feats = scratch_path(spark, "t-e2e-features")
    featurize_images(spark, root, feats, n_classes=4, model=_small_chain(), output_layer="fc1",
                     height=6, width=5)
    table = spark.read.parquet(feats)
    assert table.schema["id"].dataType.simpleString() == "bigint"
    assert table.select("id").distinct().count() == 24
    model_path = scratch_path(spark, "t-e2e-model")
    res = train_head(spark, f"{feats}/split=train", "fc2", n_in=7, n_classes=4, save_path=model_path,
                     params=FitParams(epochs=2, workers=2, batch_size=2, avg_freq=2, rate=0.05, keep_prob=0.9,
                                      eval_interval=1), valid_path=f"{feats}/split=valid")
    assert len(res.history) == 4
    m = score_model(spark, model_path, f"{feats}/split=test").first()
    assert m.n == 8
    bad = spark.createDataFrame([("a", [0.0] * 7, 1)], "id string, features array<float>, label int")
    from headstart.operators.training import fit

    with pytest.raises(ValueError, match="must be an integer type"):
        fit(bad, res.model, FitParams(), id_col="id")


def test_featurize_into_plain_split_folders(spark):
    from headstart.sources.features import read_split_folders

    root = tempfile.mkdtemp(prefix="hs-folders-")
    want = _write_tree(root, n=9, junk=False)
    out = os.path.join(tempfile.mkdtemp(prefix="hs-out-"), "feats")
    featurize_images(spark, root, out, n_classes=4, model=_small_chain(), output_layer="fc1", height=6, width=5,
                     split_folders=True)
    assert sorted(d for d in os.listdir(out) if not d.startswith(("_", "."))) == ["test", "train", "valid"]
    back = {r.path.replace("file://", "").replace("file:", ""): r.split for r in read_split_folders(spark, out).collect()}
    assert back == {p: v[0] for p, v in want.items()}


def test_rejects_are_counted_in_the_featurizing_pass(spark):
    from headstart.sources.features import read_split_folders

    root = tempfile.mkdtemp(prefix="hs-rejects-")
    want = _write_tree(root, n=9, junk=False)
    for name, content in (("train/x/12_0001.jpg", png_bytes(np.zeros((6, 5, 3)))), ("train/x/999_0001.jpg", png_bytes(np.zeros((6, 5, 3)))),
                          ("valid/x/001_0009.jpg", b"no image"), ("valid/x/bad_name.txt", b"no image, no class")):
        os.makedirs(os.path.dirname(os.path.join(root, name)), exist_ok=True)
        with open(os.path.join(root, name), "wb") as f:
            f.write(content)
    kw = dict(n_classes=4, model=_small_chain(), output_layer="fc1", height=6, width=5, on_bad="drop")
    for folders in (False, True):
        out = os.path.join(tempfile.mkdtemp(prefix="hs-out-"), "f")
        jobs = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup(f"intake {folders}", "featurize")
        seen = featurize_images(spark, root, out, split_folders=folders, **kw)
        assert len(jobs.getJobIdsForGroup(f"intake {folders}")) == 1  # no second scan
        spark.sparkContext._jsc.sc().clearJobGroup()
        assert (seen["files"], seen["bad_images"], seen["bad_paths"]) == (13, 2, 2)
        assert seen["first_bad"].endswith("train/x/12_0001.jpg")
        back = read_split_folders(spark, out) if folders else spark.read.parquet(out)
        assert back.count() == len(want)
        assert featurize_images(spark, root, out, split_folders=folders, mode="ignore", **kw) is None
    empty = os.path.join(tempfile.mkdtemp(prefix="hs-empty-"))
    os.makedirs(os.path.join(empty, "train"))
    seen = featurize_images(spark, empty, os.path.join(empty, "out"), **kw)
    assert (seen["files"], seen["bad_images"], seen["bad_paths"], seen["first_bad"]) == (0, 0, 0, None)
