import pytest
from pyspark.sql import functions as F

from headstart.functions import labels as L


def test_path_label_whole_string(spark):
    rows = [("/img/train/003.c/003_0001.jpg", 2), ("a/257_9999.jpg", 256), ("/x/003_0001.jpg.bak", None),
            ("003_0001.jpg", None), ("/x/03_0001.jpg", None), ("/x/003_001.jpg", None), ("/x/000_0001.jpg", -1)]
    df = spark.createDataFrame(rows, "path string, want int")
    got = df.select("want", L.path_label("path").alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_path_validation_rejects_and_drops(spark):
    df = spark.createDataFrame([("/a/001_0001.jpg",), ("/a/000_0001.jpg",), ("nope",)], "path string")
    assert L.with_path_label(df, on_bad="drop", n_classes=257).count() == 1
    with pytest.raises(Exception, match="no class number in image path: nope|000_0001"):
        L.with_path_label(df, n_classes=257).collect()
    with pytest.raises(ValueError):
        L.with_path_label(df, on_bad="skip")


def test_path_label_class_bound(spark):
    df = spark.createDataFrame([("/a/011_0001.jpg",)], "path string")
    with pytest.raises(Exception, match="no class number"):
        L.with_path_label(df, n_classes=10).collect()


@pytest.mark.parametrize("vec,want", [([0.0, 0.0], None), ([-0.0, float("nan")], 1), ([0.0, -2.0], 1),
                                      ([], None), ([0.0, 1.0, 1.0], 1), ([1.0], 0)])
def test_onehot_decode_edges(spark, vec, want):
    df = spark.createDataFrame([(vec,)], "a array<float>")
    q = df.select(L.onehot_decode("a").alias("l"))
    if want is None:
        with pytest.raises(Exception, match="no non-zero"):
            q.collect()
    else:
        assert q.first().l == want


def test_onehot_encode_roundtrip_and_range(spark):
    df = spark.range(10).select(F.col("id").cast("int").alias("label"))
    enc = df.select("label", L.onehot_encode(F.col("label"), 10).alias("y"))
    back = enc.select("label", L.onehot_decode("y").alias("d")).filter("label != d")
    assert back.count() == 0
    assert enc.select(F.size("y")).distinct().first()[0] == 10
    bad = spark.createDataFrame([(-1,), (10,)], "label int")
    with pytest.raises(Exception, match="label outside"):
        bad.select(L.onehot_encode(F.col("label"), 10)).collect()


def test_labeled_points(spark, emb):
    pts = L.to_labeled_points(emb, features="embedding")
    assert [f.name for f in pts.schema] == ["label", "features"]
    assert pts.schema["label"].dataType.simpleString() == "double"
    assert pts.first().features.size == 64
