import os

from headstart.session import arrow_uri, checkpoint_root, remove_path, scratch_path


def test_scratch_lives_below_the_checkpoint_folder(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/") + "/headstart/x-")
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:  # the session's own setting wins over any local default
        assert conf_dir.rstrip("/") in root


def test_arrow_uris():
    assert arrow_uri("/tmp/a") == "file:///tmp/a"
    assert arrow_uri("file:/tmp/a") == "file:///tmp/a"
    assert arrow_uri("file:///tmp/a") == "file:///tmp/a"
    assert arrow_uri("s3a://bucket/k") == "s3://bucket/k"
    assert arrow_uri("hdfs://nn:8020/x") == "hdfs://nn:8020/x"


def test_remove_path(spark):
    p = scratch_path(spark, "rm")
    spark.range(3).write.parquet(p)
    local = p[len("file:"):] if p.startswith("file:") else p
    assert os.path.exists(local)
    assert remove_path(spark, p) and not os.path.exists(local)
