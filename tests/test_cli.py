import pytest

from headstart.__main__ import main, parser
from headstart.operators.ordering import split_fixed, with_position
from headstart.session import scratch_path
from headstart.sources.features import write_features

from .conftest import SF01


def test_cli_train_continue_and_score(spark):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet").withColumnRenamed("embedding", "features") \
        .withColumnRenamed("vec_id", "id")
    root = scratch_path(spark, "t-cli")
    write_features(split_fixed(with_position(emb, "id", 42), 50, 60).drop("pos"), root)
    m1, m2 = scratch_path(spark, "t-cli-m1"), scratch_path(spark, "t-cli-m2")
    common = ["--batchSize", "16", "--averagingFrequency", "2", "--workers", "2", "--validationInterval", "1"]
    out = main(["train", "--train", f"{root}/split=train", "--valid", f"{root}/split=valid", "--save", m1,
                "--inputLayer", "fc2", "--numIn", "64", "--numClasses", "10", "--epochs", "1", "--rate", "0.01",
                "--dropout", "0.1", "--updater", "ADAM"] + common, spark=spark)
    assert [h["split"] for h in out["history"]] == ["train", "valid"]
    out = main(["train-incremental", "--train", f"{root}/split=train", "--model", m1, "--save", m2,
                "--learningRateSchedule", "0,0.1|3,0.01|3,0.05"] + common, spark=spark)
    assert out["history"][0]["epoch"] == 1  # continues after the saved epoch
    metrics = main(["score", "--test", f"{root}/split=test", "--model", m2], spark=spark)["metrics"]
    assert metrics["n"] == 60


def test_cli_checks_arguments_before_spark():
    with pytest.raises(SystemExit):
        parser().parse_args(["train", "--inputLayer", "fc2", "--numIn", "4"])  # --train missing
    with pytest.raises(SystemExit):
        parser().parse_args(["train-incremental", "--train", "x", "--model", "m"])  # --save missing


def test_cli_featurize_with_a_model_table_and_initial_model(spark):
    import tempfile

    from headstart.sources.models import read_model, write_model

    from .test_files import _small_chain, _write_tree

    root = tempfile.mkdtemp(prefix="hs-cli-img-")
    want = _write_tree(root, n=9, junk=False)
    model_path = scratch_path(spark, "t-cli-chain")
    write_model(spark, _small_chain(), model_path)
    out = scratch_path(spark, "t-cli-feats")
    main(["featurize", "--imagePath", root, "--savePath", out, "--modelPath", model_path, "--outputLayer", "fc1",
          "--numClasses", "4", "--height", "6", "--width", "5"], spark=spark)
    feats = spark.read.parquet(out)
    assert feats.count() == len(want) and feats.schema["features"].dataType.simpleString() == "array<float>"
    init = scratch_path(spark, "t-cli-init")
    main(["save-initial-model", "--save", init, "--predictAfter", "predictions", "--numIn", "7",
          "--numClasses", "4"], spark=spark)
    model, _, meta = read_model(spark, init)
    assert model.n_in == 7 and model.n_out == 4 and meta["momentum"] == 0.98


def test_cli_train_takes_the_width_from_the_input_layer(spark):
    from pyspark.sql import functions as F

    from headstart.sources.models import read_model

    emb = spark.read.parquet(f"{SF01}/embeddings.parquet").filter("vec_id < 64")
    path, save, hist = (scratch_path(spark, f"t-cli-{n}") for n in ("wide", "wide-model", "wide-history"))
    emb.select(F.col("vec_id").alias("id"), F.flatten(F.array_repeat("embedding", 64)).alias("features"), "label").write.parquet(path)
    main(["train", "--train", path, "--valid", path, "--save", save, "--inputLayer", "fc2", "--numClasses", "10", "--epochs", "2",
          "--validationInterval", "1", "--rate", "0.01", "--batchSize", "32", "--averagingFrequency", "5", "--momentum", "0.9",
          "--reg", "0.05", "--updater", "nesterovs", "--workers", "2", "--history", hist], spark=spark)
    assert read_model(spark, save)[0].n_in == 4096
    assert sorted((r.epoch, r.split) for r in spark.read.parquet(hist).collect()) == [
        (0, "train"), (0, "valid"), (1, "train"), (1, "valid")]
