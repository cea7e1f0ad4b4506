"""The pipeline's stages against brute force, and the pipeline against its stages."""
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from headstart.llm import common, langid, near_dedup, packing, secret_scan, tokens

from ..conftest import SF001
from .conftest import TEXTS
from .test_dedup_lm_pii import _components
from .test_tokens_files import _check_packed


def _key(r):
    return tuple(r.asDict().items())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").repartition(3).cache()
    stages = dict(P.STAGES)
    assert list(stages) == ["language", "dedup", "secrets", "mix", "pack"]

    known = stages["language"](spark, docs, SF001).cache()
    pred = {r.doc_id: r for r in langid.predict(docs.select("doc_id", "text"), langid.train(docs)).collect()}
    want = [r for r in docs.collect() if pred[r.doc_id].lang_pred != "und" and pred[r.doc_id].score >= 0.5]
    assert Counter(map(_key, known.collect())) == Counter(map(_key, want)) and len(want) > 0.9 * len(pred)

    one = stages["dedup"](spark, known, SF001).cache()
    comp, _ = _components([(r.doc_id, r.text) for r in want])
    want = [r for r in want if comp[r.doc_id] == r.doc_id]
    assert Counter(map(_key, one.collect())) == Counter(map(_key, want))

    clean = stages["secrets"](spark, one, SF001).cache()
    got = {r.doc_id: r for r in clean.collect()}
    assert set(got) == {r.doc_id for r in want}
    for r in want:
        text = secret_scan.redact(r.text, secret_scan.find_secrets(r.text)[1])
        assert got[r.doc_id] == r.__class__(doc_id=r.doc_id, text=text, lang=r.lang, source=r.source, n_chars=len(text))

    mixed = stages["mix"](spark, clean, SF001).cache()
    times = Counter(r.doc_id for r in mixed.collect())
    words = {i: len(r.text.encode().split()) for i, r in got.items()}
    size, taken, most = Counter(), Counter(), Counter()
    for i, r in got.items():
        size[r.source] += words[i]
        taken[r.source] += times[i] * words[i]
        most[r.source] = max(most[r.source], words[i])
    names = sorted(size)
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    left, target, open_ = float(sum(size.values())), {}, list(names)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if unit * weight[s] > 3 * size[s]]
        for s in full or open_:
            target[s] = 3.0 * size[s] if full else unit * weight[s]
        left -= sum(target[s] for s in full)
        open_ = [s for s in open_ if s not in full] if full else []
    assert all(abs(taken[s] - target[s]) <= most[s] / 2 + 1 for s in names) and max(times.values()) <= 3
    assert {_key(r) for r in mixed.collect()} <= {_key(r) for r in clean.collect()}

    packed = stages["pack"](spark, mixed, SF001).collect()
    _check_packed([r.asDict() for r in packed], [(r.doc_id, r.text) for r in mixed.collect()])

    run = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in E.queries()["pipeline"](spark, SF001).collect())
    assert run == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)


def test_stages_keep_columns_and_take_edge_rows(spark, edge_docs, no_docs):
    docs = edge_docs
    for name, f in P.STAGES[:-1]:
        out = f(spark, docs, SF001)
        assert out.columns == docs.columns, name
        out = spark.createDataFrame(out.collect(), docs.schema)
        docs = out
    assert docs.count() > 0
    every = [f(spark, edge_docs, SF001).count() for _, f in P.STAGES]
    # two rows repeat an id; words only in six documents
    assert every[1] == len(TEXTS) - 1 and every[2] == len(TEXTS) and every[4] >= len(TEXTS)
    for name, f in P.STAGES:
        assert f(spark, no_docs, SF001).count() == 0, name


@pytest.mark.parametrize("name", ["op1_near_dedup", "op2_pack", "op3_huffman_ids", "op4_secrets", "op5_ann", "op6_topk",
                                  "op7_pii", "op8_langid", "op9_mix", "op10_lm_score"])
def test_registered_queries_have_the_contract_columns(spark, name):
    want = {"op1_near_dedup": "doc_id n_shingles component_id kept",
            "op2_pack": "doc_id piece start length ids_crc32 sequence_id offset",
            "op3_huffman_ids": "doc_id start n_tokens ids_crc32",
            "op4_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
            "op5_ann": "query_id rank vec_id score", "op6_topk": "query_id rank vec_id score",
            "op7_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
            "op8_langid": "doc_id held_out lang_pred score", "op9_mix": "doc_id size source_size target taken",
            "op10_lm_score": "doc_id held_out n_tokens n_known train_tokens base_score score"}
    df = E.queries()[name](spark, SF001)
    assert set(want[name].split()) <= set(df.columns)
    types = dict(df.dtypes)
    for c, t in {"doc_id": "bigint", "n_tokens": "bigint", "score": "bigint" if name == "op6_topk" else "double", "rank": "int",
                 "piece": "int", "kept": "boolean", "held_out": "boolean", "target": "double", "taken": "bigint",
                 "n_shingles": "bigint", "component_id": "bigint", "sequence_id": "bigint", "offset": "bigint"}.items():
        assert types.get(c, t) == t, c
    n = spark.read.parquet(f"{SF001}/documents.parquet").count()
    if name[2] in "134789" and "_ids" not in name:
        assert df.select("doc_id").distinct().count() == n


def test_a_worker_forgets_what_its_last_task_did_not_use(spark, monkeypatch):
    monkeypatch.setattr(common, "_kept", {})
    monkeypatch.setattr(common, "_asked", set())
    vocab = tokens.vocabulary("byte_bpe_50k.json")
    first = tokens.encoder(vocab)
    common.forget_unused()
    assert tokens.encoder(vocab) is first  # a task after a task that used it
    common.forget_unused()
    near_dedup.shingles("a stage that needs no tokens at all")
    common.forget_unused()
    assert list(common._kept) == ["word hashes"]
    assert tokens.encoder(vocab) is not first

    # the same in Spark: tasks of packing, then tasks of another stage, in the same workers
    docs = spark.createDataFrame([(i, f"some words of text {i}") for i in range(8)], "doc_id long, text string").repartition(1)

    def kept(batches):
        for b in batches:
            yield pa.record_batch({"key": [str(k) for k in common._kept]})

    assert packing.pieces(docs, vocab).count() == 8
    for _ in range(2):
        got = common.map_arrow(docs.select("text"), kept, "key string").collect()
    assert not [r for r in got if "encoder" in r.key]


def test_batches_are_worked_on_in_slices(monkeypatch):
    text = pa.array(["x" * 1000, None, "", "y" * 5000, "z", "w" * 900])
    parts = list(common.text_slices(pa.record_batch({"n": list(range(6)), "text": text}), 1000))
    assert [p["n"].to_pylist() for p in parts] == [[0], [1, 2], [3], [4, 5]]
    assert list(common.text_slices(pa.record_batch({"text": text[:0]}))) == []

    # redacting a batch of 20 MB holds one slice of Python strings beside it, not all of them
    run = []
    monkeypatch.setattr(secret_scan, "map_arrow", lambda df, fn, schema: run.append(fn))
    secret_scan.redact_secrets(type("Docs", (), {"schema": None}))
    batch = pa.record_batch({"text": ["some plain words " * 120] * 10_000})
    tracemalloc.start()
    n = sum(b.num_rows for b in run[0](iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 10_000 and most < 8e6


def test_slots_saturate():
    rng = np.random.default_rng(0)
    total, want = np.zeros(64, np.uint8), np.zeros(64, np.int64)
    for _ in range(40):
        slots = np.sort(rng.integers(0, 64, 500).astype(np.uint64) // np.uint64(3))
        near_dedup._add_saturated(total, slots)
        np.add.at(want, slots, 1)
    assert want.max() > 255 and (total == np.minimum(want, 255)).all()


@pytest.mark.parametrize("name", ["language", "dedup", "secrets", "pack"])
def test_stages_hand_texts_to_workers_in_small_batches(spark, name):
    def sizes(batches):
        for b in batches:
            yield pa.record_batch({"rows": [b.num_rows], "size": [b.nbytes]})

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(key)
    docs = spark.createDataFrame([(i, f"word{i} and some more plain words ", "en", "web", 0) for i in range(9)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    try:
        spark.conf.set(key, str(256 << 20))
        dict(P.STAGES)[name](spark, docs, SF001)
        # 4,000 texts of 4,000 characters come to a worker a part at a time, with none lost
        long = spark.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("text"), 1000).alias("text"))
        got = common.map_arrow(long, sizes, "rows long, size long").collect()
    finally:
        spark.conf.set(key, was)
    assert sum(r["rows"] for r in got) == 4000 and max(r["size"] for r in got) < 3 << 20
