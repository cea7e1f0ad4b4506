"""License scans: base phrases against the plain definition, templates with planted edits."""

import re

import numpy as np

from headstart.llm import licenses, queries

from ..conftest import SF01
from .conftest import TEXTS, rows

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def brute(doc_id, text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in places]
    return (doc_id, len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))


BASE = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def test_query_s_base_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    got = rows(queries.op13_licenses(spark, SF01))
    assert sorted(tuple(r[c] for c in BASE) for r in got) == sorted(brute(*r) for r in docs)
    assert sum(r["n_base"] for r in got) > 25
    for r in got:
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
    assert {"apache-2.0", "gpl-3.0", "cc-by-nc-4.0"} <= {x for r in got for x in r["labels"].split(",")}


def _edited(text, rng, share):
    words = text.split()
    for i in rng.choice(len(words), int(share * len(words)), replace=False):
        words[i] = rng.choice(["thing", "", "some other words"])
    return " ".join(words)


def test_templates_with_edits_are_found(spark):
    rng = np.random.default_rng(5)
    long = [(label, t) for label, t in licenses.TEMPLATES if len(t.split()) > 20]
    docs = [(n * 10 + k, "word " * 300 + _edited(t, rng, 0.08) + " tail" * 50) for n, (_, t) in enumerate(long) for k in range(6)]
    got = {r["doc_id"]: r for r in rows(licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")))}
    hit = [long[d // 10][0] in r["labels"].split(",") for d, r in got.items()]
    assert np.mean(hit) > 0.95
    far = [(n, _edited(t, rng, 0.6)) for n, (_, t) in enumerate(long)]
    got = rows(licenses.scan_licenses(spark.createDataFrame(far, "doc_id long, text string")))
    assert not any(label in r["labels"].split(",") and r["score"] >= licenses.MIN_SHARE for r in got for label in [long[r["doc_id"]][0]])


def test_places_repeats_and_edges(spark, edge_docs, no_docs):
    text = "The MIT-License, mit license; MIT\nLICENSE! gnu general public license general public licenses, Apache\x00License éapache license"
    docs = [(1, text), (1, text), (1, text + " mit license"), (None, text), (2, "mit"), (3, "released under the bsd license"),
            (4, "mit license " * 5000), (5, None), (6, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = rows(licenses.scan_licenses(df))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r[c] for c in BASE) for r in got), key=key) == sorted((brute(*d) for d in docs), key=key)
    assert next(r for r in got if r["doc_id"] == 3)["labels"] == ""
    edge = rows(licenses.scan_licenses(edge_docs))
    assert sorted((tuple(r[c] for c in BASE) for r in edge), key=key) == sorted((brute(*t[:2]) for t in TEXTS), key=key)
    assert licenses.scan_licenses(no_docs).count() == 0


def test_common_words():
    assert licenses.common_words([b"a", b"b", b"c"], [b"x", b"a", b"c", b"b"]) == 2
    assert licenses.common_words([b"a"], []) == 0


def test_texts_beyond_the_broadcast_bound(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "see the mit license" if k % 3 else "none") for k in range(30)], "doc_id long, text string")
    want = sorted(tuple(r[c] for c in BASE) for r in rows(licenses.scan_licenses(docs)))
    monkeypatch.setattr(licenses, "BROADCAST_KEYS", 3)
    assert want == sorted(tuple(r[c] for c in BASE) for r in rows(licenses.scan_licenses(docs)))
