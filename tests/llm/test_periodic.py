"""Periodic runs against a brute force over all lags."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from headstart.llm import periodic, queries

from ..conftest import SF01
from .conftest import TEXTS, rows


def brute(words):
    """(start, length, period) of every run, by definition: each lag's maximal stretches, smallest period only."""
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)  # lags come in order: the first is the smallest period
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def digest(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = brute(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def of(docs):
    start, length, period = periodic.runs_of(docs)
    ends = np.cumsum([len(d) for d in docs])
    out = [[] for _ in docs]
    for s, m, q in zip(start.tolist(), length.tolist(), period.tolist()):
        d = int(np.searchsorted(ends, s, side="right"))
        out[d].append((s - int(ends[d]) + len(docs[d]), m, q))
    return out


def test_runs_equal_brute_force_on_small_alphabets():
    rng = np.random.default_rng(3)
    for trial in range(300):
        docs = []
        for _ in range(rng.integers(1, 6)):
            w = list(rng.choice([b"a", b"b", b"c"][:rng.integers(1, 4)], rng.integers(0, 40)))
            unit = list(rng.choice([b"a", b"b"], rng.integers(1, 9)))
            docs.append(w + unit * int(rng.integers(0, 9)) + w[:3] + unit[:2] * int(rng.integers(0, 12)))
        assert of(docs) == [brute(d) for d in docs], docs


def test_runs_inside_runs_and_ties():
    doc = (b"a a a a a a b".split() * 5) + b"x y z u".split() * 4
    assert of([doc, [], [b"w"] * 5, [b"w"] * 6])[0] == brute(doc)
    assert of([[b"w"] * 5, [b"w"] * 6]) == [[], [(0, 6, 1)]]
    assert periodic.strongest([(9, 8, 2), (3, 16, 4), (3, 4, 1)]) == (3, 4, 1)
    assert periodic.strongest([]) is None


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    short = [r for r in docs.collect() if len(r.text) < 6000]
    got = {r["doc_id"]: tuple(r[c] for c in names) for r in rows(queries.op11_periodic(spark, SF01))}
    assert len(got) == docs.count()
    want = [digest(r.doc_id, r.text) for r in short]
    assert [got[w[0]] for w in want] == want
    assert sum(w[1] for w in want) > 30


def test_edges(spark, edge_docs, no_docs):
    got = rows(periodic.periodic_runs(edge_docs))
    assert len(got) == len(TEXTS)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[8]["best"].asDict() == {"start": 0, "length": 40000, "period": 1} and by_id[8]["collapsed"] == "word"
    for k in (2, 3):
        assert (by_id[k]["n_words"], by_id[k]["runs"], by_id[k]["best"], by_id[k]["collapsed"]) == (0, [], None, "")
    seven = next(t for i, t, *_ in TEXTS if i == 7).encode().split()
    assert by_id[7]["collapsed"] == b" ".join(seven).decode() and by_id[7]["n_words"] == len(seven)
    assert periodic.periodic_runs(no_docs).count() == 0
    digests = rows(queries.periodic_digest(periodic.periodic_runs(periodic.with_periodic_tails(edge_docs))))
    assert len(digests) == len(TEXTS) and all(r["runs_sha256"] and r["collapsed_sha256"] for r in digests)
    null = next(r for r in digests if r["doc_id"] is None)
    assert null["n_runs"] == 0 and null["start"] is None


def test_one_narrow_map(spark):
    plan = queries.op11_periodic(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1
    assert periodic.with_periodic_tails(spark.range(1).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))).count() == 1
