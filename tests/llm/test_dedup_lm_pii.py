import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from headstart.llm import lm_score, near_dedup, pii

from ..conftest import SF01
from .conftest import TEXTS, rows


def _set(text):
    w = (text or "").encode().lower().split()
    n = min(5, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if n else frozenset()


def _components(texts):
    sets = [(i, _set(t)) for i, t in texts]
    by = defaultdict(set)
    for k, (_, s) in enumerate(sets):
        for g in s:
            by[g].add(k)
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, s) in enumerate(sets):
        both = Counter(j for g in s for j in by[g] if j < k)
        for j, n in both.items():
            if 100 * n >= 75 * (len(s) + len(sets[j][1]) - n):
                a, b = sorted((root(i), root(sets[j][0])))
                parent[b] = a
    return {i: root(i) for i, _ in sets}, {i: len(s) for i, s in sets}


def _check_dedup(df, texts):
    want, sizes = _components(texts)
    got = rows(near_dedup.near_duplicates(df))
    assert len(got) == len(texts)
    for r in got:
        i = r["doc_id"]
        assert (r["component_id"], r["n_shingles"], r["kept"]) == (want[i], sizes[i], want[i] == i), i
    return want


def test_components_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    want = _check_dedup(docs.repartition(6), [(r.doc_id, r.text) for r in docs.collect()])
    assert sum(k != v for k, v in want.items()) > 50


def test_large_groups_of_copies_and_near_copies(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    base = rng.choices(words, k=120)
    texts = [(i, " ".join(base)) for i in range(400)]  # copies
    near = rng.choices(words, k=150)
    for i in range(400, 900):  # near copies of one text
        v = list(near)
        for _ in range(rng.randint(0, 3)):
            v[rng.randrange(150)] = "x%d" % rng.randrange(10**6)
        texts.append((i, " ".join(v)))
    common = rng.choices(words, k=40)
    texts += [(i, " ".join(rng.choices(words, k=60) + common + rng.choices(words, k=60))) for i in range(900, 1300)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(9)
    want = _check_dedup(df, texts)
    assert len({want[i] for i in range(400)}) == 1 and len(set(want.values())) > 400


def _changed(rng, words, k):
    """``words`` with ``k`` of them replaced, at least five apart."""
    v = list(words)
    for at in rng.sample(range(0, len(v) - 4, 5), k):
        v[at + 2] = "x%d" % rng.randrange(10**9)
    return v


def test_strays_of_a_large_group_are_found(spark):
    rng = random.Random(5)
    base = rng.choices([f"w{i}" for i in range(3000)], k=200)
    members = [_changed(rng, base, 1) for _ in range(500)]
    strays = [_changed(rng, v, 5) for v in members[:80]]  # similar to one member only
    texts = [(i, " ".join(v)) for i, v in enumerate([*members, *strays])]
    want = _check_dedup(spark.createDataFrame(texts, "doc_id long, text string").repartition(7), texts)
    assert len(set(want.values())) < 5


def test_pairs_among_unlinked_documents_of_a_template(spark):
    rng = random.Random(6)
    template = rng.choices([f"w{i}" for i in range(3000)], k=170)
    texts = [template + ["u%d" % rng.randrange(10**9) for _ in range(30)] for _ in range(3000)]
    texts += [_changed(rng, v, 5) for v in texts[:100]]  # 0.77 similar to one document; all others are 0.74 alike at most
    df = spark.createDataFrame([(i, " ".join(v)) for i, v in enumerate(texts)], "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r["component_id"] for r in rows(near_dedup.near_duplicates(df))}
    assert got == {i: i if i < 3000 else i - 3000 for i in range(3100)}


def test_dedup_edge_rows(spark, edge_docs, no_docs):
    got = rows(near_dedup.near_duplicates(edge_docs))
    assert len(got) == len(TEXTS)
    by = {r["doc_id"]: r for r in got}
    assert by[2]["n_shingles"] == by[3]["n_shingles"] == 0 and by[2]["kept"] and by[3]["kept"]
    assert by[None]["component_id"] is None and by[None]["kept"] and by[None]["n_shingles"] == 9
    assert by[8]["n_shingles"] == by[9]["n_shingles"] == 1
    assert near_dedup.near_duplicates(no_docs).count() == 0
    texts = [(1, "A b c"), (2, "a B\tC "), (3, "a b"), (3, "a b c"), (4, "z")]
    got = {(r["doc_id"], r["component_id"]) for r in rows(near_dedup.near_duplicates(
        spark.createDataFrame(texts, "doc_id long, text string")))}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_neighbours_cross_range_borders(spark):
    n = 600
    texts = [(i, f"pair {i // 2} of some words that only its two members share {i // 2} end") for i in range(n)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert _check_dedup(df, texts)[1] == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def _role(i):
    f = zlib.crc32(("" if i is None else str(i)).encode()) % 7
    return lm_score.TEST if f == 2 else lm_score.HELD if f == 0 else lm_score.CORE


def _check_lm(got, texts, exact_weights=True):
    docs = [(i, _role(i), [*(t or "").encode().lower().split(), None]) for i, t in texts]

    def counts(roles):
        one, two = Counter(), Counter()
        for _, r, w in docs:
            if r in roles:
                one.update(w)
                two.update(zip([None, *w], w))
        return one, two, sum(one.values()), len(one)

    core, train = counts({lm_score.CORE}), counts({lm_score.CORE, lm_score.HELD})
    events = [(int(lm_score.bucket(np.array([core[0][u]]))[0]), core[1][u, w] / max(1, core[0][u]), core[0][w] / max(1, core[2]), 1)
              for _, r, ws in docs if r == lm_score.HELD for u, w in zip([None, *ws], ws)]
    weights = lm_score.learn_weights(np.array(events, float).reshape(-1, 4), 1 / (core[3] + 1))
    one, two, n, v = train
    want = Counter()
    by = defaultdict(list)
    for i, r, ws in docs:
        base = sum(log10((one[w] + 1) / (n + v + 1)) for w in ws)
        model = 0.0
        for u, w in zip([None, *ws], ws):
            l2, l1, l0 = weights[int(lm_score.bucket(np.array([one[u]]))[0])]
            model += log10(l2 * two[u, w] / max(1, one[u]) + l1 * one[w] / max(1, n) + l0 / (v + 1))
        want[i, r, len(ws), sum(one[w] > 0 for w in ws), n] += 1
        by[i].append((base, model))
    assert Counter((r["doc_id"], r["role"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got) == want
    for r in got:
        assert any(abs(r["base_score"] - b) < 1e-6 * (1 + abs(b)) and abs(r["score"] - m) < 0.02 * (1 + abs(m)) for b, m in by[r["doc_id"]])
    return by


def _roles():
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7
    return F.when(fold == 2, lm_score.TEST).when(fold == 0, lm_score.HELD).otherwise(lm_score.CORE)


@pytest.mark.parametrize("chunk, owner", [(lm_score.CHUNK_TOKENS, lm_score.TOKENS_PER_OWNER), (5000, 900)])
def test_lm_scores_equal_brute_force(spark, monkeypatch, chunk, owner):
    monkeypatch.setattr(lm_score, "TOKENS_PER_OWNER", owner)
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    got = rows(lm_score.score(docs.repartition(5 if chunk > 5000 else 60), _roles()))
    _check_lm(got, [(r.doc_id, r.text) for r in docs.collect()])
    test = [r for r in got if r["role"] == lm_score.TEST]
    assert sum(r["score"] for r in test) > sum(r["base_score"] for r in test)


def test_lm_edge_rows(spark, edge_docs, no_docs):
    _check_lm(rows(lm_score.score(edge_docs, _roles())), [t[:2] for t in TEXTS])
    assert lm_score.score(no_docs, _roles()).count() == 0
    got = rows(lm_score.score(edge_docs, F.lit(lm_score.TEST)))
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in got)


def test_em_recovers_the_mixture():
    rng = np.random.default_rng(6)
    true = np.array([0.6, 0.3, 0.1])
    p = rng.dirichlet(np.ones(50), 3)
    p[2] = 1 / 50
    n = rng.multinomial(500_000, true @ p)
    w = lm_score.learn_weights(np.stack([np.full(50, 3), p[0], p[1], n], 1).astype(float), 1 / 50, 400)
    assert np.abs(w[3] - true).max() < 0.03 and np.allclose(w.sum(1), 1) and np.allclose(w[7], w[3])


def test_sorted_keys_round_trip():
    rng = np.random.default_rng(7)
    for n, hi in ((1, 1 << 48), (5, 1 << 48), (1000, 1 << 40), (4, 10), (3, (1 << 64) - 1)):
        keys = np.unique(rng.integers(0, hi, n, np.uint64))
        assert np.array_equal(lm_score._sorted_keys(lm_score._sorted_bytes(keys)), keys)


NOISY = ("a@b.cd_e@f.gh x@y a.b@c.d.e. @x.y ab@@c.d 1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.0004 0000000000001.2.3.4 1.2.3 "
         "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 +49 (30) 1234-567 +1 +12 "
         "+1234567 89. +123456789012345678 tel +33 1 23 45 67 89, \U0001f600 é john@ex-ample.com 5500 0000 0000 0004\n5500000000000004")


def _luhn(d):
    return sum((int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))) for i, c in enumerate(reversed(d))) % 10 == 0


def _base(text):
    num = lambda s: re.sub("[^0-9]", "", s)
    spec = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(num(s)) <= 19 and _luhn(num(s))),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(num(s)) <= 15)]
    return [(k, m.start(), m.end()) for k, p, ok in spec for m in re.finditer(p, text) if ok(m.group())]


def test_base_pii_equals_the_patterns(spark):
    rng = random.Random(8)
    noise = ["".join(rng.choices(list("ab1259.@+- ()_é\U0001f600"), k=rng.randint(0, 60))) for _ in range(1500)]
    extra = [(10**6, NOISY), (10**6 + 1, "9" * 50_000 + " 1" * 20_000), (10**6 + 2, "x" * 100_000 + "@"), (10**6 + 3, "1.2.3.4 " * 2000),
             *((2 * 10**6 + i, t) for i, t in enumerate(noise))]
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text") \
        .unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got, found = {r["doc_id"]: r for r in rows(pii.find_pii(docs))}, Counter()
    for r in docs.collect():
        base, g = _base(r.text), got[r.doc_id]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert g["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (r.doc_id, joined, g["spans"])
        n = Counter(k for k, _, _ in base)
        assert [g[f"n_{k}"] for k in pii.BASE] == [n[k] for k in pii.BASE]
        assert g["spans"].startswith(joined)
        found += n
    assert min(found[k] for k in pii.BASE) > 10


def test_pii_edge_rows(spark, edge_docs, no_docs):
    got = rows(pii.find_pii(edge_docs))
    assert len(got) == len(TEXTS) and all(r["spans"] == "" for r in got)
    assert pii.find_pii(no_docs).count() == 0


def test_method_adds_spans_and_leaves_others(spark):
    texts = [(i, t) for i, t in enumerate([
        "write to john [at] example [dot] com please", "call 555-867-5309 by phone now 415-222-3333", "ssn 123-45-6789 of Dr. Jane Miller",
        "mail a@b.com", "order 000-12-3456 total", "plain words at the dot of noon"] * 20)]
    spans = {r["doc_id"]: r["spans"] for r in rows(pii.find_pii(spark.createDataFrame(texts, "doc_id long, text string")))}
    assert "email_at:9:36" in spans[0] and "national_id:4:15" in spans[2] and "name:" in spans[2]
    assert spans[3] == "email:5:12" and spans[4] == "" and spans[5] == ""


def test_em_tells_good_labelers_from_bad():
    rng = np.random.default_rng(9)
    truth = rng.random(4000) < 0.6
    acc = np.array([0.95, 0.8, 0.6])
    v = np.stack([np.where(rng.random(4000) < a, truth, ~truth) * 2 - 1 for a in acc], 1) * (rng.random((4000, 3)) < 0.9)
    got, p = pii.reliabilities(v.astype(float), np.ones(4000))
    got = got[0]
    assert got[0] > got[1] > got[2] and np.mean((p > 0.5) == truth) > 0.9


def test_em_learns_reliabilities_per_kind():
    rng = np.random.default_rng(10)
    acc = np.array([[0.95, 0.8, 0.6], [0.6, 0.8, 0.95]])  # the labelers change places from kind to kind
    kind = rng.integers(0, 2, 6000)
    truth = rng.random(6000) < 0.4
    v = np.where(rng.random((6000, 3)) < acc[kind], truth[:, None], ~truth[:, None]) * 2.0 - 1
    got, p = pii.reliabilities(v, np.ones(6000), kind, np.tile([0.5, 0.01, 0.99], (2, 1)))
    assert got[0][0] > got[0][1] > got[0][2] and got[1][2] > got[1][1] > got[1][0]
    assert np.mean((p > 0.5) == truth) > 0.9


def _planted(n=1500, seed=12):  # seed 11 chose pii.SHARES
    """Texts with one true span or one look-alike each: ``(text, kind, start, end, true)``."""
    rng = random.Random(seed)
    d = lambda k: "".join(rng.choices("0123456789", k=k))
    first, last = ("Anna", "James", "Maria", "Peter", "Laura"), ("Miller", "Okafor", "Lindqvist", "Moreau", "Tanaka")

    def luhn(k, start):
        while True:
            s = start + d(k - len(start))
            if sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(s))) % 10 == 0:
                return s

    true = {
        "name": lambda: (rng.choice(["please contact ", "signed ", "the patient "]), f"{rng.choice(first)} {rng.choice(last)}", " about it"),
        "national_id": lambda: (rng.choice(["her ssn ", "social security "]), f"{rng.randint(100, 599)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}", " on file"),
        "phone_local": lambda: (rng.choice(["call ", "phone "]), f"{rng.randint(200, 799)}-{rng.randint(200, 999)}-{rng.randint(1000, 9999)}", " today"),
        "email_at": lambda: (rng.choice(["write ", "contact "]), f"{rng.choice(first).lower()} [at] example [dot] {rng.choice(['com', 'org'])}", " soon"),
        "card_loose": lambda: (rng.choice(["the card ", "pay with "]), luhn(15, "37"), " now")}
    false = {
        "name": lambda: (rng.choice(["under the ", "of the ", "the "]), rng.choice(["Apache License", "General Public", "Version Control", "Open Source"]), rng.choice([", which", " Software here", " text"])),
        "national_id": lambda: ("order ", f"000-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}", " total"),
        "phone_local": lambda: ("invoice ", f"1{d(2)}-0{d(2)}-{d(4)}", " total"),
        "email_at": lambda: ("we looked ", "carefully at noon dot matrix", " printers"),
        "card_loose": lambda: ("build ", luhn(15, "9"), " total")}
    words = "river stone quiet market yellow window paper under late seven".split()
    for _ in range(n):
        kind, ok = rng.choice(pii.ADDED), rng.random() < 0.5
        before, span, after = (true if ok else false)[kind]()
        if rng.random() < 0.2:  # a fifth has a context that tells nothing, or the wrong thing
            before = rng.choice(["with ", "and ", "contact " if not ok else "then "])
        lead = " ".join(rng.choices(words, k=rng.randint(6, 20))) + " " + before
        yield lead + span + after + " " + " ".join(rng.choices(words, k=8)), kind, len(lead), len(lead) + len(span), ok


def test_added_spans_have_measured_precision_and_recall(spark):
    cases = list(_planted())
    docs = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: set(filter(None, r["spans"].split(","))) for r in rows(pii.find_pii(docs))}
    want = {i: {f"{k}:{s}:{e}"} if ok else set() for i, (_, k, s, e, ok) in enumerate(cases)}
    for kind in pii.ADDED:
        mine = lambda spans: {x for x in spans if x.startswith(kind + ":")}
        hit = sum(len(mine(got[i]) & mine(want[i])) for i in got)
        found, planted = sum(len(mine(x)) for x in got.values()), sum(len(mine(x)) for x in want.values())
        print(kind, "precision", hit / max(found, 1), "recall", hit / planted)
        assert hit >= 0.9 * found and hit >= 0.9 * planted, (kind, hit, found, planted)


def test_clean_text_gets_no_added_span(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    spans = [x.split(":")[0] for r in rows(pii.find_pii(docs)) for x in r["spans"].split(",") if x]
    assert not set(spans) - set(pii.BASE), Counter(spans)
    table = pii.vote_table(pii.candidates(docs))
    assert any(1 in v and -1 in v for v in ([r[k] for k in pii.LABELERS] for r in table))  # labelers disagree


def test_candidates_scan_the_texts_once_and_natively(spark):
    out = pii.find_pii(spark.read.parquet(f"{SF01}/documents.parquet"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert all("pii-candidates" in f for f in out.inputFiles()) and "Python" not in plan and "Arrow" not in plan
