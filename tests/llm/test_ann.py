import numpy as np
from pyspark.sql import functions as F

from headstart.llm import ann

from ..conftest import SF001
from .conftest import rows


def _brute(vectors, k=20):
    dim = max(len(v) for _, v in vectors)
    pad = {(i, tuple(np.float32(v).astype(float)) + (0.0,) * (dim - len(v))) for i, v in vectors}
    ids, x = np.array([i for i, _ in pad]), np.array([v for _, v in pad])
    out = {}
    for i, v in zip(ids, x):
        if i % 20 == 0:
            s = (x * v).sum(1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def _recall(df, vectors):
    want, got = _brute(vectors), {}
    for r in sorted(rows(ann.nearest(df, F.col("vec_id") % 20 == 0)), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r)
    assert set(got) == set(want)
    hits = []
    for q, rs in got.items():
        assert [r["rank"] for r in rs] == list(range(1, len(want[q]) + 1))
        assert [(-r["score"], r["vec_id"]) for r in rs] == sorted((-r["score"], r["vec_id"]) for r in rs)
        ids = {i for i, _ in want[q]}
        hits.append(sum(r["vec_id"] in ids for r in rs) / len(ids))
        scores = dict(want[q])
        assert all(abs(r["score"] - scores[r["vec_id"]]) < 1e-12 for r in rs if r["vec_id"] in scores)
    return np.mean(hits)


def test_recall_with_copies_and_bad_rows(spark):
    vectors = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    vectors += [(10_000 + i, vectors[7][1]) for i in range(400)]  # one very common vector
    bad = [(20_000, None), (20_020, [0.0] * 64), (20_040, [float("nan")] * 64), (20_060, [float("inf")] * 64), (20_080, [None] * 64), (None, [1.0])]
    df = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<float>").repartition(5)
    for c in ("node", "x", "ids", "rank", "query"):
        df = df.withColumn(c, F.lit("clash"))
    assert _recall(df, vectors) > 0.97


def test_few_rows_give_all_candidates(spark):
    vectors = [(20 * i, [float(i + 1), 1.0]) for i in range(5)] + [(3, [2.0]), (3, [2.0])]
    assert _recall(spark.createDataFrame(vectors, "vec_id long, embedding array<float>"), vectors) == 1
    one = spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")
    assert ann.nearest(one, F.col("vec_id") % 20 == 0).count() == 0
    assert ann.nearest(one.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_few_rows_at_many_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        for n in (5, 30):
            x = np.random.default_rng(2).normal(size=(n, 8))
            base = spark.createDataFrame([(i, v) for i, v in enumerate(ann.quantized(x))], "node long, vec binary")
            got = {r.node: set(np.frombuffer(r.ids, "<i8")) for r in ann.build_graph(base, 8, rounds=0).collect()}
            assert got == {i: set(range(n)) - {i} for i in range(n)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_descent_improves_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "ORDERS", 2)
    monkeypatch.setattr(ann, "BLOCK", 64)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    base = spark.createDataFrame([(i, v) for i, v in enumerate(ann.quantized(x))], "node long, vec binary")
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    true = np.argsort(-s, 1)[:, :10]

    def recall(graph):
        got = {r.node: np.frombuffer(r.ids, "<i8") for r in graph.collect()}
        return np.mean([len(set(true[i]) & set(got[i])) / 10 for i in range(len(x))])

    seen = []
    for rounds in (0, 1, 3):
        seen.append(recall(ann.build_graph(base, 16, rounds)))
    assert seen[0] < 0.4 < seen[1] < seen[2] and seen[2] > 0.95
    settled = ann.build_graph(base, 16)
    assert recall(settled) >= seen[2]
    changed, entries = settled.agg(F.sum("changed"), F.sum(F.length("ids") / 8)).first()
    assert changed <= ann.DELTA * entries


def test_beam_widens_until_the_recall_is_there(spark, monkeypatch):
    """From a poor graph (two orders, one round) and a narrow beam, in a hard space."""
    for name, value in (("ORDERS", 2), ("BLOCK", 64), ("DELTA", 2.0), ("BEAM", 24)):
        monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 48))
    vectors = [(i, [float(c) for c in np.float32(v / np.linalg.norm(v))]) for i, v in enumerate(x)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(4)
    monkeypatch.setattr(ann, "RECALL", 0.0)
    narrow = _recall(df, vectors)
    monkeypatch.setattr(ann, "RECALL", 0.99)
    wide = _recall(df, vectors)
    assert narrow < 0.97 < 0.985 < wide, (narrow, wide)


def test_probes_are_the_exact_neighbours(spark):
    x = np.random.default_rng(4).normal(size=(700, 9))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    exact = ann.nodes(vectors, 20).persist()
    ids = {r.node: r.copies[0] for r in exact.collect()}
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    got = ann.probes(exact, exact.select("node"), 9, 20).collect()
    assert len(got) == ann.PROBES
    for r in got:
        assert [ids[t] for t in r.true] == list(np.argsort(-s[ids[r.query]])[:20])
    exact.unpersist()


def _unit(n, dim, seed):
    x = np.random.default_rng(seed).normal(size=(n, dim))
    return [(i, [float(c) for c in np.float32(v / np.linalg.norm(v))]) for i, v in enumerate(x)]


def test_rows_between_steps_follow_the_parts(spark, monkeypatch):
    """Steps exchange rows for pairs of parts, not for nodes and members (81 a node and round before)."""
    made, plain = spark.sparkContext.accumulator(0), ann.map_arrow

    def counted(df, fn, schema):
        def run(batches):
            for b in fn(batches):
                made.add(b.num_rows)
                yield b
        return plain(df, run, schema)

    monkeypatch.setattr(ann, "map_arrow", counted)
    vectors = _unit(4000, 16, 5)
    ann.nearest(spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(4), F.col("vec_id") % 20 == 0).count()
    assert made.value < 20 * len(vectors), made.value  # about 7 a node are vectors read, quantized and scored again


def test_exact_where_comparing_all_costs_less(spark, monkeypatch):
    """No beam is enough: a query is compared with every node, from lists that miss most neighbours."""
    for name, value in (("ORDERS", 1), ("BLOCK", 64), ("DELTA", 2.0), ("RECALL", 2.0)):
        monkeypatch.setattr(ann, name, value)
    vectors = _unit(3000, 48, 6) + [(10_000 + i, [0.5] * 4) for i in range(30)]
    assert _recall(spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(4), vectors) == 1


def test_beam_widens_on_the_graph(spark, monkeypatch):
    for name, value in (("ORDERS", 2), ("BLOCK", 64), ("DELTA", 2.0), ("BEAM", 24), ("RECALL", 0.99), ("SCANNED", 0)):
        monkeypatch.setattr(ann, name, value)
    vectors = _unit(2000, 48, 7)
    assert _recall(spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(4), vectors) > 0.985


def test_parts_of_a_few_nodes(spark, monkeypatch):
    """Many parts and ranges give the lists that one part gives."""
    x = np.random.default_rng(8).normal(size=(1500, 12))
    base = spark.createDataFrame([(i * 7919 - 3, v) for i, v in enumerate(ann.quantized(x))], "node long, vec binary")
    got = []
    for part in (16384, 100):
        monkeypatch.setattr(ann, "PART", part)
        graph = ann.build_graph(base, 12)
        lists = {r.node: set(np.frombuffer(r.ids, "<i8").tolist()) for r in graph.collect()}
        assert all(len(v) == ann.DEGREE and k not in v for k, v in lists.items())
        got.append((graph.parts, lists))
    assert got[0][0] == 1 and got[1][0] == 15
    assert np.mean([len(got[0][1][i] & v) / ann.DEGREE for i, v in got[1][1].items()]) > 0.98
