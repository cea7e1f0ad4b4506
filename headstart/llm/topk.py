"""Exact top-k by exhaustive term-at-a-time accumulation (operator 6).

Vectors become sparse integer rows. Candidates are grouped into blocks of ``BLOCK`` rows,
each stored as postings: per term, the rows that have it and their weights (a term that most
rows have is kept as one dense column). Queries are grouped into blocks of sparse rows. For
every pair of a query block and a candidate block, each query's terms scatter their weight
times the postings into a dense score array; partition selection leaves the k best of the
block, and a merge per query the k best of all.

Scores are exact 64-bit integers. Equal scores go to the smaller id; a query is never its
own candidate (rows that repeat the query's id are not candidates of it either, and a
repeated query id is asked once, with its smallest row). Vectors
that are null or hold null or non-finite components take no part; vectors may differ in
length (missing components count as 0). An empty table gives an empty result. Of the input only
``vec_id`` and ``embedding`` are read, whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow

BLOCK = 4096
QUERY_BLOCK = 1024
#: Candidate blocks, about, that a query block meets in one task.
BLOCKS_PER_PART = 4
SCALE = 256


def integer_rows(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, terms, weights``: the non-zero components of ``floor(scale * x)``."""
    clean = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
                           & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                                      & (F.abs(x.cast("double")) < F.lit(float("inf")))))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return clean.select("vec_id", whole.alias("w")).select(
        "vec_id", F.filter(F.transform("w", lambda w, i: F.when(w != 0, i)), lambda i: i.isNotNull()).alias("terms"),
        F.filter("w", lambda w: w != 0).alias("weights"))


_PACKED = "ids binary, n binary, t binary, w binary"


def _packed(t: pa.Table) -> dict[str, pa.Array]:
    """Ids, row lengths, terms and weights of the rows of ``t``, each as one binary value."""
    n = t["terms"].combine_chunks()
    if isinstance(n, pa.ChunkedArray):
        n = pa.concat_arrays(n.chunks)
    w = pa.concat_arrays(t["weights"].chunks)
    cols = (t["vec_id"].to_numpy().astype("<i8"), np.diff(n.offsets.to_numpy()).astype("<i4"),
            n.flatten().to_numpy(zero_copy_only=False).astype("<i4"),
            w.flatten().to_numpy(zero_copy_only=False).astype("<i8"))
    return {c: pa.array([v.tobytes()], pa.binary()) for c, v in zip(("ids", "n", "t", "w"), cols)}


def candidate_blocks(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks of at most ``size`` rows, made where the rows are."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            while sum(x.num_rows for x in held) >= size:
                t = pa.Table.from_batches(held)
                yield pa.record_batch(_packed(t.slice(0, size)))
                held = t.slice(size).to_batches()
        if sum(x.num_rows for x in held):
            yield pa.record_batch(_packed(pa.Table.from_batches(held)))

    return map_arrow(rows.select("vec_id", "terms", "weights"), pack, _PACKED)


def query_blocks(rows: DataFrame, n_blocks: int) -> DataFrame:
    """Query rows dealt by a hash of their id to ``n_blocks`` blocks; an id counts once."""
    once = rows.groupBy("vec_id").agg(F.min(F.struct("terms", "weights")).alias("r")).select("vec_id", "r.*")
    dealt = once.withColumn("q_block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int"))

    def pack(t: pa.Table) -> pa.Table:
        key = pa.array([t["q_block"][0].as_py()], pa.int32())
        return pa.table({"q_block": key} | {f"q_{c}": v for c, v in _packed(t).items()})

    return dealt.groupBy("q_block").applyInArrow(
        pack, "q_block int, q_ids binary, q_n binary, q_t binary, q_w binary")


def _unpacked(ids: bytes, n: bytes, t: bytes, w: bytes) -> tuple[np.ndarray, ...]:
    n = np.frombuffer(n, "<i4")
    return np.frombuffer(ids, "<i8"), np.repeat(np.arange(len(n)), n), np.frombuffer(t, "<i4"), np.frombuffer(w, "<i8")


def best_of_block(q_ids, q_row, q_term, q_weight, c_ids, c_row, c_term, c_weight, k: int):
    """(query id, candidate id, score) of each query's k best candidates in the block."""
    order = np.argsort(c_ids, kind="stable")  # then the position decides ties
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    c_ids, c_row = c_ids[order], place[c_row]
    postings: dict[int, tuple[np.ndarray | None, np.ndarray]] = {}
    by_term = np.argsort(c_term, kind="stable")
    cuts = np.flatnonzero(np.diff(c_term[by_term], prepend=-1))
    for part in np.split(by_term, cuts[1:]) if len(by_term) else []:
        rows, weights = c_row[part], c_weight[part]
        if 2 * len(rows) > len(c_ids):
            dense = np.zeros(len(c_ids), np.int64)
            dense[rows] = weights
            rows, weights = None, dense
        postings[int(c_term[part[0]])] = rows, weights
    bounds = np.searchsorted(q_row, np.arange(len(q_ids) + 1))
    out = [[], [], []]
    for i, q in enumerate(q_ids):
        scores = np.zeros(len(c_ids), np.int64)
        for j in range(bounds[i], bounds[i + 1]):
            if (got := postings.get(int(q_term[j]))) is not None:
                rows, weights = got
                if rows is None:
                    scores += q_weight[j] * weights
                else:
                    scores[rows] += q_weight[j] * weights
        here = np.flatnonzero(c_ids != q) if (lo := np.searchsorted(c_ids, q)) < len(c_ids) and c_ids[lo] == q \
            else None
        s = scores if here is None else scores[here]
        if len(s) > k:
            least = np.partition(s, len(s) - k)[len(s) - k]
            over = np.flatnonzero(s > least)
            best = np.concatenate([over, np.flatnonzero(s == least)[: k - len(over)]])
        else:
            best = np.arange(len(s))
        picked = best if here is None else here[best]
        out[0].append(np.full(len(picked), q))
        out[1].append(c_ids[picked])
        out[2].append(scores[picked])
    return [np.concatenate(x) if x else np.empty(0, np.int64) for x in out]


def top_k(vectors: DataFrame, queries, k: int = 5, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest integer inner products of each query.

    ``queries`` is a condition on the rows of ``vectors``.
    """
    rows = integer_rows(vectors, scale)
    asked = rows.filter(queries)
    n_blocks, n_parts = max(1, -(-asked.count() // QUERY_BLOCK)), max(1, -(-rows.count() // (BLOCK * BLOCKS_PER_PART)))
    # the stated query set against all rows, in blocks: a candidate block meets each query block;
    # a key is a query block and a part of the candidate blocks, so tasks grow with the candidates
    met = candidate_blocks(rows, BLOCK).withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(n_parts)).cast("int")) \
        .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    asked_in = query_blocks(asked, n_blocks).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    pairs = met.hint("merge").join(asked_in, ["q_block", "part"])  # the candidates are never broadcast

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                got = best_of_block(*_unpacked(r["q_ids"], r["q_n"], r["q_t"], r["q_w"]),
                                    *_unpacked(r["ids"], r["n"], r["t"], r["w"]), k)
                yield pa.record_batch(dict(zip(("query_id", "vec_id", "score"), map(pa.array, got))))

    best = map_arrow(pairs.drop("q_block", "part"), score, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
