"""Best-fit packing by large-item matching (operator 2).

Token counts are integers of at most ``capacity``, so a packing is planned on the histogram
of piece lengths (at most ``capacity`` rows, whatever the corpus size) and then applied to
the pieces by a distributed rank within each length:

1. documents above one third of the capacity fit at most twice into a sequence. From the
   longest down, each takes the longest such partner that still fits (greedy matching);
2. smaller documents, from the longest down, go to the tightest remaining gap (best fit),
   and to new sequences only when no gap is left.

Sequences with equal gaps are interchangeable, so whole runs of equal pieces move at once;
the plan's size depends on the capacity, not on the number of documents.

Edge cases: a null or empty text is one piece, the end id alone; a document longer than the
capacity is cut into full pieces behind a shorter first one; repeated rows are packed as
documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, small_batches, stage
from .tokens import encoded, vocabulary

CAPACITY = 2048
END_ID = 0
#: Pieces of one length that a rank window holds at most, about; a more frequent length has several.
RANK_ROWS = 500
#: Bytes of text that are encoded at once.
SLICE_BYTES = 4 << 20


class _Bins:
    """Runs of sequences with equal gap: gap -> [(first sequence, how many)]."""

    def __init__(self, capacity: int):
        self.capacity, self.by_gap, self.gaps, self.made = capacity, {}, [], 0

    def put(self, gap: int, first: int, n: int) -> None:
        if gap not in self.by_gap:
            self.by_gap[gap] = []
            insort(self.gaps, gap)
        self.by_gap[gap].append((first, n))

    def take(self, size: int, most: int) -> tuple[int, int, int] | None:
        """A run with the tightest gap of at least ``size``: (gap, first, n <= most)."""
        i = bisect_left(self.gaps, size)
        if i == len(self.gaps):
            return None
        gap = self.gaps[i]
        first, n = self.by_gap[gap].pop()
        if n > most:
            self.by_gap[gap].append((first + most, n - most))
            n = most
        if not self.by_gap[gap]:
            del self.by_gap[gap], self.gaps[i]
        return gap, first, n

    def new(self, n: int) -> int:
        self.made += n
        return self.made - n


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Where the pieces of each length go: runs (size, rank from, sequence from, n, offset).

    Pieces ``rank .. rank + n`` of a length go to sequences ``seq .. seq + n`` at ``offset``.
    """
    left = {s: n for s, n in histogram.items() if n}
    done: dict[int, int] = dict.fromkeys(left, 0)
    bins, runs = _Bins(capacity), []

    def place(size: int, seq: int, n: int, offset: int) -> None:
        runs.append((size, done[size], seq, n, offset))
        done[size] += n
        left[size] -= n

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        a = large[-1]
        i = bisect_left(large, capacity - a + 1) - 1
        if i < 0:  # no large partner fits
            n = left[a]
            seq = bins.new(n)
            place(a, seq, n, 0)
            if a < capacity:
                bins.put(capacity - a, seq, n)
        else:
            b = large[i]
            n = left[a] // 2 if a == b else min(left[a], left[b])
            if n == 0:  # the last one of its length: with the next shorter partner, or alone
                b = large[i - 1] if i else None
                n = 1
            seq = bins.new(n)
            place(a, seq, n, 0)
            gap = capacity - a
            if b is not None:
                place(b, seq, n, a)
                gap -= b
            if gap:
                bins.put(gap, seq, n)
        large = [s for s in large if left[s]]
    for s in sorted((s for s in left if left[s]), reverse=True):
        while left[s]:
            if got := bins.take(s, left[s]):
                gap, seq, n = got
                place(s, seq, n, capacity - gap)
                if gap > s:
                    bins.put(gap - s, seq, n)
            else:
                per = capacity // s  # new sequences, filled with this length alone
                n = left[s] // per
                if n:
                    seq = bins.new(n)
                    for k in range(per):
                        place(s, seq, n, k * s)
                    if capacity - per * s:
                        bins.put(capacity - per * s, seq, n)
                if rest := left[s]:
                    seq = bins.new(1)
                    for k in range(rest):
                        place(s, seq, 1, k * s)
                    bins.put(capacity - rest * s, seq, 1)
    cols = np.array(runs, np.int64).reshape(-1, 5)
    cols = cols[np.lexsort((cols[:, 1], cols[:, 0]))]
    return dict(zip(("size", "rank", "seq", "n", "offset"), cols.T.copy()))


def pieces(docs: DataFrame, vocab: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in (x for batch in batches for x in encoded(batch, vocab, end_id, SLICE_BYTES)):
            row, out = [], [[], [], [], []]
            for r, ids in enumerate(texts):
                n = len(ids) // 4
                first = n % capacity or capacity
                bounds = [0, *range(first, n + 1, capacity)] if n > capacity else [0, n]
                for k, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
                    row.append(r)
                    for c, v in zip(out, (k, lo, hi - lo, zlib.crc32(memoryview(ids)[4 * lo:4 * hi]))):
                        c.append(v)
            yield pa.record_batch({"doc_id": b.column("doc_id").take(pa.array(row, pa.int64())),
                                   "piece": pa.array(out[0], pa.int32()), "start": pa.array(out[1], pa.int64()),
                                   "length": pa.array(out[2], pa.int64()), "ids_crc32": pa.array(out[3], pa.int64())})

    small_batches(docs.sparkSession)
    return map_arrow(docs.select("doc_id", "text"), cut,
                     f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, "
                     "ids_crc32 long")


def pack(docs: DataFrame, vocab: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece with its ``sequence_id`` and its ``offset`` there."""
    vocab = vocab or vocabulary("byte_bpe_50k.json")
    cut = stage(pieces(docs, vocab, capacity, end_id), "pack-pieces")
    histogram = {int(r.length): int(r.n) for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # rank within a length: counts of (length, chunk) give offsets, a window ranks inside a chunk
    chunks = F.array(*[F.lit(-(-histogram.get(n, 1) // RANK_ROWS)) for n in range(1, capacity + 1)])
    chunked = cut.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece"), F.element_at(chunks, F.col("length").cast("int"))))
    counts = chunked.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("chunk")) - F.col("n"))
    inside = Window.partitionBy("length", "chunk").orderBy("doc_id", "piece")
    ranked = (chunked.withColumn("inside", F.row_number().over(inside) - 1)
              .join(before.drop("n"), ["length", "chunk"])
              .withColumn("rank", F.col("before") + F.col("inside")))
    # bounded by the capacity: one run for each meeting of a length with a gap
    runs = docs.sparkSession.sparkContext.broadcast(plan(histogram, capacity))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = runs.value
        # a run's place in (size, rank) order, as one sortable number
        wide = int(p["rank"].max(initial=0)) + 1
        keys = p["size"] * wide + p["rank"]
        for b in batches:
            rank = b.column("rank").to_numpy()
            i = np.searchsorted(keys, b.column("length").to_numpy() * wide + np.minimum(rank, wide - 1), "right") - 1
            b = b.drop_columns(["rank"])
            yield (b.append_column("sequence_id", pa.array(p["seq"][i] + rank - p["rank"][i]))
                   .append_column("offset", pa.array(p["offset"][i])))

    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return map_arrow(ranked.select(*cols, F.col("rank").cast("long").alias("rank")), assign,
                     f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, "
                     "ids_crc32 long, sequence_id long, offset long")
