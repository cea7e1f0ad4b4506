"""MinHash near-dedup with an LSH forest (operator 1).

1. Every document's set of hashed 5-word shingles gives a signature of ``COMPONENTS`` minima
   and a 128-bit fingerprint of the set. Documents with equal sets collapse to the one with
   the smallest id, so copies never meet as pairs.
2. The forest is ``TREES`` sorted orders of the signatures, each beginning at other
   components. An order is range-sorted (a large group of alike signatures spans several
   ranges). Candidates are neighbours by longest common prefix, of ``MIN_DEPTH`` components
   at least. Depth adapts by region: a run of equal prefixes with more than ``REGION``
   documents is split by the next component, until runs are small; all pairs of a small run are
   candidates, and neighbours across runs of a region stay candidates, which keeps the
   candidates of a document bounded by the number of orders, however large its region is.
3. Candidates whose signatures agree in fewer than ``MIN_AGREE`` components go (a pair at the
   threshold falls below that with a chance under 1e-6). The rest is confirmed on the full
   shingle sets.
4. Components of the confirmed links by minimum labels and pointer jumping.
5. An exact pass over what the forest left apart. All shingles have one global order: by the
   number of documents' shingles in their slot (a table of counts over all documents, of fixed
   size), then by hash, so that a set's rarest come first as far as the slots tell them apart;
   two sets at the threshold share a shingle among the first quarter of each (prefix filter). Documents of different components that share one there, and whose
   sizes and places in the order leave room for the overlap asked, are candidates; a crowded
   shingle is compared in blocks of ``BLOCK`` documents, all pairs of blocks. The same filter
   by signature and confirmation follow, and the links found join the components.

The forest only has to join most of a large group, so that its pairs needn't meet one by one;
every pair of two components meets in the exact pass, so a link is missed only if its
signatures agree in too few components.

Edge cases: words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a document with one to four words
has its whole sequence as its only shingle; null or wordless texts have an empty set and are
linked with nothing; rows that repeat an id are one document; a null id is linked with
nothing, and its ``component_id`` is null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ann import whole_groups
from .common import drop_stage, kept, map_arrow, shuffle_partitions, stage

SHINGLE = 5
COMPONENTS = 96
TREES = 24
MIN_DEPTH = COMPONENTS // TREES
MAX_DEPTH = 12
REGION = 12
CHAIN = 2
MIN_AGREE = 50
SIMILAR = 75  # per cent
#: Ids of candidates that are broadcast at most, to filter texts where they are read.
BROADCAST_IDS = 1_000_000
#: The order of shingles goes by counts in ``2^SLOT_BITS`` slots, which are added up in pieces of ``2^PIECE_BITS``.
SLOT_BITS = 24
PIECE_BITS = 13
#: Documents of a shingle that are compared in one block.
BLOCK = 512

_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(1)
_WORD_FACTORS = _rng.integers(0, 1 << 64, SHINGLE, np.uint64) | np.uint64(1)
_XOR = _rng.integers(0, 1 << 32, COMPONENTS, np.uint32)
_MUL = _rng.integers(0, 1 << 32, COMPONENTS, np.uint32) | np.uint32(1)


class _Words(dict):
    """64-bit hashes of words; emptied when large."""

    def __missing__(self, w: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        h = self[w] = xxhash.xxh3_64_intdigest(w)
        return h


def word_hashes(text: str | None) -> np.ndarray:
    words = text.encode("utf-8", "replace").lower().split() if text else []
    return np.fromiter(map(kept("word hashes", _Words).__getitem__, words), np.uint64, len(words))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    w = word_hashes(text)
    n = min(SHINGLE, len(w))
    if n == 0:
        return np.empty(0, np.uint64)
    m = len(w) - n + 1
    h = np.full(m, n, np.uint64)
    for k in range(n):
        h += w[k:k + m] * _WORD_FACTORS[k]
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return np.unique(h)


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits of the set, as two signed numbers."""
    a = (s * np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    y = (s ^ (s >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    b = (y ^ (y >> np.uint64(27))).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures (documents x COMPONENTS, 16 bits of each minimum) of non-empty sets."""
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), COMPONENTS), np.uint32)
    for i in range(COMPONENTS):
        out[:, i] = np.minimum.reduceat((x ^ _XOR[i]) * _MUL[i], starts)
    return ((out * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(">u2")


def _saturated(counts: np.ndarray, most: int) -> np.ndarray:
    return np.minimum(counts, most)


def _add_saturated(total: np.ndarray, slots: np.ndarray) -> None:
    """Add one to ``total`` (bytes, at most 255 each) for each of the sorted ``slots``."""
    first = np.flatnonzero(np.append(True, slots[1:] != slots[:-1]))
    once = slots[first]
    total[once] = _saturated(total[once] + np.diff(first, append=len(slots)), 255)


def shingle_counts(docs: DataFrame) -> np.ndarray:
    """How many documents' shingles fall into each of ``2^SLOT_BITS`` slots of their hashes, over all
    documents (at most 65,535 each; 32 MB whatever the corpus)."""
    pieces = 1 << (SLOT_BITS - PIECE_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.uint8)
        for b in batches:
            for t in b.column("text"):
                if len(s := shingles(t.as_py())):
                    _add_saturated(total, s >> np.uint64(64 - SLOT_BITS))
        task = TaskContext.get().partitionId()
        for lo in range(0, pieces, 256):
            rows = []
            for p in range(lo, min(pieces, lo + 256)):
                piece = total[p << PIECE_BITS:(p + 1) << PIECE_BITS]
                if len(slots := np.flatnonzero(piece)):
                    rows.append((p, slots.astype("<u2").tobytes(), piece[slots].tobytes()))
            yield pa.record_batch({"piece": pa.array([r[0] for r in rows], pa.int32()), "part": pa.array([task // 64] * len(rows), pa.int32()),
                                   "slots": pa.array([r[1] for r in rows], pa.binary()), "n": pa.array([r[2] for r in rows], pa.binary())})

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(1 << PIECE_BITS, np.uint32)
        for slots, n in zip(t.column("slots").to_pylist(), t.column("n").to_pylist()):
            total[np.frombuffer(slots, "<u2")] += np.frombuffer(n, np.uint8)
        return pa.table({"piece": t.column("piece").slice(0, 1), "counts": pa.array([_saturated(total, 65535).astype("<u2").tobytes()], pa.binary())})

    def merge(t: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(c, "<u2").astype(np.uint32) for c in t.column("counts").to_pylist()], axis=0)
        return pa.table({"piece": t.column("piece").slice(0, 1), "counts": pa.array([_saturated(total, 65535).astype("<u2").tobytes()], pa.binary())})

    # 64 tasks' counts of a piece meet first, so that no group grows with the number of tasks as such
    parts = map_arrow(docs.select("text"), count, "piece int, part int, slots binary, n binary")
    summed = parts.groupBy("piece", "part").applyInArrow(add, "piece int, counts binary")
    whole = np.zeros((pieces, 1 << PIECE_BITS), np.uint16)
    for r in summed.groupBy("piece").applyInArrow(merge, "piece int, counts binary").toArrow().to_pylist():
        whole[r["piece"]] = np.frombuffer(r["counts"], "<u2")
    return whole.reshape(-1)


def head(s: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the global order: those of which a similar set shares one."""
    rank = counts[s >> np.uint64(64 - SLOT_BITS)]
    return s[np.argsort(rank, kind="stable")[:len(s) - (SIMILAR * len(s) + 99) // 100 + 1]]


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, f1, f2, sig, head`` of every document (no ``sig`` and ``head`` for an empty set)."""
    counts = docs.sparkSession.sparkContext.broadcast(shingle_counts(docs))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n = 0, batch.num_rows
            while at < n:
                sets, size, lo = [], 0, at
                while at < n and size < 30_000:
                    sets.append(shingles(batch.column("text")[at].as_py()))
                    size += len(sets[-1])
                    at += 1
                full = [s for s in sets if len(s)]
                sig = iter(signatures(full)) if full else iter(())
                prints = [fingerprint(s) for s in sets]
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(lo, at - lo), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "f1": pa.array([p[0] for p in prints], pa.int64()), "f2": pa.array([p[1] for p in prints], pa.int64()),
                    "sig": pa.array([next(sig).tobytes() if len(s) else None for s in sets], pa.binary()),
                    "head": pa.array([head(s, counts.value).tobytes() if len(s) else None for s in sets], pa.binary())})

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), sign,
                     "doc_id long, n_shingles long, f1 long, f2 long, sig binary, head binary")


def neighbour_pairs(tree: np.ndarray, key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate positions (i, j < i) among sorted rows; ``key`` is rows x MAX_DEPTH."""
    n = len(node)
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    same = np.zeros((n, MAX_DEPTH), bool)
    same[1:] = np.logical_and.accumulate(key[1:] == key[:-1], axis=1) & (tree[1:] == tree[:-1])[:, None]
    lcp = same.sum(1)
    pos = np.arange(n)
    region = np.full(n, -1)  # first row of the small run that a row belongs to
    for depth in range(MIN_DEPTH, MAX_DEPTH + 1):
        start = np.maximum.accumulate(np.where(lcp < depth, pos, 0))
        size = np.bincount(start, minlength=n)[start]
        region = np.where((region < 0) & (size <= REGION), start, region)
    shared = np.maximum.accumulate(np.where(lcp < MIN_DEPTH, pos, 0))  # first row with this shortest prefix
    left, right = [], []
    for o in range(1, REGION):
        i = pos[o:]
        ok = (shared[i] <= i - o) & ((region[i] >= 0) & (region[i] <= i - o) & (region[i] == region[i - o]) | (o <= CHAIN))
        right.append(i[ok])
        left.append(i[ok] - o)
    return np.concatenate(right), np.concatenate(left)


def _pairs_of_sorted(batches: Iterator[pa.RecordBatch], ends: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbours in the order of the rows; if ``ends``, a range's outer rows too."""
    keep = 4 * REGION

    def arrays(b: pa.RecordBatch):
        key = np.frombuffer(b"".join(b.column("key").to_pylist()), ">u2").reshape(-1, MAX_DEPTH)
        return b.column("tree").to_numpy(), key, b.column("node").to_numpy()

    def out(a=(), b=(), tree=(), key=(), node=()):
        n, m = len(a), len(node)
        return pa.record_batch({
            "a": pa.array(np.append(np.minimum(a, b), np.zeros(m)).astype(np.int64), mask=np.arange(n + m) >= n),
            "b": pa.array(np.append(np.maximum(a, b), np.zeros(m)).astype(np.int64), mask=np.arange(n + m) >= n),
            "tree": pa.array(np.append(np.zeros(n), tree).astype(np.int32), mask=np.arange(n + m) < n),
            "key": pa.array([None] * n + [k.tobytes() for k in key], pa.binary()),
            "node": pa.array(np.append(np.zeros(n), node).astype(np.int64), mask=np.arange(n + m) < n)})

    last = None
    for b in batches:
        now = arrays(b)
        if not len(now[2]):
            continue
        if last is None and ends:
            yield out(tree=now[0][:REGION], key=now[1][:REGION], node=now[2][:REGION])
        old = 0
        if last is not None:
            old = len(last[2])
            now = tuple(np.concatenate(x) for x in zip(last, now))
        i, j = neighbour_pairs(*now)
        fresh = (i >= old) & (now[2][i] != now[2][j])
        yield out(now[2][i[fresh]], now[2][j[fresh]])
        last = tuple(x[-keep:] for x in now)
    if last is not None and ends:
        yield out(tree=last[0][-REGION:], key=last[1][-REGION:], node=last[2][-REGION:])


_PAIR_SCHEMA = "a long, b long, tree int, key binary, node long"


def _orders(reps: DataFrame) -> DataFrame:
    """``tree, key, node``: each node in every order, with its first ``MAX_DEPTH`` components there."""
    return reps.select("node", F.concat("sig", "sig").alias("s"), F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")) \
        .select("tree", F.expr(f"substring(s, 1 + tree * {2 * MIN_DEPTH}, {2 * MAX_DEPTH})").alias("key"), "node")


def candidates(reps: DataFrame) -> DataFrame:
    """Distinct pairs ``a < b`` of neighbours in some order; ``reps`` has ``node, sig``."""
    orders = _orders(reps)
    n = shuffle_partitions(reps.sparkSession)
    ordered = orders.repartitionByRange(n, "tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    found = stage(map_arrow(ordered, lambda bs: _pairs_of_sorted(bs, True), _PAIR_SCHEMA), "forest")
    # across the borders of ranges: a few rows of each range, so as many as there are partitions
    ends = found.filter("node is not null").select("tree", "key", "node").distinct() \
        .coalesce(1).sortWithinPartitions("tree", "key", "node")
    across = map_arrow(ends, lambda bs: _pairs_of_sorted(bs, False), _PAIR_SCHEMA)
    pairs = stage(found.filter("a is not null").select("a", "b").unionByName(across.select("a", "b")).distinct(), "forest-pairs")
    drop_stage(found)
    return pairs


def postings(sets: DataFrame) -> DataFrame:
    """``h, node, size, rest, label`` of each shingle in the heads; ``rest`` counts the set's shingles from this one on."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                c = b.slice(at, 256)
                heads = [np.frombuffer(v, np.int64) for v in c.column("head").to_pylist()]
                n = [len(v) for v in heads]
                size = np.repeat(c.column("n_shingles").to_numpy(), n)
                yield pa.record_batch({
                    "h": pa.array(np.concatenate(heads)), "node": pa.array(np.repeat(c.column("node").to_numpy(), n)),
                    "size": pa.array(size.astype(np.int32)),
                    "rest": pa.array((size - np.concatenate([np.arange(k) for k in n])).astype(np.int32)),
                    "label": pa.array(np.repeat(c.column("label").to_numpy(), n))})

    return map_arrow(sets.select("node", "n_shingles", "head", "label"), spread, "h long, node long, size int, rest int, label long")


def _pairs_of_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a group from different components whose sizes and places leave room for the overlap asked."""
    for t in whole_groups(batches, "g"):
        g, node, label, block, own = (t[c].to_numpy() for c in ("g", "node", "label", "block", "own"))
        size, rest = t["size"].to_numpy().astype(np.int64), t["rest"].to_numpy().astype(np.int64)
        first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        place = np.arange(len(g)) - np.repeat(first, np.diff(np.append(first, len(g))))
        i, left, right, o = np.arange(len(g)), [], [], 0
        while len(i := i[place[i] > o]):
            o += 1
            j = i - o
            ok = (label[i] != label[j]) & (own[i] | (block[i] != block[j])) \
                & ((100 + SIMILAR) * np.minimum(rest[i], rest[j]) >= SIMILAR * (size[i] + size[j]))
            left.append(node[j[ok]])
            right.append(node[i[ok]])
        if left:
            x, y = np.concatenate(left), np.concatenate(right)
            yield pa.record_batch({"a": pa.array(np.minimum(x, y)), "b": pa.array(np.maximum(x, y))})


def pairs_apart(reps: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct pairs ``a < b`` of different components that may be similar: none that is similar is left out.

    ``reps`` has ``node, n_shingles, head``. A shingle whose documents are all of one component
    has no pairs; what the others need grows with the documents that share a rare shingle.
    """
    sets = reps.join(labels.select("node", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    every = postings(sets)
    shared = stage(every.groupBy("h").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
                   .filter("lo < hi").select("h", F.ceil(F.col("n") / BLOCK).alias("blocks")), "forest-shared")
    few = shared.count() <= BROADCAST_IDS
    found = every.join(F.broadcast(shared) if few else shared, "h").withColumn("block", F.expr("pmod(xxhash64(node), blocks)")) \
        .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    grouped = found.select(F.xxhash64("h", F.least("block", "other"), F.greatest("block", "other")).alias("g"), "node", "size", "rest",
                           "label", "block", (F.col("block") == F.col("other")).alias("own"))
    n = shuffle_partitions(reps.sparkSession)
    ordered = grouped.repartition(n, "g").sortWithinPartitions("g", "node")
    pairs = stage(map_arrow(ordered, _pairs_of_shingle, "a long, b long").distinct(), "forest-apart")
    drop_stage(shared)
    return pairs


def agreeing(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs whose signatures agree in enough components."""

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), ">u2").reshape(-1, COMPONENTS) for c in ("sa", "sb"))
            yield b.select(["a", "b"]).filter(pa.array((x == y).sum(1) >= MIN_AGREE))

    both = pairs.join(reps.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a") \
        .join(reps.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b")
    return map_arrow(both.select("a", "b", "sa", "sb"), agree, "a long, b long").distinct()


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets are similar."""
    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "forest-ids")
    few = ids.count() <= BROADCAST_IDS  # 8 bytes each; more of them meet the texts by a shuffle
    texts = stage(docs.select(F.col("doc_id").cast("long").alias("node"), "text")
                  .join(F.broadcast(ids) if few else ids, "node", "left_semi"), "forest-texts")
    drop_stage(ids)

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, last, x = [], None, None
            for r in range(b.num_rows):
                ta = b.column("ta")[r].as_py()
                if ta != last:  # the join leaves the pairs of a document together
                    last, x = ta, shingles(ta)
                y = shingles(b.column("tb")[r].as_py())
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= SIMILAR * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b") \
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    links = stage(map_arrow(both.select("a", "b", "ta", "tb"), similar, "a long, b long").distinct(), "forest-links")
    drop_stage(texts)
    return links


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that each linked node reaches. A scratch table."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    labels = stage(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
                   .select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy(F.col("u").alias("node")) \
            .agg(F.min("label").alias("m"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = stage(lower.join(jump, "label").select("node", "old", F.least("label", "next").alias("label")), "labels")
        moved = new.filter("label < old").limit(1).count()
        drop_stage(labels)
        labels = new
        if not moved:
            return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    signs = stage(signed(docs), "signatures")
    full = signs.filter("n_shingles > 0 and doc_id is not null")
    by_set = ["n_shingles", "f1", "f2"]
    reps = stage(full.groupBy(*by_set).agg(F.min("doc_id").alias("node"), F.first("sig").alias("sig"), F.first("head").alias("head")), "forest-reps")
    pairs = candidates(reps.select("node", "sig"))
    close = stage(agreeing(pairs, reps.select("node", "sig")), "forest-close")
    drop_stage(pairs)
    links = confirmed(close, docs)
    labels = components(links)
    nodes = reps.select("node", "sig")
    apart = pairs_apart(reps.select("node", "n_shingles", "head"), labels)
    near = stage(agreeing(apart, nodes), "forest-near")
    more = confirmed(near, docs)
    # rows that repeat an id with another text belong to the same document
    every = stage(_relabelled(more.unionByName(_same_id(full, reps)), labels), "forest-every")
    drop_stage(close, apart, near, links, more)
    if every.limit(1).count():
        first, joined = labels, components(every)
        labels = stage(_renamed(first, joined), "labels")
        drop_stage(first, joined)
    drop_stage(every)
    found = reps.select(*by_set, "node").join(labels.select("node", "label"), "node", "left") \
        .select(*by_set, F.coalesce("label", "node").alias("component_id"))
    ids = signs.select("doc_id", *by_set)
    linked = ids.filter("n_shingles > 0 and doc_id is not null").join(found, by_set)
    alone = ids.filter("n_shingles = 0 or doc_id is null").withColumn("component_id", F.col("doc_id"))
    return linked.unionByName(alone).select("doc_id", "n_shingles", "component_id",
                                            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _relabelled(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Links between components: a linked node stands for its label."""
    of = lambda c, out: labels.select(F.col("node").alias(c), F.col("label").alias(out))
    both = links.join(of("a", "la"), "a", "left").join(of("b", "lb"), "b", "left")
    return both.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).filter("a <> b").distinct()


def _renamed(labels: DataFrame, joined: DataFrame) -> DataFrame:
    """Labels after the components that they stand for have been joined."""
    new = joined.select(F.col("node").alias("label"), F.col("label").alias("new"))
    old = labels.join(new, "label", "left").select("node", F.coalesce("new", "label").alias("label"))
    return old.unionByName(joined.join(labels.select("node"), "node", "left_anti").select("node", "label"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id; rows without an id stay."""
    kept = near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id").distinct()
    one = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns)
    return one.unionByName(docs.filter("doc_id is null"))


def _same_id(full: DataFrame, reps: DataFrame) -> DataFrame:
    """Links between the sets of rows that share an id."""
    more = full.groupBy("doc_id").agg(F.min("f1").alias("lo"), F.max("f1").alias("hi")).filter("lo < hi").select("doc_id")
    sets = full.join(more, "doc_id", "left_semi").join(reps.select("n_shingles", "f1", "f2", "node"), ["n_shingles", "f1", "f2"])
    return sets.select(F.least("doc_id", "node").alias("a"), F.greatest("doc_id", "node").alias("b")).filter("a < b").distinct()
