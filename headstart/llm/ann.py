"""Approximate nearest neighbours by NN-descent (operator 5).

Nearness is the inner product. Equal vectors collapse to one node that remembers its
``k + 1`` smallest ids (no other copy can reach a top k), so copies never meet as pairs.

Nodes belong to parts by their id. A part's vectors and lists are matrices in one row, and parts send each
other rows of arrays: one for each pair of parts, not one for each node or pair of nodes.

1. First lists: ``ORDERS`` sorted orders of random sign codes are cut into blocks of ``BLOCK``
   consecutive nodes; within a block every node takes its best ``DEGREE`` others. The number of
   ranges follows the rows, and ranges overlap by about half a block, so rows on both sides of a
   border meet. ``TURN`` orders go at a time; the next ones tell only what improves the lists.
2. NN-descent, in rounds: a node is compared with its neighbours' neighbours: its neighbours, forward and
   reverse (at most ``MEMBERS`` of them, forward ones first), are compared with each other,
   and each is told the best ones that improve on the worst of its list, of pairs with an entry that the
   last round changed. A part gets the vector of a neighbour once, however many of its nodes list it.
   The rounds end when one has replaced
   at most the share ``DELTA`` of all list entries; larger tables take more rounds.
3. Queries search greedily: a query expands its best ``EXPAND`` nodes not yet
   expanded (more with a wider beam): their lists come to the query, and it is scored where the ids that are
   new to it live, until the best ``BEAM`` nodes it knows are all expanded. Then the
   recall is measured: ``PROBES`` queries (by hash) are compared with every node, in one pass.
   While it is below ``RECALL``, the beam doubles and the search goes on from where
   it stood, so the beam follows the size and the shape of the table. Where queries are many, the probes
   search alone until the beam is found, then all queries do with that beam. Twice the beam
   is remembered; the best ``BEAM`` nodes are scored again on the original vectors in
   double precision and expanded into the ids of their copies. Where a wider beam would score so many nodes that
   comparing a query with every node costs less (``SCANNED``), queries are compared with every node, and keep
   those that are nearer than their own list reaches: nothing nearer is missed then.

The graph works on vectors of one byte per component with a scale of their own. It is meant
for vectors of about equal length, as embeddings are; where lengths differ widely, few long
vectors fill all lists, and recall must be measured anew. The limits
above are the method's parameters; the tests measure the recall against
brute force as well (0.9 or more is asked; README has figures).

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part,
nor do rows with a null id; shorter vectors count as padded with zeros; a repeated query id
is asked once, with the vector of the smallest hash; rows with equal id and vector are one
candidate; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BATCH_BYTES, drop_stage, free_shuffles, map_arrow, shuffle_partitions, small_batches, stage

DEGREE = 40
ORDERS = 12
TURN = 4
BLOCK = 256
DELTA = 0.01
MEMBERS = 80
TOLD = 10
EXPAND = 32
BEAM = 128
PROBES = 400
RECALL = 0.94
#: Nodes compared in blocks at the price of one that the graph search scores, about (measured: 400 to 700).
SCANNED = 256
#: Nodes of a part, and of a range of an order, about.
PART = 16384

_GRAPH = "node long, vec binary, ids binary, sims binary, changed long"
_BEAM = "query long, vec binary, ids binary, sims binary, expanded binary"

#: Columns of what parts send each other: a row for each pair of parts and kind of message, with
#: arrays as binaries; ``src`` is the part that sent it.
_COLUMNS = ["a", "b", "c", "d", "e"]
_MAIL = "part int, kind int, src int, " + ", ".join(f"{c} binary" for c in _COLUMNS)
_OWN, _TOLD, _WANTED, _SENT, _QUERIES, _OPENED, _LISTED, _SCORE, _SCORED = range(9)
#: What a part gets, by kind: who sent it, and the arrays.
Mail = dict[int, list[tuple[int, list[bytes]]]]


def _row(part: int, kind: int, src: int, *arrays: np.ndarray | bytes) -> tuple:
    return part, kind, src, *[a if isinstance(a, bytes) else a.tobytes() for a in arrays], *[None] * (len(_COLUMNS) - len(arrays))


def _rows(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``BATCH_BYTES``, at least a row each."""
    held, size = [], 0
    kinds = [pa.int32()] * 3 + [pa.binary()] * len(_COLUMNS)
    names = ["part", "kind", "src", *_COLUMNS]

    def batch() -> pa.RecordBatch:
        return pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, zip(*held), kinds)})

    for r in rows:
        held.append(r)
        size += sum(len(x) for x in r[3:] if x)
        if size >= BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _at_parts(df: DataFrame, fn: Callable[[int, Mail], Iterator[tuple]]) -> DataFrame:
    """``fn(part, mail)`` for each part whose rows ``df`` holds, a partition for a part at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mail: dict[int, Mail] = {}
        for b in batches:
            for part, kind, src, *arrays in zip(*(c.to_pylist() for c in b.columns)):
                mail.setdefault(part, {}).setdefault(kind, []).append((src, arrays))
        while mail:
            part, own = mail.popitem()
            for kind in own.values():
                kind.sort(key=lambda m: m[0])
            yield from _rows(fn(part, own))

    return map_arrow(df.select("part", "kind", "src", *_COLUMNS), run, _MAIL)


def _delivered(parts: int, *mail: DataFrame) -> DataFrame:
    """The rows of all ``mail``, each part's in a partition of their own."""
    return reduce(DataFrame.unionByName, mail).repartitionById(parts, "part")


def _joined(mail: Mail, kind: int, *dtypes: str) -> list[np.ndarray]:
    """The arrays of all messages of a kind, one behind the other."""
    return [np.frombuffer(b"".join(m[i] for _, m in mail.get(kind, [])), t) for i, t in enumerate(dtypes)]


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of rows sorted by ``key`` that end where a key ends."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy()
        cut = int(np.searchsorted(k, k[-1]))
        if cut or held and held[-1].column(key)[-1].as_py() != k[0]:
            if t := [*held, b.slice(0, cut)]:
                yield pa.Table.from_batches(t)
            held = []
        held.append(b.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def quantized(x: np.ndarray) -> list[bytes]:
    """Rows as a 4-byte scale and one signed byte a component."""
    scale = np.maximum(np.abs(x).max(1), 1e-300) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return [s.tobytes() + v.tobytes() for s, v in zip(scale.astype("<f4"), q)]


def _vectors(raw: np.ndarray, kind: type = np.float32) -> tuple[np.ndarray, np.ndarray]:
    """(components, scales) of quantized rows, given as a matrix of bytes."""
    return raw[:, 4:].view(np.int8).astype(kind), np.ascontiguousarray(raw[:, :4]).view("<f4")[:, 0]


def _matrix(col: pa.Array) -> np.ndarray:
    """A binary column whose values have one length, as a matrix of bytes."""
    blobs = col.to_pylist()
    return np.frombuffer(b"".join(blobs), np.uint8).reshape(len(blobs), -1)


def _lists(col: pa.ChunkedArray | pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(all values, how many in each row) of a binary column; a null has none."""
    blobs = [b or b"" for b in col.to_pylist()]
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(blobs), kind), np.array([len(b) // size for b in blobs], np.int64)


def _only(lists: DataFrame, *columns: str) -> DataFrame:
    """Parts with only some of their arrays, the others empty."""
    return lists.select("part", "kind", "src", *(F.col(c) if c in columns else F.lit(b"").alias(c) for c in _COLUMNS))


class _Part:
    """A part's nodes, sorted: their vectors, lists (padded with their own id and similarity -inf) and which entries are fresh."""

    def __init__(self, mail: Mail):
        (self.arrays,) = [m for _, m in mail[_OWN]]
        node, vec, ids, sims, fresh = self.arrays
        self.node = np.frombuffer(node, "<i8")
        n = len(self.node)
        self.vec = np.frombuffer(vec, np.uint8).reshape(n, -1)
        self.ids, self.sims = np.frombuffer(ids, "<i8").reshape(n, -1), np.frombuffer(sims, "<f4").reshape(n, -1)
        self.fresh = np.frombuffer(fresh, np.bool_).reshape(n, -1)

    @property
    def least(self) -> np.ndarray:
        """The worst similarity in each list; -inf while it isn't full."""
        return self.sims[:, -1]


def _by_part(node: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``node`` by the part that owns it, and where each part's begin and end."""
    own = (node % parts).astype(np.int32)
    order = np.argsort(own, kind="stable")
    return order, np.searchsorted(own[order], np.arange(parts + 1))


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and their lengths."""
    first = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.empty(0, np.int64)
    return first, np.diff(np.append(first, len(x)))


def _places(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run."""
    return np.arange(int(n.sum())) - np.repeat(first, n)


def _mixed(x: np.ndarray) -> np.ndarray:
    """40 bits that differ for different ids, but for about one pair in 2^40."""
    return ((x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)).astype(np.int64)


def _down(x: np.ndarray) -> np.ndarray:
    """Whole numbers that grow as ``x`` falls."""
    bits = np.ascontiguousarray(x, "<f4").view("<i4").astype(np.int64)
    return np.where(bits < 0, bits & 0x7FFFFFFF, -bits) + (1 << 31)


def _tell(kind: int, src: int, node: np.ndarray, n: np.ndarray, ids: np.ndarray, sims: np.ndarray, parts: int) -> Iterator[tuple]:
    """Messages that tell each ``node`` its next ``n`` of (``ids``, ``sims``)."""
    order, cuts = _by_part(node, parts)
    starts = np.cumsum(n) - n
    for p in np.flatnonzero(np.diff(cuts)):
        some = order[cuts[p]:cuts[p + 1]]
        at = np.repeat(starts[some] - (np.cumsum(n[some]) - n[some]), n[some]) + np.arange(int(n[some].sum()))
        yield _row(int(p), kind, src, node[some], n[some].astype("<i4"), ids[at], sims[at])


def _best(row: np.ndarray, ids: np.ndarray, sims: np.ndarray, held_ids: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows' lists (``held_ids`` with similarities ``held``, best first) merged with the (``row``, ``ids``,
    ``sims``) told: ids, similarities and the columns taken, where those of ``held`` come first."""
    n, width = held.shape
    better = sims > held[:, -1][row]
    row, ids, sims = row[better], ids[better], sims[better]
    key = row.astype(np.int64) << 40 | _mixed(ids)
    order = np.argsort(key, kind="stable")
    key, row, ids, sims = key[order], row[order], ids[order], sims[order]
    new = np.append(True, (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])) if len(key) else np.empty(0, bool)
    for lo in range(0, len(row), 1 << 15):
        at = slice(lo, lo + (1 << 15))
        new[at] &= ~((held_ids[row[at]] == ids[at, None]) & (held[row[at]] > -np.inf)).any(1)
    row, ids, sims = row[new], ids[new], sims[new]
    order = np.argsort(row.astype(np.int64) << 32 | _down(sims), kind="stable")
    place = _places(*_runs(row[order]))
    order, place = order[place < width], place[place < width]
    out_ids, out_sims, out_cols = held_ids.copy(), held.copy(), np.tile(np.arange(width), (n, 1))
    if len(place):
        some, at = np.unique(row[order], return_inverse=True)
        room = int(place.max()) + 1
        all_ids = np.pad(held_ids[some], ((0, 0), (0, room)))
        all_sims = np.pad(held[some], ((0, 0), (0, room)), constant_values=-np.inf)
        all_ids[at, width + place], all_sims[at, width + place] = ids[order], sims[order]
        cols = np.argsort(-all_sims, 1, kind="stable")[:, :width]
        out_ids[some], out_sims[some] = np.take_along_axis(all_ids, cols, 1), np.take_along_axis(all_sims, cols, 1)
        out_cols[some] = cols
    return out_ids, out_sims, out_cols


def _dealt(base: DataFrame, parts: int, degree: int) -> DataFrame:
    """The rows of ``base`` as parts with empty lists."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                node, vec = b.column("node").to_numpy(), _matrix(b.column("vec"))
                order, cuts = _by_part(node, parts)
                yield from _rows(_row(int(p), _SENT, 0, node[order[cuts[p]:cuts[p + 1]]], vec[order[cuts[p]:cuts[p + 1]]])
                                 for p in np.flatnonzero(np.diff(cuts)))

    def own(part: int, mail: Mail) -> Iterator[tuple]:
        node, vec = _joined(mail, _SENT, "<i8", "u1")
        node, one = np.unique(node, return_index=True)
        shape = (len(node), degree)
        yield _row(part, _OWN, part, node, vec.reshape(-1, len(vec) // sum(len(m[0]) // 8 for _, m in mail[_SENT]))[one],
                   np.broadcast_to(node[:, None], shape), np.full(shape, -np.inf, "<f4"), np.zeros(shape, bool))

    return _at_parts(_delivered(parts, map_arrow(base.select("node", "vec"), deal, _MAIL)), own)


def _merged(told: DataFrame, lists: DataFrame, parts: int, joined: bool) -> DataFrame:
    """The lists after what was told; entries that weren't there before are ``fresh``, and all are that
    haven't ``joined`` in a round."""
    def merge(part: int, mail: Mail) -> Iterator[tuple]:
        own = _Part(mail)
        told, ids, sims, fresh = mail.pop(_TOLD, []), own.ids, own.sims, np.zeros(own.ids.shape, bool)
        while told:  # about a million entries at a time; the lists that they improve hold off the next
            some = [told.pop()]
            while told and sum(len(a[3]) for _, a in some) < 4 << 20:
                some.append(told.pop())
            node, n, new_ids, new_sims = _joined({_TOLD: some}, _TOLD, "<i8", "<i4", "<i8", "<f4")
            ids, sims, cols = _best(np.repeat(np.searchsorted(own.node, node), n), new_ids, new_sims, ids, sims)
            added = max(0, int(cols.max(initial=0)) + 1 - fresh.shape[1])
            fresh = np.take_along_axis(np.pad(fresh, ((0, 0), (0, added)), constant_values=True), cols, 1)
        yield _row(part, _OWN, part, own.node, own.vec, ids, sims, (sims > -np.inf) & (fresh | (not joined)))

    return stage(_at_parts(_delivered(parts, lists, told), merge), "ann-graph")


def first_lists(lists: DataFrame, base: DataFrame, dim: int, parts: int, seed: int = 5) -> DataFrame:
    """Best others of each node within blocks of sorted random codes.

    An order is cut into ranges of several blocks, by keys seen in part of the table; a range begins about
    half a block before its border, so that the rows on both sides of a border share a block.
    """
    n_nodes, degree, wide, turn = base.count(), DEGREE, BLOCK, TURN
    planes = np.random.default_rng(seed).normal(size=(ORDERS, 32, dim)).astype(np.float32)
    ranges = max(1, n_nodes // max(PART, 8 * wide))
    some = max(4096, 64 * ranges)

    def keys(node: np.ndarray, vec: np.ndarray, t: int) -> np.ndarray:
        """Sorts by code, then by id."""
        code = (_vectors(vec)[0] @ planes[t].T > 0) @ (np.int64(1) << np.arange(31, -1, -1))
        return (code.astype(np.int64) - (1 << 31) << 32) | (_mixed(node) & 0xFFFFFFFF)

    seen = base.filter(F.pmod(F.xxhash64("node"), F.lit(max(1, n_nodes // some))) == 0).select("node", "vec").toArrow().combine_chunks()
    ends = []  # of each order: where ranges end, and where the next ones begin
    for t in range(ORDERS):
        k = np.sort(keys(seen["node"].to_numpy(), _matrix(seen["vec"].combine_chunks()), t)) if seen.num_rows else np.empty(0, np.int64)
        at = np.arange(1, ranges) * len(k) // ranges
        ends.append((k[at], k[np.maximum(at - max(1, wide * len(k) // (2 * n_nodes)), 0)]) if len(k) else (k, k))

    def compared(orders: range) -> DataFrame:
        def send(part: int, mail: Mail) -> Iterator[tuple]:
            own = _Part(mail)
            for t in orders:
                key = keys(own.node, own.vec, t)
                inner, outer = ends[t]
                at = np.searchsorted(inner, key, "right")
                early = np.flatnonzero(key >= np.append(outer, np.iinfo(np.int64).max)[at])
                rows, at = np.append(np.arange(len(key)), early), np.append(at, at[early] + 1)
                order = np.argsort(at, kind="stable")
                cuts = np.searchsorted(at[order], np.arange(ranges + 1))
                for r in np.flatnonzero(np.diff(cuts)):
                    some = rows[order[cuts[r]:cuts[r + 1]]]
                    yield _row((t - orders.start) * ranges + int(r), _SENT, part, own.node[some], own.vec[some], key[some], own.least[some])

        def compare(part: int, mail: Mail) -> Iterator[tuple]:
            node, vec, key, least = _joined(mail, _SENT, "<i8", "u1", "<i8", "<f4")
            order = np.lexsort((node, key))
            node, vec, least = node[order], vec.reshape(len(node), -1)[order], least[order]
            x, scale = _vectors(vec)
            many = max(1, len(node) // wide)
            step = max(1, (1 << 19) // wide ** 2)
            cuts = [*(wide * i for i in range(0, many - 1, step)), (many - 1) * wide, len(node)]
            found = [block(*(v[lo:hi].reshape(-1, wide if hi < len(node) else hi - lo, *v.shape[1:]) for v in (node, x, scale, least)))
                     for lo, hi in zip(cuts, cuts[1:])]
            yield from _tell(_TOLD, part, node, *map(np.concatenate, zip(*found)), parts)

        def block(node: np.ndarray, x: np.ndarray, scale: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
            """Of blocks of one size: how many others each node is told, which, and their similarities."""
            s = np.matmul(x, x.transpose(0, 2, 1)) * (scale[:, :, None] * scale[:, None])
            m = s.shape[1]
            s[:, np.arange(m), np.arange(m)] = -np.inf
            cols = np.argpartition(-s, min(degree, m) - 1, axis=2)[:, :, :degree]
            sims = np.take_along_axis(s, cols, 2)
            ok = sims > least[:, :, None]
            return ok.sum(2).ravel(), np.take_along_axis(np.broadcast_to(node[:, None], s.shape), cols, 2)[ok], sims[ok]

        return _at_parts(_delivered(len(orders) * ranges, _at_parts(lists, send)), compare)

    for lo in range(0, ORDERS, turn):  # some orders at a time: only what improves on the orders before is told
        last, lists = lists, _merged(compared(range(lo, min(ORDERS, lo + turn))), lists, parts, joined=False)
        drop_stage(last)
        if n_nodes > 4 * PART:
            free_shuffles(base.sparkSession)
    return lists


def _wanted(lists: DataFrame, parts: int) -> DataFrame:
    """What each part asks the others for: the vectors of the nodes it lists. With its own row."""
    def ask(part: int, mail: Mail) -> Iterator[tuple]:
        own = _Part(mail)
        ids = np.unique(own.ids[own.sims > -np.inf])
        order, cuts = _by_part(ids, parts)
        for p in np.flatnonzero(np.diff(cuts)):
            yield _row(int(p), _WANTED, part, ids[order[cuts[p]:cuts[p + 1]]])
        yield _row(part, _OWN, part, *own.arrays)

    return _at_parts(lists, ask)


def _sent_vectors(lists: DataFrame, parts: int) -> DataFrame:
    """To every part, once each, the vectors that its nodes list and those of the nodes that list them,
    with who lists whom. With the part's own row."""
    def answer(part: int, mail: Mail) -> Iterator[tuple]:
        own = _Part(mail)
        row, col = np.nonzero(own.sims > -np.inf)
        to, fresh = own.ids[row, col], own.fresh[row, col]
        order, cuts = _by_part(to, parts)
        wanted = {src: np.searchsorted(own.node, np.frombuffer(a[0], "<i8")) for src, a in mail.get(_WANTED, [])}
        place = np.empty(len(own.node), np.uint32)
        for p in range(parts):
            at = order[cuts[p]:cuts[p + 1]]
            some = np.unique(np.concatenate([row[at], wanted.get(p, row[:0])]))
            if len(some):
                place[some] = np.arange(len(some))
                yield _row(p, _SENT, part, own.node[some], np.concatenate([own.vec[some], own.least[some, None].view(np.uint8)], 1),
                           place[row[at]], to[at], fresh[at])
        yield _row(part, _OWN, part, own.node, b"", *own.arrays[2:])

    return _at_parts(_delivered(parts, _wanted(lists, parts)), answer)


def _members(own: _Part, sent: list[tuple[int, list[bytes]]], limit: int) -> tuple[np.ndarray, ...]:
    """Of all nodes sent: ids, vectors with the worst similarity of their lists; and for each own node its
    at most ``limit`` members (as rows of these, -1 for none), forward ones first, and which are fresh."""
    sizes = np.array([len(a[0]) // 8 for _, a in sent])
    ids, vec = (np.frombuffer(b"".join(a[i] for _, a in sent), t) for i, t in ((0, "<i8"), (1, "u1")))
    vec = vec.reshape(len(ids), -1)
    place, to, fresh = (np.frombuffer(b"".join(a[i] for _, a in sent), t) for i, t in ((2, "<u4"), (3, "<i8"), (4, np.bool_)))
    who = place.astype(np.int64) + np.repeat(np.cumsum(sizes) - sizes, [len(a[3]) // 8 for _, a in sent])
    order = np.argsort(ids)
    forward = np.full((len(own.node), limit), -1, np.int64)
    degree = own.ids.shape[1]
    listed = own.sims > -np.inf
    forward[:, :degree][listed] = order[np.searchsorted(ids[order], own.ids[listed])]
    new = np.zeros(forward.shape, bool)
    new[:, :degree] = own.fresh & listed
    # reverse ones: each once, in an order that differs from node to node
    node = np.searchsorted(own.node, to)
    rank = _mixed(ids[who] ^ to) & 0xFFFF
    order = np.argsort(node << 16 | rank, kind="stable")
    node, who, fresh = node[order], who[order], fresh[order]
    mutual, at = np.zeros(len(node), bool), np.zeros(len(node), np.int64)
    for lo in range(0, len(node), 1 << 15):
        same = forward[node[lo:lo + (1 << 15)], :degree] == who[lo:lo + (1 << 15), None]
        mutual[lo:lo + (1 << 15)], at[lo:lo + (1 << 15)] = same.any(1), same.argmax(1)
    new[node[mutual], at[mutual]] |= fresh[mutual]
    node, who, fresh = node[~mutual], who[~mutual], fresh[~mutual]
    first, n = _runs(node)
    place = listed.sum(1)[node] + _places(first, n)
    fits = place < limit
    forward[node[fits], place[fits]], new[node[fits], place[fits]] = who[fits], fresh[fits]
    return ids, vec, forward, new


def _comparable(vec: np.ndarray) -> tuple[np.ndarray, ...]:
    """Components, scales and worst similarities of the vectors sent; the last row stands for no member."""
    x, scale = _vectors(np.concatenate([vec[:, :-4], np.zeros((1, vec.shape[1] - 4), np.uint8)]), np.int8)
    least = np.ascontiguousarray(vec[:, -4:]).view("<f4")[:, 0]
    return x, np.append(scale[:-1], np.float32(np.nan)), np.append(least, np.float32(np.inf))


def _compared_members(x: np.ndarray, scale: np.ndarray, least: np.ndarray, members: np.ndarray, new: np.ndarray,
                      told: int) -> tuple[np.ndarray, ...]:
    """The local join: a member hears of the ``told`` best other members that improve its list. Two that were
    members of the node in the round before have heard of each other."""
    out = [[np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.float32)]]
    m = members.shape[1]
    order = np.argsort(~new, 1, kind="stable")  # fresh ones first, nodes with many first
    members, count = np.take_along_axis(members, order, 1), np.count_nonzero(new, 1)
    order = np.argsort(-count, kind="stable")
    members, count = members[order], count[order]
    for lo in range(0, len(members), 64):
        at, k = members[lo:lo + 64], scale[members[lo:lo + 64]]
        v, most = x[at].astype(np.float32), int(count[lo])
        f = np.arange(m) < count[lo:lo + 64, None]
        if most <= told:  # so few that nobody hears of more than ``told`` fresh ones
            s = np.matmul(v[:, :most], v.transpose(0, 2, 1))
            s *= k[:, :most, None] * k[:, None, :]
            hit = (s > least[at][:, None, :]) & (f[:, :most, None] & ~f[:, None, :])  # the others hear of fresh ones
            flat = np.flatnonzero(hit)
            row, other = np.divmod(flat, m)
            out[0].append(at[row // most, other])
            out[1].append(at[row // most, row % most])
            out[2].append(s.ravel()[flat])
            hit = (s > least[at][:, :most, None]) & f[:, :most, None]  # fresh ones of all
        else:
            s = np.matmul(v, v.transpose(0, 2, 1))
            s *= k[:, :, None] * k[:, None, :]
            hit = s > least[at][:, :, None]
            hit &= f[:, :, None] | f[:, None, :]
        rows = np.arange(s.shape[1])
        hit[:, rows, rows] = False
        many = np.nonzero(np.count_nonzero(hit, 2) > told)
        if len(many[0]):
            values = np.where(hit[many], s[many], -np.inf)
            hit[many] &= values >= -np.partition(-values, told - 1, axis=1)[:, told - 1, None]
        flat = np.flatnonzero(hit)
        row, other = np.divmod(flat, m)
        out[0].append(at[row // len(rows), row % len(rows)])
        out[1].append(at[row // len(rows), other])
        out[2].append(s.ravel()[flat])
    member, other, sims = map(np.concatenate, out)
    key = member * len(x) + other
    order = np.argsort(key)
    order = order[np.append(True, np.diff(key[order]) > 0)] if len(key) else order
    return member[order], other[order], sims[order]


def descend(lists: DataFrame, parts: int) -> DataFrame:
    """One round of NN-descent."""
    limit, told = MEMBERS, TOLD

    def join(part: int, mail: Mail) -> Iterator[tuple]:
        if not mail.get(_SENT):
            return
        ids, vec, members, new = _members(_Part(mail), mail.pop(_SENT), limit)
        x, scale, least = _comparable(vec)
        some = np.flatnonzero(new.any(1))
        for lo in range(0, len(some), 2048):  # what some nodes' members are told is held at a time
            at = some[lo:lo + 2048]
            member, other, sims = _compared_members(x, scale, least, members[at], new[at], told)
            first, n = _runs(member)
            yield from _tell(_TOLD, part, ids[member[first]], n, ids[other], sims, parts)

    return _merged(_at_parts(_delivered(parts, _sent_vectors(lists, parts)), join), lists, parts, joined=True)


def _as_rows(lists: DataFrame) -> DataFrame:
    """``node, vec, ids, sims, changed`` of the parts' nodes; ``changed`` counts fresh entries."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in zip(*(b.column(c).to_pylist() for c in _COLUMNS)):
                own = _Part({_OWN: [(0, list(a))]})
                n = (own.sims > -np.inf).sum(1)
                yield pa.record_batch({
                    "node": pa.array(own.node), "vec": pa.array([v.tobytes() for v in own.vec], pa.binary()),
                    "ids": pa.array([v[:k].tobytes() for v, k in zip(own.ids, n)], pa.binary()),
                    "sims": pa.array([v[:k].tobytes() for v, k in zip(own.sims, n)], pa.binary()),
                    "changed": pa.array(own.fresh.sum(1), pa.int64())})

    return map_arrow(lists.select(*_COLUMNS), rows, _GRAPH)


def _changes(lists: DataFrame) -> tuple[int, int]:
    """Fresh entries of all lists, and all entries."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sims, fresh = (b.column(c).to_pylist() for c in ("d", "e"))
            yield pa.record_batch({"changed": pa.array([int(np.frombuffer(f, np.uint8).sum()) for f in fresh], pa.int64()),
                                   "entries": pa.array([int((np.frombuffer(s, "<f4") > -np.inf).sum()) for s in sims], pa.int64())})

    changed, entries = map_arrow(lists.select("d", "e"), count, "changed long, entries long").agg(F.sum("changed"), F.sum("entries")).first()
    return changed or 0, entries or 0


def build_graph(base: DataFrame, dim: int, rounds: int | None = None) -> DataFrame:
    """``node, vec, ids, sims, changed``: every node's neighbours, best first, after NN-descent
    until it has settled (or after ``rounds`` rounds). ``lists`` and ``parts`` of it are the same as parts."""
    small_batches(base.sparkSession)
    n = base.count()
    parts = max(1, -(-n // PART), min(shuffle_partitions(base.sparkSession), n // 1024))
    lists = first_lists(stage(_dealt(base, parts, DEGREE), "ann-graph"), base, dim, parts)
    done = 0
    while done != rounds:  # a list only ever improves, so the changes die out
        last, lists = lists, descend(lists, parts)
        drop_stage(last)
        if n > 4 * PART:
            free_shuffles(base.sparkSession)
        done += 1
        changed, entries = _changes(lists)
        if rounds is None and changed <= DELTA * entries:
            break
    graph = _as_rows(lists)
    graph.lists, graph.parts = lists, parts
    return graph


class _Beams:
    """A part's queries, each with what it knows, best first (padded with similarity -inf), and which of it is expanded."""

    def __init__(self, mail: Mail):
        query, vec, ids, sims, done = [b"".join(x) for x in zip(*(m for _, m in mail[_QUERIES]))]
        self.query = np.frombuffer(query, "<i8")
        n = len(self.query)
        self.vec = np.frombuffer(vec, np.uint8).reshape(n, -1)
        self.ids, self.sims = np.frombuffer(ids, "<i8").reshape(n, -1), np.frombuffer(sims, "<f4").reshape(n, -1)
        self.done = np.frombuffer(done, np.bool_).reshape(n, -1)

    def widen(self, width: int) -> None:
        pad = max(0, width - self.ids.shape[1])
        self.ids, self.done = np.pad(self.ids, ((0, 0), (0, pad))), np.pad(self.done, ((0, 0), (0, pad)))
        self.sims = np.pad(self.sims, ((0, 0), (0, pad)), constant_values=-np.inf)

    def row(self, part: int) -> tuple:
        return _row(part, _QUERIES, part, self.query, self.vec, self.ids, self.sims, self.done)


def _asked(lists: DataFrame, asked: DataFrame, parts: int) -> DataFrame:
    """The queries' beams at the start: their own lists."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node = b.column("node").to_numpy()
            order, cuts = _by_part(node, parts)
            yield from _rows(_row(int(p), _OPENED, 0, node[order[cuts[p]:cuts[p + 1]]]) for p in np.flatnonzero(np.diff(cuts)))

    def begin(part: int, mail: Mail) -> Iterator[tuple]:
        (node,) = _joined(mail, _OPENED, "<i8")
        if len(node):
            own = _Part(mail)
            at = np.flatnonzero(np.isin(own.node, node))
            yield _row(part, _QUERIES, part, own.node[at], own.vec[at], own.ids[at], own.sims[at], np.zeros(own.ids[at].shape, bool))

    return _at_parts(_delivered(parts, lists, map_arrow(asked.select("node"), deal, _MAIL)), begin)


def _frontier(beams: DataFrame, beam: int, expand: int, parts: int) -> DataFrame:
    """The best nodes of each beam that are not expanded yet, for their parts; and the beams, which then count them so."""
    def choose(part: int, mail: Mail) -> Iterator[tuple]:
        own = _Beams(mail)
        own.widen(2 * beam)
        open_ = ~own.done[:, :beam] & (own.sims[:, :beam] > -np.inf)
        open_ &= np.cumsum(open_, 1) <= expand
        own.done[:, :beam] |= open_
        query, col = np.nonzero(open_)
        node = own.ids[query, col]
        order, cuts = _by_part(node, parts)
        for p in np.flatnonzero(np.diff(cuts)):
            at = order[cuts[p]:cuts[p + 1]]
            yield _row(int(p), _OPENED, part, query[at].astype("<u4"), node[at])
        yield own.row(part)

    return _at_parts(beams, choose)


def _expanded(ahead: DataFrame, lists: DataFrame, parts: int) -> DataFrame:
    """The beams after the expansions: what the opened nodes list goes to the query, and from there the ids that
    are new to it, with its vector, to their own parts, which answer with those that improve its beam."""
    def lists_of(part: int, mail: Mail) -> Iterator[tuple]:
        own = _Part(mail)
        for src, (query, node, *_) in mail.get(_OPENED, []):
            at = np.searchsorted(own.node, np.frombuffer(node, "<i8"))
            yield _row(src, _LISTED, part, np.repeat(np.frombuffer(query, "<u4"), own.ids.shape[1]), own.ids[at])

    def new_ones(part: int, mail: Mail) -> Iterator[tuple]:
        if _QUERIES not in mail:
            return
        own = _Beams(mail)
        query, ids = _joined(mail, _LISTED, "<u4", "<i8")
        known = np.repeat(np.arange(len(own.query)), own.ids.shape[1])[(own.sims > -np.inf).ravel()]
        first = len(known) + len(own.query)
        query = np.concatenate([known, np.arange(len(own.query)), query]).astype(np.int64)
        ids = np.concatenate([own.ids[own.sims > -np.inf], own.query, ids])
        key = query << 40 | _mixed(ids)
        order = np.argsort(key, kind="stable")
        new = order[np.append(True, np.diff(key[order]) > 0)] if len(order) else order
        new = np.sort(new[new >= first])  # by message; within a part's, by query
        query, ids = query[new], ids[new]
        least, owner = own.sims[:, -1], ids % parts
        order = np.argsort(owner * len(own.query) + query, kind="stable")
        query, ids, owner = query[order], ids[order], owner[order]
        cuts = np.searchsorted(owner, np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(cuts)):
            at = slice(cuts[p], cuts[p + 1])
            begin, n = _runs(query[at])
            some = query[at][begin]
            yield _row(int(p), _SCORE, part, some.astype("<u4"), n.astype("<i4"), own.vec[some], least[some], ids[at])

    def scores(part: int, mail: Mail) -> Iterator[tuple]:
        own = _Part(mail)
        x, scale = _vectors(own.vec, np.int8)
        for src, arrays in mail.get(_SCORE, []):
            query, n, vec, least, ids = (np.frombuffer(a, t) for a, t in zip(arrays, ("<u4", "<i4", "u1", "<f4", "<i8")))
            q, q_scale = _vectors(vec.reshape(len(query), -1))
            at, asker = np.searchsorted(own.node, ids), np.repeat(np.arange(len(query)), n)
            s = np.empty(len(ids), np.float32)
            for lo in range(0, len(ids), 1 << 13):
                a, b = at[lo:lo + (1 << 13)], asker[lo:lo + (1 << 13)]
                s[lo:lo + (1 << 13)] = np.einsum("ij,ij->i", x[a].astype(np.float32), q[b]) * (scale[a] * q_scale[b])
            better = s > least[asker]
            if better.any():
                yield _row(src, _SCORED, part, query[asker[better]], ids[better], s[better])

    def improved(part: int, mail: Mail) -> Iterator[tuple]:
        if _QUERIES not in mail:
            return
        own = _Beams(mail)
        query, ids, sims = _joined(mail, _SCORED, "<u4", "<i8", "<f4")
        width = own.ids.shape[1]
        own.ids, own.sims, cols = _best(query.astype(np.int64), ids, sims, own.ids, own.sims)
        own.done = np.take_along_axis(np.pad(own.done, ((0, 0), (0, max(0, int(cols.max(initial=0)) + 1 - width)))), cols, 1)
        yield own.row(part)

    beams = ahead.filter(F.col("kind") == _QUERIES)
    listed = _at_parts(_delivered(parts, _only(lists, "a", "c"), ahead.filter(F.col("kind") == _OPENED)), lists_of)
    asked = _at_parts(_delivered(parts, beams, listed), new_ones)
    scored = _at_parts(_delivered(parts, _only(lists, "a", "b"), asked), scores)
    return _at_parts(_delivered(parts, beams, scored), improved)


def _beam_rows(beams: DataFrame) -> DataFrame:
    """``query, vec, ids, sims, expanded`` of the parts' queries."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in zip(*(b.column(c).to_pylist() for c in _COLUMNS)):
                own = _Beams({_QUERIES: [(0, list(a))]})
                known = own.sims > -np.inf
                yield pa.record_batch({
                    "query": pa.array(own.query), "vec": pa.array([v.tobytes() for v in own.vec], pa.binary()),
                    **{c: pa.array([v[k].tobytes() for v, k in zip(x, by)], pa.binary()) for c, x, by in
                       (("ids", own.ids, known), ("sims", own.sims, known), ("expanded", own.ids, own.done))}})

    return map_arrow(beams.select(*_COLUMNS), rows, _BEAM)


def probes(exact: DataFrame, asked: DataFrame, dim: int, k: int) -> DataFrame:
    """``query, true``: the ``k`` nearest nodes of at most ``PROBES`` nodes of ``asked``, by comparing
    them with all nodes. The probes' vectors are the only thing broadcast; a task keeps ``k`` for each."""
    some = exact.join(asked, "node", "left_semi").select("node", "x").orderBy(F.xxhash64("node"), "node").limit(PROBES).toArrow()
    query = some["node"].to_numpy()
    q = _padded(some["x"].combine_chunks(), dim)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, best = np.zeros((len(query), 0), np.int64), np.zeros((len(query), 0))
        for b in batches:
            if b.num_rows:
                node = b.column("node").to_numpy()
                ids = np.concatenate([ids, np.broadcast_to(node, (len(query), len(node)))], 1)
                best = np.concatenate([best, np.where(query[:, None] == node, -np.inf, q @ _padded(b.column("x"), dim).T)], 1)
                at = np.argpartition(-best, min(k, best.shape[1]) - 1, axis=1)[:, :k]
                ids, best = np.take_along_axis(ids, at, 1), np.take_along_axis(best, at, 1)
        ok = best > -np.inf
        yield pa.record_batch({"query": pa.array(np.repeat(query, ok.sum(1))), "node": pa.array(ids[ok]), "s": pa.array(-best[ok])})

    found = map_arrow(exact.select("node", "x"), compare, "query long, node long, s double")
    return found.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct("s", "node"))), 1, k).alias("t")) \
        .select("query", F.col("t.node").alias("true"))


def _padded(col: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(v.ljust(8 * dim, b"\0") for v in col.to_pylist()), "<f8").reshape(-1, dim)


def _recall(found: DataFrame, truth: DataFrame) -> float:
    """Share of the probes' true neighbours among the ``BEAM`` nodes that get scored exactly."""
    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = zip(b.column("ids").to_pylist(), b.column("true").to_pylist())
            yield pa.record_batch({"n": pa.array([len(t) for t in b.column("true").to_pylist()], pa.int64()),
                                   "hit": pa.array([np.isin(t, np.frombuffer(i, "<i8")[:BEAM]).sum() for i, t in pairs], pa.int64())})

    n, hit = map_arrow(truth.join(found.select("query", "ids"), "query"), hits, "n long, hit long").agg(F.sum("n"), F.sum("hit")).first()
    return hit / n if n else 1.0


def _settled(beams: DataFrame, lists: DataFrame, parts: int, width: int, freed: bool) -> DataFrame:
    """``beams`` (which go) after the greedy search: the best ``width`` nodes of each are expanded."""
    hops = 0
    while True:  # ends: a node is expanded once while a query holds it, and only better ones enter its beam
        ahead = stage(_frontier(beams, width, max(1, EXPAND * width // BEAM), parts), "ann-ahead")
        drop_stage(beams)
        if ahead.filter(F.col("kind") == _OPENED).isEmpty():
            return ahead
        beams = stage(_expanded(ahead, lists, parts), "ann-beam")
        drop_stage(ahead)
        hops += 1
        if freed and hops % 4 == 0:
            free_shuffles(lists.sparkSession)


def _compared(beams: DataFrame, lists: DataFrame, parts: int, k: int) -> DataFrame:
    """``beams`` (which go) with all nodes of the table that are nearer than a query's own list reaches
    (or all, where a list can't hold ``k + 1``), the best ``BEAM`` at most."""
    beam, degree = max(BEAM, k + 1), DEGREE
    cells = min(parts, max(shuffle_partitions(lists.sparkSession), parts // 16))

    def send(part: int, mail: Mail) -> Iterator[tuple]:
        own = _Beams(mail)
        least = own.sims[:, degree - 1] if k < degree else np.full(len(own.query), -np.inf, "<f4")
        for cell in range(cells):
            yield _row(cell, _SCORE, part, own.query, own.vec, least)

    def compare(part: int, mail: Mail) -> Iterator[tuple]:
        node, vec = (np.frombuffer(b"".join(m[i] for _, m in mail.get(_OWN, [])), t) for i, t in ((0, "<i8"), (1, "u1")))
        if not len(node):
            return
        x, scale = _vectors(vec.reshape(len(node), -1), np.int8)
        for src, arrays in mail.get(_SCORE, []):
            query, raw, least = (np.frombuffer(v, t) for v, t in zip(arrays, ("<i8", "u1", "<f4")))
            q, q_scale = _vectors(raw.reshape(len(query), -1))
            found = [[], [], []]
            step = 512 if np.isfinite(least).all() else 16
            for lo in range(0, len(query), step):
                some = slice(lo, lo + step)
                low = (least[some] - np.float32(1e-5) * np.abs(least[some])) / q_scale[some]
                near = [[np.empty(0, np.int64)] * 2]
                for at in range(0, len(node), 2048):  # a block of scores stays in the processor's cache
                    y = x[at:at + 2048].astype(np.float32) * scale[at:at + 2048, None]
                    flat = np.flatnonzero(q[some] @ y.T >= low[:, None])
                    near.append((flat // len(y) + lo, flat % len(y) + at))
                who, row = (np.concatenate(v) for v in zip(*near))
                s = np.empty(len(who), np.float32)
                for k in range(0, len(who), 1 << 13):
                    i, j = who[k:k + (1 << 13)], row[k:k + (1 << 13)]
                    s[k:k + (1 << 13)] = np.einsum("ij,ij->i", x[j].astype(np.float32), q[i]) * (scale[j] * q_scale[i])
                ok = node[row] != query[who]
                who, row, s = who[ok], row[ok], s[ok]
                order = np.argsort(who << 32 | _down(s), kind="stable")
                order = order[_places(*_runs(who[order])) < beam]
                for c, v in zip(found, (who[order].astype("<u4"), node[row[order]], s[order])):
                    c.append(v)
            yield _row(src, _SCORED, part, *map(np.concatenate, found))

    def improved(part: int, mail: Mail) -> Iterator[tuple]:
        if _QUERIES in mail:
            own = _Beams(mail)
            query, ids, sims = _joined(mail, _SCORED, "<u4", "<i8", "<f4")
            own.widen(beam)
            own.ids, own.sims, _ = _best(query.astype(np.int64), ids, sims, own.ids, own.sims)
            own.done = np.zeros(own.ids.shape, bool)
            yield own.row(part)

    dealt = _only(lists, "a", "b").withColumn("part", F.col("part") % cells)
    scored = _at_parts(_delivered(cells, dealt, _at_parts(beams, send)), compare)
    out = stage(_at_parts(_delivered(parts, beams, scored), improved), "ann-ahead")
    drop_stage(beams)
    return out


def search(graph: DataFrame, asked: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """``query, vec, ids, sims, expanded``: what every node of ``asked`` knows after the greedy
    search. A scratch table.

    Where queries are many, the probes of ``truth`` go ahead and find the width of the beam. Where the graph would score so many nodes
    that comparing a query with all of them costs less, it is compared with all.
    """
    lists, parts = graph.lists, graph.parts
    size = lists.agg(F.sum(F.length("a") / 8)).first()[0] or 0
    freed = size > 4 * PART
    ahead = asked.count() > 25 * PROBES  # fewer queries all search at once
    width = BEAM
    first = truth.select(F.col("query").alias("node")) if ahead else asked
    beams = _settled(stage(_asked(lists, first, parts), "ann-beam"), lists, parts, width, freed)
    while (share := _recall(_beam_rows(beams), truth)) < RECALL and width < size:
        width *= 2
        if width * DEGREE * SCANNED > size:
            break
        beams = _settled(beams, lists, parts, width, freed)
    if ahead:
        drop_stage(beams)
        beams = stage(_asked(lists, asked, parts), "ann-beam")
        if share >= RECALL:
            beams = _settled(beams, lists, parts, width, freed)
    if share < RECALL:
        beams = _compared(beams, lists, parts, k)
    found = stage(_beam_rows(beams), "ann-found")
    drop_stage(beams)
    return found


def keyed(vectors: DataFrame) -> DataFrame:
    """``vec_id, x`` of the rows that take part; ``x`` holds the components as 8-byte floats.

    -0.0 is 0, and zeros at the end don't count, so equal vectors have equal ``x``.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    clean = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()) \
        .select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")) \
        .filter(F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
                & F.exists("embedding", lambda v: v != 0))

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [np.trim_zeros(v.values.to_numpy(zero_copy_only=False) + 0.0, "b").tobytes() for v in b.column("embedding")]
            yield pa.record_batch({"vec_id": b.column("vec_id"), "x": pa.array(x, pa.binary())})

    return map_arrow(clean, bytes_of, "vec_id long, x binary")


def nodes(vectors: DataFrame, k: int) -> DataFrame:
    """``node, x, copies``: distinct vectors (``node`` is their 64-bit hash), with their ``k + 1`` smallest ids."""

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The smallest ids of each vector of the partition, before anything is shuffled."""
        ids: dict[bytes, set[int]] = {}
        for b in batches:
            for i, x in zip(b.column("vec_id").to_pylist(), b.column("x").to_pylist()):
                own = ids.setdefault(x, set())
                own.add(i)
                if len(own) > 4 * (k + 1):
                    ids[x] = set(sorted(own)[:k + 1])
        yield pa.record_batch({"x": pa.array(list(ids), pa.binary()),
                               "ids": pa.array([sorted(v)[:k + 1] for v in ids.values()], pa.list_(pa.int64()))})

    part = map_arrow(keyed(vectors), smallest, "x binary, ids array<bigint>")
    one = part.groupBy("x").agg(F.flatten(F.collect_list("ids")).alias("ids"))
    return one.select(F.xxhash64("x").alias("node"), "x", F.slice(F.array_sort(F.array_distinct("ids")), 1, k + 1).alias("copies"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(query, node) for every node of a beam, and for the query's own node."""
    for b in batches:
        query = b.column("query").to_numpy()
        ids, n = _lists(pa.array([i[:8 * BEAM] for i in b.column("ids").to_pylist()], pa.binary()), "<i8")
        yield pa.record_batch({"query": pa.array(np.append(np.repeat(query, n), query)), "node": pa.array(np.append(ids, query))})


def nearest(vectors: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row where ``queries``."""
    exact = stage(nodes(vectors, k), "ann-nodes")
    dim = int(exact.agg(F.max(F.length("x"))).first()[0] or 8) // 8

    def quantize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.record_batch({"node": b.column("node"), "vec": pa.array(quantized(_padded(b.column("x"), dim)), pa.binary())})

    base = stage(map_arrow(exact.select("node", "x"), quantize, "node long, vec binary"), "ann-base")
    graph = build_graph(base, dim)
    asked = stage(keyed(vectors.filter(queries)).groupBy(F.col("vec_id").alias("query_id"))
                  .agg(F.min(F.xxhash64("x")).alias("node")), "ann-asked")
    truth = stage(probes(exact, asked, dim, k), "ann-probes")
    beam = search(graph, asked.select("node").distinct(), truth, k)
    drop_stage(base, graph.lists, truth)

    pairs = map_arrow(beam.select("query", "ids"), _kept, "query long, node long") \
        .join(exact.select("node", F.col("x").alias("y"), "copies"), "node") \
        .join(exact.select(F.col("node").alias("query"), "x"), "query")

    def rescore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = (_padded(b.column("x"), dim) * _padded(b.column("y"), dim)).sum(1)
            yield pa.record_batch({"query": b.column("query"), "score": pa.array(score), "copies": b.column("copies")})

    scored = map_arrow(pairs.select("query", "x", "y", "copies"), rescore, "query long, score double, copies array<bigint>")
    # the k + 1 best of a node serve all its copies: each leaves itself out
    listed = scored.select("query", F.explode(F.transform(
        "copies", lambda c: F.struct((-F.col("score")).alias("s"), c.alias("i")))).alias("r"))
    best = listed.groupBy(F.col("query").alias("node")).agg(F.slice(F.array_sort(F.collect_list("r")), 1, k + 1).alias("best"))
    others = asked.join(best, "node").select(
        "query_id", F.slice(F.filter("best", lambda r: r["i"] != F.col("query_id")), 1, k).alias("best"))
    return others.select("query_id", F.posexplode("best").alias("p", "r")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("r.i").alias("vec_id"), (F.lit(0.0) - F.col("r.s")).alias("score"))
