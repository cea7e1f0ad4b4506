"""Language-model scoring by deleted interpolation (operator 10).

The probability of a token w after u mixes the maximum-likelihood estimates of its bigram and
its unigram and a uniform share, with weights that depend on how often the context u was
seen (buckets by powers of two):

    p(w | u) = l2[b(u)] c(u, w) / c(u) + l1[b(u)] c(w) / N + l0[b(u)] / (V + 1)

The weights are learned by expectation-maximisation on held-out counts: one fold of the
training documents is deleted from the counts, and its tokens are the events. The final
scores use the counts of all training documents.

How counts are gathered: documents form chunks of about ``CHUNK_TOKENS`` tokens where they
are read. A chunk sends the distinct hashes of its words (64 bits) and bigrams (48 bits)
with their local counts to the owners of hash ranges (pre-aggregated, so a frequent word is
one entry per chunk), and the owners send back the totals in the same order. The number of
owners grows with the corpus; no count table is collected or broadcast. Only totals and the
EM events, summed over a fixed grid of (bucket, p2, p1), reach the driver.

Edge cases: a null or empty text is its end token alone; every row is scored, also repeated
ones and those with a null id; without training documents every count is 0 and the model is
uniform; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_shuffles, map_arrow, stage

CHUNK_TOKENS = 1_000_000
TOKENS_PER_OWNER = 500_000
CORE, HELD, TEST = 0, 1, 2  # roles: counted for EM; deleted from those counts; not trained on
END_HASH = np.uint64(xxhash.xxh3_64_intdigest(b"end", seed=10))
BUCKETS = 40
EM_ROUNDS = 60
STEPS = 4  # EM grid cells to a factor of two
BIGRAM_BITS = np.uint64(48)

_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_GAP = np.uint64(0xFFFFFFFF)


class _Index(dict):
    """Numbers words as they come."""

    def __missing__(self, w: bytes) -> int:
        n = self[w] = len(self)
        return n


class _Building:
    """A chunk that documents are added to."""

    def __init__(self) -> None:
        self.index, self.ids, self.roles, self.parts, self.size = _Index(), [], [], [], 0

    def add(self, doc_id: int | None, role: int, text: str | None) -> None:
        words = text.encode("utf-8", "replace").lower().split() if text else []
        words.append(None)  # the end
        self.parts.append(np.fromiter(map(self.index.__getitem__, words), np.uint32, len(words)))
        self.ids.append(doc_id)
        self.roles.append(role)
        self.size += len(words)

    def row(self, chunk: int) -> pa.RecordBatch:
        vocab = np.fromiter((END_HASH if w is None else xxhash.xxh3_64_intdigest(w) for w in self.index), np.uint64, len(self.index))
        # words are numbered as they come, so high bytes are mostly zero: byte by byte they pack well
        stream = np.concatenate(self.parts).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
        blobs = {"roles": np.array(self.roles, np.uint8), "lens": np.array([len(p) for p in self.parts], "<i4"), "vocab": vocab,
                 "stream": np.frombuffer(pa.compress(stream, "zstd", asbytes=True), np.uint8)}
        return pa.record_batch({"chunk": pa.array([chunk], pa.int64()), "tokens": pa.array([self.size], pa.int64()),
                                "doc_ids": pa.array([self.ids], pa.list_(pa.int64()))}
                               | {k: pa.array([v.tobytes()], pa.binary()) for k, v in blobs.items()})


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks: document ids, roles and lengths, the words' hashes, and the tokens as word numbers.

    Held-out documents have chunks of their own, with odd numbers: only those make EM events.
    """
    number, task = 0, TaskContext.get().partitionId()
    building = {False: _Building(), True: _Building()}
    for b in batches:
        for i, role, text in zip(b.column("doc_id").to_pylist(), b.column("role").to_pylist(), b.column("text").to_pylist()):
            held = role == HELD
            building[held].add(i, role, text)
            if building[held].size >= CHUNK_TOKENS:
                yield building[held].row(task << 32 | number << 1 | held)
                number, building[held] = number + 1, _Building()
    for held, c in building.items():
        if c.size:
            yield c.row(task << 32 | number << 1 | held)


_CHUNK_SCHEMA = "chunk long, tokens long, doc_ids array<long>, roles binary, lens binary, vocab binary, stream binary"


@dataclass
class _Chunk:
    """A chunk's tokens, with each token's context, the document it is of and that one's role."""

    doc_ids: list
    roles: np.ndarray
    starts: np.ndarray
    vocab: np.ndarray
    token: np.ndarray
    context: np.ndarray
    role: np.ndarray

    @classmethod
    def of(cls, r: dict) -> _Chunk:
        lens, vocab = np.frombuffer(r["lens"], "<i4"), np.frombuffer(r["vocab"], np.uint64)
        roles, n = np.frombuffer(r["roles"], np.uint8), r["tokens"]
        planes = np.frombuffer(pa.decompress(r["stream"], 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n)
        token = np.ascontiguousarray(planes.T).view("<u4")[:, 0].astype(np.int64)
        starts = np.cumsum(lens) - lens
        context = np.roll(token, 1)
        context[starts] = np.flatnonzero(vocab == END_HASH)[0]  # a document begins after an end
        return cls(r["doc_ids"], roles, starts, vocab, token, context, np.repeat(roles, lens))

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of the words, and where each word number stands among them."""
        order = np.argsort(self.vocab)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        return self.vocab[order], place

    def bigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct hashes of the bigrams, and where each token's stands among them."""
        h = self.vocab[self.context] * _K1 + self.vocab[self.token] * _K2
        h ^= h >> np.uint64(32)
        h *= _K3
        return np.unique(h >> (np.uint64(64) - BIGRAM_BITS), return_inverse=True)


def _small(x: np.ndarray) -> bytes:
    """Counts as bytes: one each if that holds them, else four each; the first byte tells which."""
    return b"\1" + x.astype(np.uint8).tobytes() if x.max(initial=0) < 256 else b"\4" + x.astype("<u4").tobytes()


def _large(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.uint8 if b[0] == 1 else "<u4", offset=1).astype(np.int64)


def _sorted_bytes(keys: np.ndarray) -> bytes:
    """Sorted keys as 32-bit gaps (a full gap stands for no key), or as they are if that is shorter."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    full = (gaps // _GAP).astype(np.int64)
    if (len(keys) + int(full.sum())) >= 2 * len(keys):
        return b"\0" + keys.tobytes()
    out = np.full(len(keys) + int(full.sum()), _GAP, np.uint64)
    out[np.cumsum(full + 1) - 1] = gaps % _GAP
    return b"\1" + out.astype("<u4").tobytes()


def _sorted_keys(b: bytes) -> np.ndarray:
    if b[0] == 0:
        return np.frombuffer(b, np.uint64, offset=1)
    gaps = np.frombuffer(b, "<u4", offset=1).astype(np.uint64)
    return np.cumsum(gaps)[gaps != _GAP]


def _sent(chunks: DataFrame, owners: int, grams: str) -> DataFrame:
    """``owner, chunk, keys, core, held``: a chunk's distinct keys of each owner's range and its counts."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = 64 if grams == "words" else int(BIGRAM_BITS)
        width = np.uint64(((1 << bits) - 1) // owners + 1)
        for b in batches:
            for r in b.to_pylist():
                c = _Chunk.of(r)
                keys, place = c.words() if grams == "words" else c.bigrams()
                at = place[c.token] if grams == "words" else place
                counts = [np.bincount(at[c.role == role], minlength=len(keys)) for role in (CORE, HELD)]
                owner = (keys // width).astype(np.int64)
                cuts = [*np.flatnonzero(np.diff(owner, prepend=-1)), len(keys)]
                rows = [[], [], [], []]
                for lo, hi in zip(cuts, cuts[1:]):
                    base = np.uint64(owner[lo]) * width
                    for col, v in zip(rows, (int(owner[lo]), _sorted_bytes(keys[lo:hi] - base), *(_small(x[lo:hi]) for x in counts))):
                        col.append(v)
                yield pa.record_batch({"owner": pa.array(rows[0], pa.int32()), "chunk": pa.array([r["chunk"]] * len(rows[0]), pa.int64()),
                                       "keys": pa.array(rows[1], pa.binary()), "core": pa.array(rows[2], pa.binary()),
                                       "held": pa.array(rows[3], pa.binary())})

    return map_arrow(chunks, send, "owner int, chunk long, keys binary, core binary, held binary")


def _owned(t: pa.Table) -> pa.Table:
    """An owner's answer: for each chunk the total counts of the keys it sent, and a row of sums."""
    blobs = [[x.as_py() for x in t[c]] for c in ("keys", "core", "held")]
    keys = [_sorted_keys(b) for b in blobs[0]]
    core, held = (np.concatenate([_large(b) for b in x]) for x in blobs[1:])
    types, at = np.unique(np.concatenate(keys), return_inverse=True)
    core = np.bincount(at, core, len(types)).astype(np.int64)
    train = core + np.bincount(at, held, len(types)).astype(np.int64)
    cuts = np.cumsum([0] + [len(k) for k in keys])
    answers = [[_small(x[at[lo:hi]]) for lo, hi in zip(cuts, cuts[1:])] + [None] for x in (train, core)]
    n = len(keys)
    sums = [int((train > 0).sum()), int(train.sum()), int((core > 0).sum()), int(core.sum())]
    return pa.table({"owner": pa.concat_arrays([t["owner"].combine_chunks(), t["owner"].combine_chunks()[:1]]),
                     "chunk": pa.array(t["chunk"].to_pylist() + [None], pa.int64()),
                     "train": pa.array(answers[0], pa.binary()), "core": pa.array(answers[1], pa.binary())}
                    | {k: pa.array([None] * n + [v], pa.int64()) for k, v in zip(("v", "n", "v_core", "n_core"), sums)})


_ANSWER = "owner int, chunk long, train binary, core binary, v long, n long, v_core long, n_core long"


def _answers(chunks: DataFrame, owners: int, grams: str) -> DataFrame:
    return stage(_sent(chunks, owners, grams).groupBy("owner").applyInArrow(_owned, _ANSWER), f"lm-{grams}")


def bucket(context_count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2 of its count)."""
    return np.minimum(np.frexp(context_count.astype(np.float64))[1], BUCKETS - 1)


def _with_counts(chunks: DataFrame, words: DataFrame, bigrams: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(chunk, which)`` per chunk; ``which`` gives (c(w), c(u), c(u, w)) per token for "train" or "core"."""
    both = words.filter("chunk is not null").select(F.lit(0).alias("kind"), "chunk", "owner", "train", "core") \
        .unionByName(bigrams.filter("chunk is not null").select(F.lit(1).alias("kind"), "chunk", "owner", "train", "core"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        c = _Chunk.of(left.to_pylist()[0])
        got = sorted(right.to_pylist(), key=lambda r: (r["kind"], r["owner"]))
        place, at = c.words()[1], c.bigrams()[1]

        def counts(which: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            w, pair = (np.concatenate([_large(r[which]) for r in got if r["kind"] == k]) for k in (0, 1))
            w = w[place]
            return w[c.token], w[c.context], pair[at]

        return fn(c, counts)

    return chunks.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(run, schema)


def _estimates(word, context, pair, n: int) -> tuple[np.ndarray, np.ndarray]:
    return pair / np.maximum(context, 1), word / max(n, 1)


def _events(chunks: DataFrame, words: DataFrame, bigrams: DataFrame, n_core: int) -> np.ndarray:
    """Held-out tokens on a grid: rows of bucket, mean p2, mean p1, how many."""

    def grid(c: _Chunk, counts) -> pa.Table:
        held = c.role == HELD
        word, context, pair = (x[held] for x in counts("core"))
        p2, p1 = _estimates(word, context, pair, n_core)
        # a token that the estimates give nothing (or only one of them) has a cell of its own
        cells = [np.where(p > 0, np.floor(STEPS * np.log2(np.where(p > 0, p, 1))), 1).astype(np.int64) for p in (p2, p1)]
        key = (bucket(context) * 1024 + cells[0] + 512) * 1024 + cells[1] + 512
        cell, at = np.unique(key, return_inverse=True)
        return pa.table({"cell": pa.array(cell, pa.int64())} | {
            k: pa.array(np.bincount(at, x, len(cell)), pa.float64()) for k, x in (("p2", p2), ("p1", p1), ("n", np.ones(len(at))))})

    rows = (_with_counts(chunks, words, bigrams, grid, "cell long, p2 double, p1 double, n double")
            .groupBy("cell").agg(*(F.sum(c).alias(c) for c in ("p2", "p1", "n"))).orderBy("cell").toArrow())
    n = rows["n"].to_numpy()
    return np.stack([rows["cell"].to_numpy() // 1024 // 1024, rows["p2"].to_numpy() / n, rows["p1"].to_numpy() / n, n], 1)


def learn_weights(events: np.ndarray, p0: float, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Mixture weights (bucket x (bigram, unigram, uniform)) by expectation-maximisation.

    A bucket without events has the weights of all events together.
    """
    def em(e: np.ndarray) -> np.ndarray:
        p = np.stack([e[:, 1], e[:, 2], np.full(len(e), p0)], 1)
        w = np.full(3, 1 / 3)
        for _ in range(rounds):
            share = w * p
            share /= share.sum(1, keepdims=True)
            w = (share * e[:, 3:]).sum(0)
            w = np.maximum(w / w.sum(), 1e-6)
            w /= w.sum()
        return w

    every = em(events) if len(events) else np.full(3, 1 / 3)
    return np.stack([em(events[events[:, 0] == b]) if (events[:, 0] == b).any() else every for b in range(BUCKETS)])


def score(docs: DataFrame, role: Column) -> DataFrame:
    """``doc_id, role, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    ``role`` is 0 for training documents, 1 for those whose counts EM holds out, 2 for others.
    """
    chunks = stage(map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), role.cast("int").alias("role"), "text"),
                             _chunk_rows, _CHUNK_SCHEMA), "lm-chunks")
    tokens = chunks.agg(F.sum("tokens").alias("n")).first().n or 0
    owners = max(8, int(tokens // TOKENS_PER_OWNER))
    words = _answers(chunks, owners, "words")
    free_shuffles(chunks.sparkSession)
    bigrams = _answers(chunks, owners, "bigrams")
    free_shuffles(chunks.sparkSession)
    v, n, v_core, n_core = (int(x or 0) for x in words.agg(*(F.sum(c) for c in ("v", "n", "v_core", "n_core"))).first())
    odd = lambda t: t.filter(F.col("chunk") % 2 == 1)
    weights = learn_weights(_events(odd(chunks), odd(words), odd(bigrams), n_core), 1 / (v_core + 1))
    free_shuffles(chunks.sparkSession)

    def final(c: _Chunk, counts) -> pa.Table:
        word, context, pair = counts("train")
        p2, p1 = _estimates(word, context, pair, n)
        w = weights[bucket(context)]
        p = w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] / (v + 1)
        add = lambda x: np.add.reduceat(x, c.starts)
        m = len(c.roles)
        return pa.table({"doc_id": pa.array(c.doc_ids, pa.int64()), "role": pa.array(c.roles.astype(np.int32)),
                         "n_tokens": pa.array(add(np.ones(len(p), np.int64))), "n_known": pa.array(add((word > 0).astype(np.int64))),
                         "train_tokens": pa.array(np.full(m, n, np.int64)),
                         "base_score": pa.array(add(np.log10((word + 1) / (n + v + 1)))), "score": pa.array(add(np.log10(p)))})

    return _with_counts(chunks, words, bigrams, final, "doc_id long, role int, n_tokens long, n_known long, "
                                                       "train_tokens long, base_score double, score double")
