"""Token-id files with canonical length-limited Huffman codes (operator 3).

File format, a folder with two Parquet tables:

* ``codebook``: ``symbol, length``; codes are canonical (by length, then symbol), at most
  ``MAX_BITS`` long, built by package-merge from the ids' counts over all documents;
* ``blocks``: ``shard, first, doc_ids, lengths, n_ids, marks, payload``. A shard holds a range
  of doc ids, shards ascend. A block holds whole documents and decodes by itself: ``first`` is
  the position of its first id in the corpus, ``marks`` the bits that each run of ``RUN`` ids
  takes (little-endian unsigned 16-bit), whose sums are the bit offsets at which decoding can
  start; ``payload`` the codes, most significant bit first.

Decoding looks up the next ``MAX_BITS`` bits in a table of (symbol, length), for all runs of
a batch side by side.

Edge cases: a null or empty text is the end id alone; null doc ids come first; repeated rows
are documents of their own; a document of any length stays whole in one block; an empty
table gives an empty file and an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import scratch_path
from .common import drop_stage, map_arrow, shuffle_partitions, stage
from .tokens import encoded, vocabulary

MAX_BITS = 16
RUN = 64
BLOCK_IDS = 1 << 15
END_ID = 1


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for positive ``counts`` (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols don't fit into codes of {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    lists, packages = [], np.empty(0)
    for _ in range(max_bits):
        both = np.concatenate([leaves, packages])
        at = np.argsort(both, kind="stable")
        lists.append(at < n)
        both = both[at]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(1)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(lists):
        k = int(is_leaf[:take].sum())
        lengths[:k] += 1
        take = 2 * (take - k)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Codes:
    """Canonical codes of the symbols with the given lengths."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((symbols, lengths))
        self.symbols, self.lengths = symbols[order].astype(np.int64), lengths[order].astype(np.int64)
        self.bits = max(MAX_BITS, int(self.lengths.max(initial=1)))
        # a code is the sum of the shares 2**-length of those before it
        share = np.int64(1) << (self.bits - self.lengths)
        self.starts = np.cumsum(share) - share

    def encoder_tables(self) -> tuple[np.ndarray, np.ndarray]:
        top = int(self.symbols.max(initial=0)) + 1
        code, length = np.zeros(top, np.uint64), np.zeros(top, np.int64)
        code[self.symbols] = (self.starts >> (self.bits - self.lengths)).astype(np.uint64)
        length[self.symbols] = self.lengths
        return code, length

    def decoder_tables(self) -> tuple[np.ndarray, np.ndarray]:
        share = np.int64(1) << (self.bits - self.lengths)
        pad = (1 << self.bits) - int(share.sum())
        sym = np.concatenate([np.repeat(self.symbols, share), np.zeros(pad, np.int64)])
        return sym.astype(np.uint32), np.concatenate([np.repeat(self.lengths, share), np.ones(pad, np.int64)])


def encode_ids(ids: np.ndarray, code: np.ndarray, length: np.ndarray) -> tuple[bytes, bytes]:
    """(marks, payload) of the ids."""
    bits = length[ids]
    ends = np.cumsum(bits)
    starts = ends - bits
    marks = np.add.reduceat(bits, np.arange(0, len(ids), RUN)).astype("<u2").tobytes()
    word = starts >> 5
    window = code[ids] << (64 - (starts & 31) - bits).astype(np.uint64)
    at = np.flatnonzero(np.diff(word, prepend=-1))  # codes that begin in the same word add up
    sums = np.add.reduceat(window, at)
    out = np.zeros(int(word[-1]) + 2, np.uint64)
    out[word[at]] += sums >> np.uint64(32)
    out[word[at] + 1] += sums & np.uint64(0xFFFFFFFF)
    return marks, out.astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8]


def decode_blocks(blocks: list[tuple[int, bytes, bytes]], symbol: np.ndarray, length: np.ndarray,
                  bits: int = MAX_BITS) -> list[np.ndarray]:
    """The ids of (n_ids, marks, payload) blocks: one table lookup per id and step, all runs at once."""
    if not blocks:
        return []
    data = np.frombuffer(b"".join(p for _, _, p in blocks) + bytes(8), np.uint8).astype(np.uint64)
    wide = (data[:-4] << np.uint64(32)) | (data[1:-3] << np.uint64(24)) | (data[2:-2] << np.uint64(16)) \
        | (data[3:-1] << np.uint64(8)) | data[4:]
    bases = np.cumsum([0] + [len(p) for _, _, p in blocks])[:-1] * 8
    marks = [np.frombuffer(m, "<u2").astype(np.int64) for _, m, _ in blocks]
    pos = np.concatenate([b + np.cumsum(m) - m for b, m in zip(bases, marks)])
    left = np.concatenate([np.minimum(RUN, n - RUN * np.arange(len(m))) for (n, _, _), m in zip(blocks, marks)])
    out = np.zeros((len(pos), RUN), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for k in range(RUN):
        lanes = slice(None) if k < left.min() else np.flatnonzero(left > k)
        p = pos[lanes]
        win = ((wide[p >> 3] >> (40 - bits - (p & 7)).astype(np.uint64)) & mask).astype(np.int64)
        out[lanes, k] = symbol[win]
        pos[lanes] = p + length[win]
    flat = out.reshape(-1)
    ends = np.cumsum([0] + [len(m) * RUN for m in marks])
    return [flat[a:a + n] for a, (n, _, _) in zip(ends, blocks)]


def _ids_below(vocab: str, end_id: int) -> int:
    """A number that all ids are below."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(vocab).get_vocab_size(), end_id + 1)


def _tokenized(docs: DataFrame, vocab: str, end_id: int, kind: str) -> DataFrame:
    """``counts, shard, doc_id, at, n, ids``: documents in id order, ``at`` the ids before it in its shard.

    Behind its documents a shard has a row (``counts`` true) with how often it has each id.
    """
    size = _ids_below(vocab, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard, total = 0, TaskContext.get().partitionId(), np.zeros(size, np.int64)
        for b, texts in (x for batch in batches for x in encoded(batch, vocab, end_id)):
            flat = np.frombuffer(b"".join(texts), "<u4")
            total += np.bincount(flat, minlength=size)
            n = np.fromiter(map(len, texts), np.int64, len(texts)) // 4
            ends = np.cumsum(n)
            packed = flat.astype(kind).tobytes()
            width = np.dtype(kind).itemsize
            bounds = (width * np.append(0, ends)).tolist()
            yield pa.record_batch({"counts": pa.array(np.zeros(len(n), bool)), "shard": pa.array(np.full(len(n), shard, np.int32)),
                                   "doc_id": b.column("doc_id"), "at": pa.array(at + ends - n), "n": pa.array(n),
                                   "ids": pa.array([packed[i:j] for i, j in zip(bounds, bounds[1:])], pa.binary())})
            at += int(ends[-1]) if len(ends) else 0
        if at:
            yield pa.record_batch({"counts": pa.array([True]), "shard": pa.array([shard], pa.int32()),
                                   "doc_id": pa.nulls(1, id_type), "at": pa.nulls(1, pa.int64()), "n": pa.nulls(1, pa.int64()),
                                   "ids": pa.array([total.tobytes()], pa.binary())})

    spark, doc_id = docs.sparkSession, docs.schema["doc_id"].dataType
    id_type = to_arrow_type(doc_id)
    ordered = (docs.select("doc_id", "text").repartitionByRange(shuffle_partitions(spark), "doc_id")
               .sortWithinPartitions("doc_id"))
    return map_arrow(ordered, run, f"counts boolean, shard int, doc_id {doc_id.simpleString()}, at long, n long, ids binary")


def _counts(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and their counts over all documents: at most the vocabulary's size."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                total = np.sum([np.frombuffer(x, np.int64) for x in b.column("ids").to_pylist()], axis=0)
                some = np.flatnonzero(total)
                yield pa.record_batch({"symbol": pa.array(some), "n": pa.array(total[some])})

    rows = (map_arrow(tokens.filter("counts").select("ids"), unpack, "symbol long, n long").groupBy("symbol")
            .agg(F.sum("n").alias("n")).orderBy("symbol").toArrow())
    return rows["symbol"].to_numpy(), rows["n"].to_numpy()


def write_ids(docs: DataFrame, path: str, vocab: str, end_id: int = END_ID) -> None:
    """Tokenize ``docs``, append ``end_id`` to each, and write the id file at ``path``."""
    spark = docs.sparkSession
    kind = "<u2" if _ids_below(vocab, end_id) <= 1 << 16 else "<u4"
    tokens = stage(_tokenized(docs, vocab, end_id, kind), "idfile-tokens")
    symbols, counts = _counts(tokens)
    tokens, scratch = tokens.filter("not counts").drop("counts"), tokens
    lengths = code_lengths(counts, max(MAX_BITS, int(len(counts) - 1).bit_length() if len(counts) else 0))
    spark.createDataFrame([(int(s), int(n)) for s, n in zip(symbols, lengths)], "symbol long, length int") \
        .coalesce(1).write.parquet(f"{path}/codebook")
    tables = spark.sparkContext.broadcast(Codes(symbols, lengths).encoder_tables())  # bounded by the vocabulary

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, length = tables.value
        for b in batches:
            shard, first, n = (b.column(c).to_numpy() for c in ("shard", "first", "n"))
            blobs, ids = b.column("ids"), b.column("doc_id").to_pylist()
            lo, rows = 0, []
            while lo < len(n):
                hi, size = lo + 1, int(n[lo])
                while hi < len(n) and size < BLOCK_IDS and first[hi] == first[hi - 1] + n[hi - 1] \
                        and shard[hi] == shard[lo]:
                    size += int(n[hi])
                    hi += 1
                marks, payload = encode_ids(np.frombuffer(b"".join(blobs.slice(lo, hi - lo).to_pylist()), kind),
                                            code, length)
                rows.append({"shard": int(shard[lo]), "first": int(first[lo]), "doc_ids": ids[lo:hi],
                             "lengths": n[lo:hi].tolist(), "n_ids": size, "marks": marks, "payload": payload})
                lo = hi
            yield pa.RecordBatch.from_pylist(rows, schema)

    doc_id = docs.schema["doc_id"].dataType
    id_type = to_arrow_type(doc_id)
    schema = pa.schema([("shard", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(id_type)),
                        ("lengths", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("marks", pa.binary()),
                        ("payload", pa.binary())])
    sums = tokens.groupBy("shard").agg(F.sum("n").alias("n"))
    # one row per shard; shards are as many as the session's shuffle partitions
    before = sums.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    placed = tokens.join(F.broadcast(before), "shard").withColumn("first", F.col("at") + F.col("before"))
    map_arrow(placed.select("shard", "doc_id", "first", "n", "ids"), encode,
              f"shard int, first long, doc_ids array<{doc_id.simpleString()}>, lengths array<bigint>, n_ids long, "
              "marks binary, payload binary").write.option("compression", "none").parquet(f"{path}/blocks")
    drop_stage(scratch)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` (little-endian unsigned 32-bit) of every document in the file at ``path``."""
    return _decoded(spark, path, "ids binary", lambda ids: pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the file at ``path``."""
    return _decoded(spark, path, "ids_crc32 long",
                    lambda ids: pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()))


def _decoded(spark: SparkSession, path: str, last: str, column) -> DataFrame:
    book = spark.read.parquet(f"{path}/codebook").orderBy("symbol").toArrow()
    codes = Codes(book["symbol"].to_numpy(), book["length"].to_numpy())
    tables, bits = spark.sparkContext.broadcast(codes.decoder_tables()), codes.bits
    blocks = spark.read.parquet(f"{path}/blocks")
    kind, name = blocks.schema["doc_ids"].dataType.elementType.simpleString(), last.split()[0]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol, length = tables.value
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                b = batch.slice(at, 32)
                blobs = list(zip(*(b.column(c).to_pylist() for c in ("n_ids", "marks", "payload"))))
                docs, starts, ids = b.column("doc_ids").flatten(), [], []
                for x, first, n in zip(decode_blocks(blobs, symbol, length, bits), b.column("first").to_pylist(),
                                       b.column("lengths").to_pylist()):
                    ends = np.cumsum(n)
                    starts.append(first + ends - n)
                    ids += np.split(x, ends[:-1])
                starts = np.concatenate(starts)
                yield pa.record_batch({"doc_id": docs, "start": pa.array(starts), "n_tokens":
                                       pa.array([len(x) for x in ids], pa.int64()), name: column(ids)})

    return map_arrow(blocks.select("doc_ids", "first", "lengths", "n_ids", "marks", "payload"), decode,
                     f"doc_id {kind}, start long, n_tokens long, {last}")


def encode_and_check(docs: DataFrame, vocab: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the id file of ``docs`` to a scratch folder and return what is read back from it."""
    spark = docs.sparkSession
    path = scratch_path(spark, "idfile")
    write_ids(docs, path, vocab or vocabulary("word_bpe_49k.json"), end_id)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return read_digests(spark, path)
