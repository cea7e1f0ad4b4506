"""Cross-tokenizer alignment (operator 12).

Two tokenizers cut the same bytes (a space, then the text) in different places. Where tokens of
both end, the text falls into groups; tokens whose bytes overlap are linked. How often two ids
are linked over the corpus says which of them stand for each other.

1. *Exact-text deduplication.* Documents are shuffled by their full text and counted, copies
   already before the shuffle; each distinct text is tokenised and aligned once, where the
   shuffle has brought it, and written with its multiplicity (``aligned``).
2. *Pair counts.* Texts come in chunks of about ``CHUNK_LINKS`` links. A chunk sends each of its id
   pairs once, weighted by the copies of the texts that hold it; the sums are the corpus-wide
   document counts, and each id of the first tokenizer gets its highest one (``pair_counts``).
3. *Measures.* The counts go back to the chunks that asked for them and meet the texts there. So
   what is moved grows with the distinct pairs of the chunks, not with the links of all texts.
4. Measures join the documents by the SHA-256 of the text. Texts with more than a thousandth
   of all documents (fewer than a thousand texts, whose list is broadcast) are salted.

Both vocabularies begin a token at a lone space between non-space characters, so a text is the
concatenation of its pieces there; other white space stays inside a piece. A worker asks the
tokenizers once for each distinct unit (a plain word, a mark, any other piece) and aligns whole
slices of texts by arrays (``tests/llm/test_align.py`` compares with the libraries' whole texts).

Edge cases: null and empty texts, and texts whose tokens' joined bytes differ from space+text
(the second vocabulary writes U+2581 for a space) have no tokens: zeros and an empty digest.
Strings of special tokens are plain text. Texts of any length are aligned whole (a chunk holds one
slice of texts at least). Rows that repeat an id or a text, or have a null id, get a row each,
and each counts as a document. An empty table gives an empty result. Of the input only
``doc_id`` and ``text`` are read, whatever other columns there are.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_stage, map_arrow, stage
from .tokens import _BETWEEN, _LETTERS, _PLAIN, _UNSAFE, _gather

#: Links of the texts that exchange pair counts together, about.
CHUNK_LINKS = 4_000_000
#: Bytes of text that are aligned together.
SLICE_BYTES = 2 << 20
#: Units in the young half of a worker's cache; when full it becomes the old half.
CACHE_UNITS = 120_000
#: A longer unit isn't kept in the cache.
CACHED_CHARS = 100
#: Bits of an id of the second tokenizer in a pair's code.
B_BITS = 31 - 16
#: Texts with more than this part of all documents are salted.
HOT_PART = 1000


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token of A, token of B) whose byte ranges overlap, by A, then B; given the tokens' ends."""
    if not len(a_end):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.searchsorted(b_end, np.append(0, a_end[:-1]), side="right")
    last = np.searchsorted(b_end, a_end, side="left")
    n = last - first + 1
    a = np.repeat(np.arange(len(a_end)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


#: (ids of A, ids of B) as packed unsigned 16-bit numbers; None if their tokens give other bytes.
_Unit = tuple[bytes, bytes] | None
_EMPTY: _Unit = (b"", b"")


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(values, dtype=np.int64))[bounds])


class Aligner:
    """Aligns texts under two vocabularies (a ``tokenizers`` file and a ``sentencepiece`` model).

    Units are cached: a plain word behind a space, a mark, a word on a new line, any other piece.
    Neither vocabulary has a token that holds the border of two units of a plain piece.
    """

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        # every byte's letter, read off characters that hold the byte
        letter = {}
        for c in [*map(chr, range(0x800)), *map(chr, range(0x800, 0x10000, 0x1000)), *map(chr, range(0x10000, 0x110000, 0x40000))]:
            if not 0xD800 <= ord(c) < 0xE000:
                letter.update(zip(byte_level.pre_tokenize_str(c)[0][0], c.encode()))
        tokens = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(letter[x] for x in t) if all(x in letter for x in t) else t.encode() for t in tokens]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [self._b_token(p) for p in pieces]
        if len(tokens) > 1 << 16 or len(pieces) > 1 << B_BITS:
            raise ValueError("ids of these vocabularies don't fit a pair's code")
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        #: a token's id and what stands behind it in the groups' text
        self.written = [b"%d%c" % (i, mark) for mark in b",|;" for i in range(1 << 16)]
        border = re.compile(rf"[{_LETTERS}][.,;:!?\n]|[.,;:!?]\n|\n[{_LETTERS}]|[^▁]▁")
        if any(border.search(p) for p, x in zip(pieces, self.b_bytes) if len(x) > 1):
            raise ValueError("a token of the second vocabulary holds the border of two units")
        self.letters = str.maketrans({chr(c): byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(0x100) if re.fullmatch(rf"[{_LETTERS}]", chr(c))})
        self.young: dict[str, _Unit] = {}
        self.old: dict[str, _Unit] = {}

    @staticmethod
    def _b_token(piece: str) -> bytes:
        if m := re.fullmatch(r"<0x([0-9A-F]{2})>", piece):
            return bytes([int(m[1], 16)])
        return piece.replace("▁", " ").encode()

    def units(self, wanted: list[str], kind: str) -> list[_Unit]:
        """Ids of units: ``word`` (letters behind a space), ``line`` (letters or a mark behind what
        isn't a space) or ``piece`` (anything, behind a space)."""
        keys = wanted if kind == "piece" else [kind + " " + w for w in wanted]  # a piece that isn't cut has no such space
        got = [self.young.get(k) for k in keys]
        missing: dict[str, int] = {}
        for n, (k, x) in enumerate(zip(keys, got)):
            if x is None and k not in self.young:
                if k in self.old:
                    got[n] = self.young[k] = self.old[k]
                else:
                    missing.setdefault(k, n)
        if missing:
            made = self._made([wanted[n] for n in missing.values()], kind)
            for k, x in zip(missing, made):
                missing[k] = x
                if len(k) <= CACHED_CHARS:
                    self.young[k] = x
            got = [missing.get(k, x) for k, x in zip(keys, got)]
        if len(self.young) > CACHE_UNITS:
            self.old, self.young = self.young, {}
        return got

    def _made(self, units: list[str], kind: str) -> list[_Unit]:
        ids_b = self.b.encode(units if kind != "line" else ["\n" + u for u in units], num_threads=1)
        if kind == "line":
            ids_b = [b[2:] for b in ids_b]  # the space and the new line, neither of which joins with letters or marks
            ids_a = [e.ids for e in self.a.encode_batch(units, add_special_tokens=False)]
        elif kind == "word":
            merge = self.a.model.tokenize
            ids_a = [[t.id for t in merge("Ġ" + u.translate(self.letters))] for u in units]
        else:
            ids_a = [e.ids for e in self.a.encode_batch([" " + u for u in units], add_special_tokens=False)]
        out = []
        for u, a, b in zip(units, ids_a, ids_b):
            whole = (u if kind == "line" else " " + u).encode()
            same = b"".join([self.a_bytes[i] for i in a]) == whole == b"".join([self.b_bytes[i] for i in b])
            out.append((array("H", a).tobytes(), array("H", b).tobytes()) if same else None)
        return out

    def _pieces(self, distinct: pa.StringArray, skip: np.ndarray) -> tuple[list[_Unit], np.ndarray]:
        """Units, and which five of them make up each distinct piece (none where ``skip``)."""
        plain = pc.extract_regex(distinct, _PLAIN)
        whole = np.flatnonzero(np.asarray(plain.is_null()) & ~skip)
        units: list[_Unit] = [_EMPTY]
        sub = np.zeros((len(distinct), 5), np.int64)

        def put(column: int, made: list[_Unit], at: np.ndarray, rows=slice(None)) -> None:
            sub[rows, column] = len(units) + at
            units.extend(made)

        def some(field: str, kind: str) -> tuple[list[_Unit], np.ndarray, list[str]]:
            d = pc.dictionary_encode(pc.fill_null(pc.struct_field(plain, field), ""))
            words = d.dictionary.to_pylist()
            made = iter(self.units([w for w in words if w], kind))
            return [next(made) if w else _EMPTY for w in words], d.indices.to_numpy(), words

        if len(distinct):
            put(0, *some("word", "word")[:2])
            put(1, *some("mark", "line")[:2])
            made, at, words = some("word2", "line")
            line = self.units(["\n"], "line")[0]
            put(2, [line if w else _EMPTY for w in words], at)
            put(3, made, at)
            put(4, *some("mark2", "line")[:2])
            sub[np.asarray(plain.is_null())] = 0
            put(0, self.units(distinct.take(pa.array(whole)).to_pylist(), "piece"), np.arange(len(whole)), whole)
        return units, sub

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of A, where each text's begin, ids of B, where each text's begin, texts that have tokens)."""
        n = len(texts)
        parts = pc.split_pattern(texts, " ")
        starts = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        flat = pc.dictionary_encode(parts.flatten())
        index, distinct = flat.indices.to_numpy(), flat.dictionary
        unsafe = np.fromiter((bool(_UNSAFE.search(p)) for p in distinct.to_pylist()), bool, len(distinct))
        odd = _sums(unsafe[index], starts) > 0
        # texts with other white space are cut at lone spaces between non-space characters only
        cut = {k: _BETWEEN.split(texts[k].as_py()) for k in np.flatnonzero(odd).tolist()}
        more = {p: len(distinct) + i for i, p in enumerate(dict.fromkeys(p for ps in cut.values() for p in ps))}
        units, sub = self._pieces(distinct, unsafe)
        sub = np.vstack([sub, np.zeros((len(more), 5), np.int64)])
        sub[len(distinct):, 0] = len(units) + np.arange(len(more))
        units += self.units(list(more), "piece")
        bad = np.fromiter((u is None for u in units), bool, len(units))[sub].any(1)
        order = [np.array([more[p] for p in cut[k]]) if k in cut else index[starts[k]:starts[k + 1]] for k in range(n)]
        order = [o if not (bad[o].any()) else None for o in order]
        ok = np.fromiter((o is not None for o in order), bool, n)
        order = [o if o is not None else np.empty(0, np.int64) for o in order]
        bounds = np.cumsum([0, *map(len, order)])
        order = np.concatenate(order) if n else np.empty(0, np.int64)
        out = []
        for side in (0, 1):
            mine = [_EMPTY[side] if u is None else u[side] for u in units]
            size = np.fromiter(map(len, mine), np.int64, len(mine)) >> 1
            ids, k = _gather(np.frombuffer(b"".join(mine), np.uint16), size, sub.reshape(-1))
            ids, k = _gather(ids, k.reshape(-1, 5).sum(1), order)
            out += [ids, np.append(0, np.cumsum(k))[bounds]]
        return (*out, ok)

    def align(self, texts: pa.Array) -> tuple[np.ndarray, list[bytes | None], np.ndarray, np.ndarray]:
        """(texts x counts of tokens of A, of B, groups, links; the groups' text, None without tokens;
        the text of each link; its pair's code) of non-empty texts."""
        a, a_at, b, b_at, ok = self.ids(texts)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        at = np.searchsorted(b_end, a_end)
        a_last = b_end[at] == a_end if len(a) else np.empty(0, bool)
        b_last = np.zeros(len(b), bool)
        b_last[at[a_last]] = True
        i, j = overlaps(a_end, b_end)
        counts = np.stack([np.diff(a_at), np.diff(b_at), _sums(a_last, a_at), np.diff(np.searchsorted(i, a_at))], 1)
        # a group's tokens of A, then its tokens of B
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        a_ends, b_ends = np.append(0, np.flatnonzero(a_last) + 1), np.append(0, np.flatnonzero(b_last) + 1)
        token = np.empty(len(a) + len(b), np.int64)
        token[np.arange(len(a)) + b_ends[a_group]] = a + (a_last.astype(np.int64) << 16)
        token[np.arange(len(b)) + a_ends[b_group + 1]] = b + (b_last.astype(np.int64) << 17)
        written, groups = self.written, []
        for lo, hi, has in zip((a_at + b_at).tolist(), (a_at + b_at)[1:].tolist(), ok.tolist()):
            groups.append(b"".join([written[t] for t in token[lo:hi].tolist()])[:-1] if has else None)
        codes = a[i].astype(np.int64) << B_BITS | b[j]
        return counts, groups, np.repeat(np.arange(len(texts)), counts[:, 3]), codes


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner for these vocabulary files."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


_MEASURED = ("text_key binary, copies long, chunk long, n_a long, n_b long, n_groups long, n_links long, groups string, "
             "pairs binary, times binary")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column("text")).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE_BYTES)))
            yield b.slice(lo, hi - lo)
            lo = hi


def aligned(docs: DataFrame, a_path: str, b_path: str, digest: bool = True) -> DataFrame:
    """Each distinct text aligned once: its key, its ``copies``, its counts, its groups (as
    ``a1,a2|b1;a3|b2,b3``, or the SHA-256 of that) and its distinct pair codes with how often each
    is linked in it, as packed little-endian numbers."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, chunk, links = aligner(a_path, b_path), TaskContext.get().partitionId() << 32, 0
        for b in _slices(batches):
            count, whole, owner, codes = tool.align(b.column("text"))
            groups = ["" if g is None else hashlib.sha256(g).hexdigest() if digest else g.decode() for g in whole]
            key, times = np.unique(owner << 31 | codes, return_counts=True)
            cuts = np.searchsorted(key, np.arange(1, b.num_rows) << 31)
            codes, times = (key & ((1 << 31) - 1)).astype("<u4"), times.astype("<u4")
            pack = lambda x: pa.array([v.tobytes() for v in np.split(x, cuts)], pa.binary())
            yield pa.record_batch({
                "text_key": b.column("text_key"), "copies": b.column("copies"), "chunk": pa.array(np.full(b.num_rows, chunk), pa.int64()),
                **{c: pa.array(count[:, i]) for i, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
                "groups": pa.array(groups, pa.string()), "pairs": pack(codes), "times": pack(times)})
            links += int(count[:, 3].sum())
            if links >= CHUNK_LINKS:
                chunk, links = chunk + 1, 0

    distinct = docs.filter("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    return map_arrow(distinct.select(text_key(F.col("text")).alias("text_key"), "copies", "text"), align, _MEASURED)


def chunk_pairs(texts: DataFrame) -> DataFrame:
    """``chunk, pair, n``: in how many documents of the chunk each of its pairs is linked."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, codes, weights = None, [], []

        def done() -> pa.RecordBatch:
            pair, at = np.unique(np.concatenate(codes), return_inverse=True)
            n = np.zeros(len(pair), np.int64)
            np.add.at(n, at, np.concatenate(weights))
            return pa.record_batch({"chunk": pa.array(np.full(len(pair), now), pa.int64()), "pair": pa.array(pair.astype(np.int32)),
                                    "n": pa.array(n)})

        for b in batches:
            for chunk, copies, pairs in zip(*(b.column(c).to_pylist() for c in ("chunk", "copies", "pairs"))):
                if chunk != now and codes:
                    yield done()
                    codes, weights = [], []
                now = chunk
                codes.append(np.frombuffer(pairs, "<u4"))
                weights.append(np.full(len(codes[-1]), copies))
        if codes:
            yield done()

    return map_arrow(texts.select("chunk", "copies", "pairs"), count, "chunk long, pair int, n long")


def pair_counts(by_chunk: DataFrame) -> DataFrame:
    """``pair, a, b, n, best``: documents in which ``a`` and ``b`` are linked; whether no other id is linked
    with ``a`` in more."""
    summed = by_chunk.groupBy("pair").agg(F.sum("n").alias("n"))
    a, b = F.shiftright("pair", B_BITS), F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))
    # an id of A has as many pairs as B has ids at most
    most = F.max("n").over(Window.partitionBy("a"))
    return summed.select("pair", a.alias("a"), b.alias("b"), "n").withColumn("best", F.col("n") == most)


_MEASURES = "text_key binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def _measure(texts: pa.Table, counts: pa.Table) -> pa.Table:
    """The measures of a chunk's texts from its pairs' corpus-wide counts."""
    pair, n, best = (counts.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pair)
    pair, n, best = pair[order], n[order], best[order].astype(np.int64)
    sums, bests = [], []
    for p, t in zip(texts.column("pairs").to_pylist(), texts.column("times").to_pylist()):
        at, t = np.searchsorted(pair, np.frombuffer(p, "<u4").astype(np.int32)), np.frombuffer(t, "<u4").astype(np.int64)
        sums.append(int((n[at] * t).sum()) if len(t) else 0)
        bests.append(int((best[at] * t).sum()) if len(t) else 0)
    out = texts.select(["text_key", "n_a", "n_b", "n_groups", "n_links"])
    return out.append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64())) \
        .append_column("groups", texts.column("groups"))


def align(docs: DataFrame, a_path: str, b_path: str, digest: bool = True) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` of every document."""
    texts = stage(aligned(docs, a_path, b_path, digest), "aligned")
    by_chunk = stage(chunk_pairs(texts), "aligned-pairs")
    counts = by_chunk.select("chunk", "pair").join(pair_counts(by_chunk).select("pair", "n", "best"), "pair")
    # texts without pairs have chunks too, so the texts' side decides
    measured = stage(texts.drop("copies").groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(_measure, _MEASURES),
                     "aligned-measures")
    total = texts.agg(F.sum("copies").alias("n")).first()["n"] or 0
    hot = texts.filter(F.col("copies") * HOT_PART > total).select(
        "text_key", F.ceil(F.col("copies") * HOT_PART / F.lit(max(total, 1))).cast("int").alias("salts"))
    salted = measured.join(F.broadcast(hot), "text_key", "left") \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key")).join(F.broadcast(hot), "text_key", "left") \
        .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"), F.lit(0))).drop("salts")
    found = keyed.join(salted, ["text_key", "salt"], "left")
    numbers = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    drop_stage(by_chunk)
    return found.select("doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers], F.coalesce("groups", F.lit("")).alias("groups"))
