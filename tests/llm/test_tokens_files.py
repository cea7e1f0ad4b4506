"""Token pieces, packing and id files against the plain tokenizers library."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from headstart.llm import idfile, packing
from headstart.llm import tokens
from headstart.llm.tokens import encoded, encoder, vocabulary

from ..conftest import SF001
from .conftest import TEXTS, rows

HARD = ["", " ", "   ", "a  b", "a   b", "a \n b", "a\n \n b", " lead", "trail ", "it's we'll  don't", "naïve café é ΣΑΣ Σ",
        "tab\t x", "  x  ", "<|endoftext|> x <|endoftext|>", "1 234 5,6", "x\x1c y \x1c z", "  a 　b", "a ́b",
        "日本語 テキスト", "a\r\n b\r\n\r\n  c"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_whole_texts_ids(spark, name):
    tok = Tokenizer.from_file(vocabulary(name))
    docs = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").select("text").collect()]
    rng = random.Random(1)
    alphabet = ["a", "B", "Éß", "word", ",", "?", "it's", "'s", " ", " ", "  ", "\n", "\t", "é", "́", "1", ".", "\x1c", " ", "Σ", "<|endoftext|>"]
    noise = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(3000)]
    texts = docs + HARD + noise
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    enc = encoder(vocabulary(name))
    for t, w in zip(texts, want):
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == w, repr(t)
    for t, got, w in zip(texts, enc.encode_all(pa.array(texts), 7), want):
        assert np.frombuffer(got, "<u4").tolist() == w + [7], repr(t)
    batch = pa.record_batch({"text": pa.array(texts[:50] + [None] + texts[50:99], pa.string())}).slice(1)
    assert [x for _, ids in encoded(batch, vocabulary(name), 7, 5000) for x in ids] == \
        [enc.encode(t) + b"\7\0\0\0" for t in batch["text"].to_pylist()]


def test_cache_turns_over(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 3)
    enc = tokens.Encoder(vocabulary("byte_bpe_50k.json"))
    for t in ["a b c d e f g h, i.\nJ a b", "h, g a zz yy xx"] * 3:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == enc.tok.encode(t, add_special_tokens=False).ids


def test_words_seen_once_leave_the_others_in_the_cache(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 10)
    enc = tokens.Encoder(vocabulary("word_bpe_49k.json"))
    often, once = "go cat dog go cat dog go cat dog", " ".join("x" + "abcdefghij"[k // 10] + "klmnopqrst"[k % 10] for k in range(100))
    made, make = [], enc.word.make
    enc.word.make = lambda words: (made.extend(words), make(words))[1]
    for _ in range(3):
        for t in (often, once):
            assert np.frombuffer(enc.encode_all(pa.array([t]), 7)[0], "<u4").tolist() == enc.tok.encode(t, add_special_tokens=False).ids + [7]
    assert [made.count(w) for w in ("cat", "dog", "xak")] == [1, 1, 3]


def test_plan_places_every_piece_once():
    rng = random.Random(2)
    cases = [[rng.randint(1, 2048) for _ in range(3000)], [683] * 7, [1024] * 7 + [1025], [5] * 1000, [],
             [700, 700, 700, 1300], [1] * 5000 + [2048] * 3 + [800] * 9, [int(rng.lognormvariate(6, 1)) % 2048 + 1 for _ in range(9000)]]
    for sizes in cases:
        p = packing.plan(dict(Counter(sizes)))
        fill, seen = defaultdict(list), Counter()
        for s, r, q, n, o in zip(*(p[k].tolist() for k in ("size", "rank", "seq", "n", "offset"))):
            assert r == seen[s]
            seen[s] += n
            for k in range(n):
                fill[q + k].append((o, s))
        assert seen == Counter(sizes)
        for v in fill.values():
            at = 0
            for o, s in sorted(v):
                assert o == at
                at += s
            assert at <= 2048
        if len(sizes) > 2000 and max(sizes) > 100:
            assert len(fill) <= 1.02 * sum(sizes) / 2048 + 1


def _check_packed(got, texts, end=0):
    tok = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    want = Counter()
    for i, t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [end]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)] if len(ids) > 2048 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for v in seqs.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 2048
    return len(seqs), sum(k[3] * n for k, n in want.items())


def test_pack(spark, edge_docs, no_docs):
    n, total = _check_packed(rows(packing.pack(edge_docs)), [t[:2] for t in TEXTS])
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    n, total = _check_packed(rows(packing.pack(docs.repartition(5))), [(r.doc_id, r.text) for r in docs.collect()])
    assert n <= 1.03 * total / 2048 + 1
    assert packing.pack(no_docs).count() == 0


def test_rank_chunks_of_a_hot_length(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 10)
    docs = spark.createDataFrame([(i, "same text") for i in range(300)] + [(1000 + i, "w " * i) for i in range(50)],
                                 "doc_id long, text string")
    _check_packed(rows(packing.pack(docs)), [(r.doc_id, r.text) for r in docs.collect()])


def test_code_lengths_are_limited_and_optimal():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 50, 3000):
        counts = np.maximum(1, (1e6 / np.arange(1, n + 1) ** 2).astype(np.int64))
        rng.shuffle(counts)
        lengths = idfile.code_lengths(counts)
        assert lengths.max() <= 16 and (n == 1 or np.sum(2.0 ** -lengths) == 1)
    # against unlimited Huffman where the limit doesn't bind
    import heapq
    counts = rng.integers(1, 1000, 60)
    heap, cost = list(map(int, counts)), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        s = heapq.heappop(heap) + heapq.heappop(heap)
        cost += s
        heapq.heappush(heap, s)
    assert int((idfile.code_lengths(counts) * counts).sum()) == cost
    # a binding limit against the best of all length vectors
    from itertools import product
    counts = np.array([1, 1, 2, 4, 8, 16])
    best = min(sum(c * x for c, x in zip(counts, v)) for v in product(range(1, 4), repeat=6) if sum(2.0 ** -x for x in v) <= 1)
    assert int((idfile.code_lengths(counts, 3) * counts).sum()) == best


def test_blocks_round_trip():
    rng = np.random.default_rng(4)
    blocks, arrays = [], []
    base = rng.zipf(1.3, 5000) % 40000
    symbols, counts = np.unique(base, return_counts=True)
    codes = idfile.Codes(symbols, idfile.code_lengths(counts))
    for n in (1, 63, 64, 65, 1000, 5000):
        ids = base[:n]
        marks, payload = idfile.encode_ids(ids, *codes.encoder_tables())
        blocks.append((n, marks, payload))
        arrays.append(ids)
    for got, want in zip(idfile.decode_blocks(blocks, *codes.decoder_tables(), codes.bits), arrays):
        assert np.array_equal(got, want)


def _check_file(got, texts):
    tok = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    ids = {}
    for i, t in texts:
        ids.setdefault(i, []).append(tok.encode(t or "", add_special_tokens=False).ids + [1])
    at, want = 0, Counter()
    for i in sorted(ids, key=lambda x: (x is not None, x)):
        for x in ids[i]:
            want[i, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes())] += 1
            at += len(x)
    assert Counter((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == want


def test_id_file(spark, edge_docs, no_docs):
    _check_file(rows(idfile.encode_and_check(edge_docs)), [t[:2] for t in TEXTS])
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    _check_file(rows(idfile.encode_and_check(docs.repartition(7))), [(r.doc_id, r.text) for r in docs.collect()])
    assert idfile.encode_and_check(no_docs).count() == 0


def test_id_file_keeps_the_ids(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    vocab = vocabulary("word_bpe_49k.json")
    idfile.write_ids(docs, str(tmp_path / "f"), vocab)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in idfile.read_ids(spark, str(tmp_path / "f")).collect()}
    assert got == {1: Tokenizer.from_file(vocab).encode("one two", add_special_tokens=False).ids + [1], 2: [1]}
