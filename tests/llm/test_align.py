"""Cross-tokenizer alignment against whole-text tokenization and a plain count over all links."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headstart.llm import align, queries
from headstart.llm.tokens import vocabulary

from ..conftest import SF01
from .conftest import TEXTS, rows

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
ODD = ["a", " lead", "trail ", "two  spaces", "tab\tand\nlines \n x", "<|endoftext|> is text <s> </s> <0x41>", "naïve café Straße ½ ﬁ",
       "日本 語 テスト", "\U0001f600\U0001f601 smile", "U+2581 ▁ is a space", "▁x", "x\r\ny { }\r", "a　b c d \x1c e", "   ", "\n",
       "0123456789 3.14159 -- !!! ???", "é ́x", "\x00 nul", "word " * 50, "ab" * 300, "don't we'll I'm",
       "Word.\nNext, a: b; c! d? Ünd.\nÖde", "one ▁ bad", "x word y", "word x", "line x", "a\n.b", "Zeile!\nx\ny"]


@pytest.fixture(scope="module")
def tool():
    return align.Aligner(vocabulary(A), vocabulary(B))


def token_bytes_b(piece):
    return bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()


def whole(tool, text):
    """(a ids, b ids, links as id pairs, groups) from the libraries' own whole texts; None without tokens."""
    if not text:
        return None
    a = tool.a.encode(" " + text, add_special_tokens=False).ids
    b = tool.b.encode(text)
    chars = {c: n for n, c in zip([*range(33, 127), *range(161, 173), *range(174, 256)], [*map(chr, range(33, 127)), *map(chr, range(161, 173)), *map(chr, range(174, 256))])}
    rest = [n for n in range(256) if n not in chars.values()]
    chars |= {chr(256 + k): n for k, n in enumerate(rest)}
    la = [bytes(chars[c] for c in tool.a.id_to_token(i)) for i in a]
    lb = [token_bytes_b(tool.b.id_to_piece(i)) for i in b]
    if b"".join(la) != (" " + text).encode() or b"".join(lb) != (" " + text).encode():
        return None
    ea, eb = np.cumsum([len(x) for x in la]).tolist(), np.cumsum([len(x) for x in lb]).tolist()
    sa, sb = [0, *ea[:-1]], [0, *eb[:-1]]
    links, k = [], 0
    for i in range(len(a)):
        while eb[k] <= sa[i]:
            k += 1
        j = k
        while j < len(b) and sb[j] < ea[i]:
            links.append((a[i], b[j]))
            j += 1
    groups, i, j = [], 0, 0
    for end in sorted(set(ea) & set(eb)):
        x, y = ea.index(end, i) + 1, eb.index(end, j) + 1
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        i, j = x, y
    return a, b, links, groups


def brute(tool, docs):
    """The measures of (doc_id, text) rows, in their order."""
    cache = {t: whole(tool, t) for t in {t for _, t in docs}}
    count = Counter()
    for _, t in docs:
        if cache[t]:
            count.update(set(cache[t][2]))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for d, t in docs:
        if not cache[t]:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, groups = cache[t]
        out.append((d, len(a), len(b), len(groups), len(links), sum(count[x] == top[x[0]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_pieces_make_whole_texts(tool):
    counts, groups, owner, codes = tool.align(pa.array(ODD))
    for k, text in enumerate(ODD):
        want = whole(tool, text)
        assert (groups[k] is None) == (want is None), text
        if want:
            assert groups[k].decode() == ";".join(want[3]), text
            assert codes[owner == k].tolist() == [a << align.B_BITS | b for a, b in want[2]], text
            assert counts[k].tolist() == [len(want[0]), len(want[1]), len(want[3]), len(want[2])]
        else:
            assert not counts[k].any()
    assert whole(tool, "▁x") is None and whole(tool, "<|endoftext|>")[0] != [50256]


def test_query_equals_brute_force(spark, tool):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r[c] for c in NAMES) for r in rows(queries.op12_align(spark, SF01)))
    assert got == sorted(brute(tool, docs))
    assert sum(r[4] for r in got) > 100_000


def test_small_chunks_copies_and_edges(spark, tool, edge_docs, no_docs, monkeypatch):
    monkeypatch.setattr(align, "HOT_PART", 4)  # so that the copies are hot
    docs = [(k, t) for k, t in enumerate(ODD)] + [(100 + k, "the same text again") for k in range(40)] + [(None, "a"), (7, ""), (7, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = rows(align.align(df, vocabulary(A), vocabulary(B)).withColumnRenamed("groups", "groups_sha256"))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r[c] for c in NAMES) for r in got), key=key) == sorted(brute(tool, docs), key=key)
    edge = rows(align.align(edge_docs, vocabulary(A), vocabulary(B), digest=False))
    assert len(edge) == len(TEXTS)
    assert {r["doc_id"]: r["n_a"] for r in edge}[2] == 0 and all(r["groups"] == "" for r in edge if not r["n_a"])
    assert next(r for r in edge if r["doc_id"] == 1)["groups"].startswith("383|")
    assert align.align(no_docs, vocabulary(A), vocabulary(B)).count() == 0


def test_chunks_don_t_change_the_result(tool, spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(ODD * 2)], "doc_id long, text string")
    texts = align.aligned(df, vocabulary(A), vocabulary(B)).cache()
    one = {r.pair: r.n for r in align.pair_counts(align.chunk_pairs(texts)).collect()}
    split = texts.withColumn("chunk", F.pmod(F.xxhash64("text_key"), F.lit(7)))
    assert one == {r.pair: r.n for r in align.pair_counts(align.chunk_pairs(split)).collect()}
    assert min(one.values()) >= 2
    texts.unpersist()
