"""Token ids of the public tokenizers, with a per-worker cache of repeated pieces.

A text is cut at single spaces between non-space characters. Both vocabularies split there
in any context, so the pieces' ids, concatenated, are the whole text's ids
(``tests/llm/test_tokens_files.py`` compares them). A text with other runs of white space is cut
only where a lone space stands between non-space characters.

All ids come from the tokenizers library. A piece that is a plain word, perhaps with a
punctuation mark behind it and a second word on the next line, goes straight to the
vocabulary's merge model; any other piece goes through the whole tokenizer.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import kept, text_slices

#: Pieces in the young half of the cache; when full it becomes the old half.
CACHE_PIECES = 80_000
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: Outer white space, or two white space characters together: the text needs the careful cut.
_UNSAFE = re.compile(r"\A\s|\s\Z|\s\s|\A\Z")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = rf"^(?P<word>[{_LETTERS}]+)(?P<mark>[.,;:!?]?)(?:\n(?P<word2>[{_LETTERS}]+)(?P<mark2>[.,;:!?]?))?$"


def _bytes(ids: list[int]) -> bytes:
    a = array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


def _strings(a: pa.StringArray) -> list[str]:
    return a.to_numpy(zero_copy_only=False).tolist()


class _Cache:
    """Ids of pieces, computed when first asked for; drops what wasn't asked for in a while."""

    def __init__(self, make: Callable[[list[str]], list[bytes]]):
        self.make, self.young, self.old = make, {}, {}

    def one(self, piece: str) -> bytes:
        got = self.young.get(piece)
        return self.many([piece])[0] if got is None else got

    def many(self, pieces: list[str], often: np.ndarray | None = None) -> list[bytes]:
        """Ids of the pieces; a new one that isn't among the ``often`` (all of them, if not given) isn't kept."""
        out = list(map(self.young.get, pieces))
        late = [k for k, ids in enumerate(out) if ids is None]
        keep, new = [], []
        for k, ids in zip(late, map(self.old.get, [pieces[k] for k in late])):
            out[k] = ids
            (new if ids is None else keep).append(k)
        for k, ids in zip(new, self.make([pieces[k] for k in new])):
            out[k] = ids
        keep += new if often is None else np.asarray(new, np.int64)[often[new]].tolist()
        for k in keep:
            if len(self.young) >= CACHE_PIECES:
                self.old, self.young = self.young, {}
            self.young[pieces[k]] = out[k]
        return out


def _gather(data: np.ndarray, size: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries ``index`` of ``data``, whose entries have the given sizes, and their sizes."""
    at = np.cumsum(size, dtype=np.int64) - size
    n = size[index]
    source = np.repeat(at[index] - np.cumsum(n, dtype=np.int64) + n, n)
    source += np.arange(len(source))
    return data[source], n


#: Stands for the ids of a piece that mustn't be cut out of its text; no ids have this length.
_CARE = b"?"


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # with word ends, the text is lower-cased and its white space dropped; else spaces lead words
        self.word_ends = spec["model"].get("end_of_word_suffix") == "</w>"
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        one = lambda c: byte_level.pre_tokenize_str(c)[0][0]
        letters = [chr(c) for c in range(0x100) if re.fullmatch(rf"[{_LETTERS}]", chr(c))]
        self.bytes_of = str.maketrans({c: one(c.lower() if self.word_ends else c) for c in letters})
        self.space = "" if self.word_ends else one(" ")
        self.word = _Cache(lambda words: self._merge(words, self.space))
        self.line_word = self.word if self.word_ends else _Cache(lambda words: self._merge(words, ""))
        self.whole = _Cache(lambda pieces: [self._ids(p) for p in pieces])
        self.after_space = _Cache(lambda pieces: [_CARE if _UNSAFE.search(p) else self._ids(" " + p) for p in pieces])

    def _merge(self, words: list[str], space: str) -> list[bytes]:
        """Ids of plain words with ``space`` before each."""
        ids, ends, tokenize, bytes_of = [], [0], self.model.tokenize, self.bytes_of
        for w in words:
            ids += [t.id for t in tokenize(space + w.translate(bytes_of))]
            ends.append(4 * len(ids))
        data = _bytes(ids)
        return [data[i:j] for i, j in zip(ends, ends[1:])]

    def _ids(self, text: str) -> bytes:
        return _bytes(self.tok.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str | None) -> bytes:
        """Ids of one text, cut only at lone spaces between non-space characters."""
        if not text:
            return b""
        head, *rest = _BETWEEN.split(text)
        return b"".join([self.whole.one(head), *[self.whole.one(" " + p) for p in rest]])

    def encode_all(self, texts: pa.Array, end_id: int) -> list[bytes]:
        """Ids of every text (a null is empty) with ``end_id`` behind: pieces are looked up once each."""
        if not len(texts):
            return []
        parts = pc.split_pattern(pc.fill_null(texts, ""), " ")
        starts = parts.offsets.to_numpy()
        starts = starts - starts[0]
        pieces = pc.dictionary_encode(parts.flatten())
        index, distinct = pieces.indices.to_numpy().copy(), pieces.dictionary
        heads = _strings(distinct.take(pa.array(index[starts[:-1]])))
        data, size, care = self._distinct(distinct, np.bincount(index, minlength=len(distinct)), heads)
        # a text's first piece has no space before it: an entry of its own
        index[starts[:-1]] = np.arange(len(distinct), len(distinct) + len(heads))
        out, n = _gather(data, size, index)
        out, ends = out.tobytes(), np.cumsum(n, dtype=np.int64)
        before = 4 * np.append(0, ends)[starts]
        careful, end = np.logical_or.reduceat(care[index], starts[:-1]), _bytes([end_id])
        return [(self.encode(texts[k].as_py()) if c else out[a:b]) + end
                for k, (a, b, c) in enumerate(zip(before.tolist(), before[1:].tolist(), careful))]

    def _distinct(self, pieces: pa.StringArray, times: np.ndarray, heads: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces (``times``: how often each stands there) behind a space, then of the heads: all
        ids, how many each, which need care. Words that stand there once are rarely asked for again."""
        plain = pc.extract_regex(pieces, _PLAIN)
        others = np.flatnonzero(np.asarray(plain.is_null()))
        words, words2 = (pc.dictionary_encode(pc.fill_null(pc.struct_field(plain, f), "")) for f in ("word", "word2"))
        marks, marks2 = (pc.dictionary_encode(pc.fill_null(pc.struct_field(plain, f), "")) for f in ("mark", "mark2"))
        line = b"" if self.word_ends else self.whole.one("\n")
        entries, sub = [b""], np.zeros((len(pieces) + len(heads), 5), np.int64)

        def put(column: int, ids: list[bytes], at: np.ndarray, rows=slice(0, len(pieces))) -> None:
            sub[rows, column] = len(entries) + at
            entries.extend(ids)

        often = np.bincount(words.indices.to_numpy(), times, len(words.dictionary)) > 1
        put(0, self.word.many(_strings(words.dictionary), often), words.indices.to_numpy())
        put(1, self.whole.many(_strings(marks.dictionary)), marks.indices.to_numpy())
        second = _strings(words2.dictionary)
        put(2, [line if w else b"" for w in second], words2.indices.to_numpy())
        put(3, self.line_word.many(second), words2.indices.to_numpy())
        put(4, self.whole.many(_strings(marks2.dictionary)), marks2.indices.to_numpy())
        put(0, self.after_space.many(_strings(pieces.take(pa.array(others)))), np.arange(len(others)), others)
        put(0, [_CARE if _UNSAFE.search(h) else self.whole.one(h) for h in heads], np.arange(len(heads)),
            slice(len(pieces), None))
        sub[others, 1:] = 0
        length = np.fromiter(map(len, entries), np.int32, len(entries))
        marked = length == len(_CARE)
        data = np.frombuffer(b"".join(entries), np.uint8)
        if marked.any():  # take the marks out again
            data = data[~np.repeat(marked, length)]
            length[marked] = 0
        out, n = _gather(data.view("<u4"), length >> 2, sub.reshape(-1))
        return out, n.reshape(-1, 5).sum(1), marked[sub[:, 0]]


def encoded(batch: pa.RecordBatch, path: str, end_id: int, slice_bytes: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of ``batch`` of about ``slice_bytes`` of text, each with the ids of its texts."""
    enc = encoder(path)
    for part in text_slices(batch, slice_bytes):
        yield part, enc.encode_all(part.column("text"), end_id)


def encoder(path: str) -> Encoder:
    """The worker's encoder of this vocabulary file."""
    return kept(("encoder", path), lambda: Encoder(path))


def vocabulary(name: str) -> str:
    """Path of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
