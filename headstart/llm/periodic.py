"""Periodic run detection by seed-and-extend diagonals (operator 11).

A run of a document's words is a stretch with smallest period ``q`` (words ``q`` apart are
equal), of at least ``max(MIN_LENGTH, MIN_EXPONENT * q)`` words, that no neighbouring word
extends. Two equal stretches ``q`` apart are one diagonal of the document against itself.

1. *Index.* Lags come in classes ``[2^t, 2^(t+1))``. A run whose period is in the class holds
   equal words at that lag over at least ``k_t = max(6, 3 * 2^t)`` consecutive places (5 for
   lag 1): the overlap that is guaranteed. So its two ends share a ``k_t``-gram. All k-grams are
   named exactly, a class's from two names of the class before (no hash can join two of them),
   and only those that occur twice in their document are kept: few, in prose.
2. *Enumerate.* Each occurrence is paired with the next one of the same k-gram in the document
   if their lag is in the class. That is enough: ``k_t`` is no less than the lag, so two
   occurrences inside a run are a multiple of its period apart. A document has at most as many
   pairs per class as words, and no group of equal k-grams meets in all pairs.
3. *Extend.* Pairs go by lag and place. The table of the furthest place covered, one entry
   per lag, drops a pair whose place the extension of an earlier one has covered; a pair that
   is left starts a stretch, which ends ``k_t + q`` words behind the last pair it covers.
   A stretch of a class has exactly that smallest period: a smaller one would divide it, and
   the k-gram would have come again sooner.

Everything is one narrow map over slices of documents: no shuffle, no key, no skew; a task
holds one slice, or one document if that is longer.

Edge cases: words are ``[^\\x20\\x09-\\x0D]+``; a null, empty or wordless text has no run, and its
collapsed text is empty; texts of any length are scanned whole; every row (also a repeated one,
or one with a null id) gets its own row; among equal exponents the run that starts first, then
the one of the smallest period, is the strongest; an empty table gives an empty result; other
columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_CLASS, map_arrow

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Words of the documents that are scanned together.
SLICE_WORDS = 200_000


class _Numbers(dict):
    """Numbers of words in the order they first come."""

    def __missing__(self, w: bytes) -> int:
        n = self[w] = len(self)
        return n


def _joined(left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
    """Names of the grams made of ``left`` here and ``right`` ``shift`` places on, from 0; -1
    where either has no name or the gram comes only once."""
    out = np.full(len(left), -1)
    if shift >= len(left):
        return out
    at = np.flatnonzero((left[:-shift] >= 0) & (right[shift:] >= 0))
    if not len(at):
        return out
    key = left[at] * (right.max() + 1) + right[at + shift]
    _, name, n = np.unique(key, return_inverse=True, return_counts=True)
    again = n[name] > 1
    _, dense = np.unique(name[again], return_inverse=True)
    out[at[again]] = dense
    return out


def _seeds(name: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of each occurrence and the next one of the same gram, for lags ``lo <= lag < hi``."""
    at = np.flatnonzero(name >= 0)
    at = at[np.argsort(name[at], kind="stable")]
    lag = np.diff(at)
    ok = (np.diff(name[at]) == 0) & (lag >= lo) & (lag < hi)
    return at[:-1][ok], lag[ok]


def _stretches(place: np.ndarray, lag: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the maximal stretches that the seeds lie on."""
    if not len(place):
        return place, place, place
    order = np.lexsort((place, lag))
    place, lag = place[order], lag[order]
    # covered: the seed one place back on the lag reaches over this one
    fresh = np.flatnonzero(np.append(True, (np.diff(lag) != 0) | (np.diff(place) != 1)))
    last = np.append(fresh[1:], len(place)) - 1
    return place[fresh], place[last] - place[fresh] + k + lag[fresh], lag[fresh]


def runs_of(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of several documents, whose words are numbered on and
    on; by start, then period."""
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    n = int(sizes.sum())
    doc = np.repeat(np.arange(len(docs)), sizes)
    ids = _Numbers()
    word = np.fromiter((ids[w] for d in docs for w in d), np.int64, n)
    _, one = np.unique(doc * (len(ids) + 1) + word, return_inverse=True)
    one = np.where(np.bincount(one, minlength=1)[one] > 1, one, -1) if n else one
    two = _joined(one, one, 1)
    three = _joined(two, one, 2)
    found = [_stretches(*_seeds(_joined(three, two, 3), 1, 2), 5)]
    k, lo, gram = 6, 2, _joined(three, three, 3)
    while (gram >= 0).any():
        found.append(_stretches(*_seeds(gram, lo, 2 * lo), k))
        gram, k, lo = _joined(gram, gram, k), 2 * k, 2 * lo
    start, length, period = (np.concatenate(x) for x in zip(*found))
    ok = length >= np.maximum(MIN_LENGTH, MIN_EXPONENT * period)
    start, length, period = start[ok], length[ok], period[ok]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def dropped_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``n`` words a run holds behind its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return np.cumsum(depth[:-1]) > 0


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exact ``length / period``; ties: the smallest start, then period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _record(run: tuple[int, int, int] | None) -> dict | None:
    return None if run is None else dict(zip(("start", "length", "period"), run))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (by start, then period), ``best`` (the strongest run, null without
    one) and ``collapsed`` (the words that no run repeats, joined by a space) of every document."""

    def scan(ids: pa.Array, words: list[list[bytes]]) -> pa.RecordBatch:
        start, length, period = runs_of(words)
        ends = np.cumsum([len(w) for w in words])
        gone = dropped_words(int(ends[-1]), start, length, period)
        cut = np.searchsorted(start, np.append(0, ends))
        runs, best, text = [], [], []
        for d, w in enumerate(words):
            first, (i, j) = int(ends[d]) - len(w), cut[d:d + 2]
            mine = list(zip((start[i:j] - first).tolist(), length[i:j].tolist(), period[i:j].tolist()))
            if mine:
                left = np.flatnonzero(~gone[first:first + len(w)])
                w = [w[k] for k in left]
            runs.append([_record(r) for r in mine])
            best.append(_record(strongest(mine)))
            text.append(b" ".join(w).decode("utf-8"))
        return pa.record_batch({"doc_id": ids, "n_words": pa.array(np.diff(ends, prepend=0), pa.int64()),
                                "runs": pa.array(runs, pa.list_(_RUN)), "best": pa.array(best, _RUN),
                                "collapsed": pa.array(text, pa.string())})

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, size, lo = [], 0, 0
            for i in range(b.num_rows):
                text = b.column("text")[i].as_py()
                words.append(text.encode("utf-8").split() if text else [])
                size += len(words[-1])
                if size >= SLICE_WORDS or i == b.num_rows - 1:
                    yield scan(b.column("doc_id").slice(lo, i + 1 - lo), words)
                    words, size, lo = [], 0, i + 1

    return map_arrow(docs.select("doc_id", "text"), apply,
                     f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, runs array<{RUN}>, "
                     f"best {RUN}, collapsed string")


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` in which a tenth of the documents end periodically, chosen and shaped by the
    crc32 of the id: the query's test rows. A document without id or words stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("_h"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD_CLASS), F.lit(0))).alias("_w")) \
        .withColumn("_n", F.when(F.col("_w").isNotNull(), F.size("_w")).otherwise(0))
    g = F.expr("_h div 10")
    shaped = chosen.withColumn("_a", F.when(F.col("_n") > 0, g % F.col("_n")).cast("int")) \
        .withColumn("_p", F.expr("cast(1 + (_n - _a) div (3 + (_h div 10) % 8) as int)"))
    # the tail is its first period again and again, cut to the words there were
    tail: Column = F.expr("slice(flatten(array_repeat(slice(_w, _a + 1, _p), cast(ceil((_n - _a) / _p) as int))), 1, _n - _a)")
    words = F.concat(F.slice("_w", F.lit(1), F.col("_a")), tail)
    return shaped.select("doc_id", F.when(F.col("_n") > 0, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))
