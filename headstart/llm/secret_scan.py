"""Secret scans (operator 4).

Base kinds are fixed patterns (``assign``, ``access``, ``hex``). On top, candidate strings
are scanned with a window whose Shannon entropy per character class is kept by incremental
counts: moving the window by one changes two counts, and the sum of ``c * log2 c`` is
adjusted by their difference. A candidate is reported from the first to the last window at
or above its class's threshold, unless the allow-list explains it; where a base span covers a
part of it, the parts outside are reported.

Edge cases: null or empty text has no span; texts of any length are scanned whole; every
row (also a repeated one, or one with a null id) gets its own row; an empty table gives an empty
result; other columns, whatever their names, aren't read by ``scan_secrets`` and stay as they are
in ``redact_secrets`` (but for ``n_chars``).
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow, text_slices

KINDS = ("assign", "access", "hex", "entropy")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.I | re.A)
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

WINDOW = 20
#: Character classes, and the entropy in bits that a window of 20 must reach.
CLASSES = (("hex", re.compile(r"[0-9a-fA-F]+\Z"), 3.0), ("alnum", re.compile(r"[A-Za-z0-9]+\Z"), 3.7),
           ("base64", re.compile(r"[A-Za-z0-9+/=_-]+\Z"), 3.9))
#: A part of an entropy span beside a base span is reported from so many characters on.
LEAST_PART = WINDOW // 2
_CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{20,}")
#: Strings that look random and aren't secrets: plain words, numbers, ids with a public form.
ALLOWED = (re.compile(r"[A-Z]?[a-z]+(?:[-_/=+][A-Z]?[a-z]+)*[-_/=+]*\Z"), re.compile(r"[A-Z]+(?:[-_/=+][A-Z]+)*[-_/=+]*\Z"),
           re.compile(r"[0-9+/=_-]+\Z"),
           re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z"),
           re.compile(r"(?:[a-z]+[-_/])+[a-z0-9]{1,8}\Z"))
_CLOG = [0.0] + [c * log2(c) for c in range(1, WINDOW + 1)]


def entropy_span(s: str, least: float, window: int = WINDOW) -> tuple[int, int] | None:
    """First and last position covered by windows of ``s`` with at least ``least`` bits."""
    counts: dict[str, int] = {}
    total, start, end = 0.0, -1, -1
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        total += _CLOG[c + 1] - _CLOG[c]
        counts[ch] = c + 1
        if i >= window:
            old = s[i - window]
            c = counts[old]
            total += _CLOG[c - 1] - _CLOG[c]
            counts[old] = c - 1
        if i >= window - 1 and log2(window) - total / window >= least:
            start = i - window + 1 if start < 0 else start
            end = i + 1
    return None if start < 0 else (start, end)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds, sorted."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS) and (":" in text or "=" in text):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _outside(a: int, b: int, covered: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Parts of ``a..b`` outside the sorted, disjoint ``covered`` stretches."""
    out = []
    for x, y in covered[max(0, bisect_left(covered, (a, a)) - 1):]:
        if x >= b:
            break
        if y > a:
            out.append((a, x))
            a = y
    return [(x, y) for x, y in [*out, (a, b)] if y - x >= LEAST_PART]


def entropy_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of high entropy: what of them stands outside the base spans."""
    covered: list[tuple[int, int]] = []
    for x, _, y in taken:
        if covered and x <= covered[-1][1]:
            covered[-1] = covered[-1][0], max(y, covered[-1][1])
        else:
            covered.append((x, y))
    out = []
    for m in _CANDIDATE.finditer(text):
        s, at = m.group(), m.start()
        if any(p.match(s) for p in ALLOWED):
            continue
        least = next(bits for _, p, bits in CLASSES if p.match(s))
        if found := entropy_span(s, least):
            out += [(a, 3, b) for a, b in _outside(at + found[0], at + found[1], covered)]
    return out


def find_secrets(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans) of a text, each (start, kind number, end) in code points."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, sorted(base + entropy_spans(text, base))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """``text`` with every span, overlapping ones merged, replaced by ``[SECRET]``."""
    if not spans:
        return text
    out, at = [], 0
    for a, _, b in sorted(spans):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id``, the count of each base kind, ``base_sha256`` and ``spans`` of every document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in text_slices(batch)):
            rows = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for text in b.column("text").to_pylist():
                base, spans = find_secrets(text)
                for k, name in enumerate(("n_assign", "n_access", "n_hex")):
                    rows[name].append(sum(x[1] == k for x in base))
                rows["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                rows["spans"].append(_joined(spans))
            yield pa.record_batch({"doc_id": b.column("doc_id")} | rows)

    return map_arrow(docs.select("doc_id", "text"), scan,
                     f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, "
                     "base_sha256 string, spans string")


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced; a present ``n_chars`` follows the text."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in text_slices(batch)):
            texts = [redact(t, find_secrets(t)[1]) for t in b.column("text").to_pylist()]
            b = b.set_column(b.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
            if (i := b.schema.get_field_index("n_chars")) >= 0:
                b = b.set_column(i, "n_chars", pa.array([None if t is None else len(t) for t in texts],
                                                        b.schema.field(i).type))
            yield b

    return map_arrow(docs, apply, docs.schema)
