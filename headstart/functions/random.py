"""Reproducible "random" columns from hashes of (seed, id, ...): order keys and dropout masks.

Same seed ⇒ same value on any partitioning, after any retry, and in any engine with
``md5`` (DuckDB gives identical hex text), so the results are checkable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def order_key(id_col, seed: int) -> Column:
    """Hex text ``md5('<seed>:<id>')``; sorting by it is a seeded shuffle (O1)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _col(id_col).cast("string")))



# Fixed values of the mask hash: the 32-bit integer mixer
# x -> ((x >> 16) ^ x) * 0x45d9f3b mod 2^32, twice, then (x >> 16) ^ x.
MIX_MUL = 0x45D9F3B
MASK32 = 0xFFFFFFFF


def _let(x: Column, f) -> Column:
    """``f(x)`` with ``x`` evaluated once (a one-element lambda), so nesting stays linear."""
    return F.element_at(F.transform(F.array(x), f), 1)


def mix32(x: Column) -> Column:
    """32-bit integer mixing hash on a non-negative bigint below 2^32 (products stay < 2^59)."""
    def step(v):
        return (F.shiftright(v, 16).bitwiseXOR(v) * F.lit(MIX_MUL)).bitwiseAND(F.lit(MASK32))

    return _let(_let(_let(x, step), step), lambda v: F.shiftright(v, 16).bitwiseXOR(v))


def row_hash(id_col, seed: int, step: int | Column) -> Column:
    """Per-row part of the mask hash: mixes seed, step and the 64-bit id."""
    step_c = step if isinstance(step, Column) else F.lit(step)
    ident = _col(id_col).cast("bigint")
    h = mix32(F.pmod(F.lit(seed).cast("bigint") * F.lit(65537) + step_c.cast("bigint"), F.lit(1 << 32)))
    h = mix32(h.bitwiseXOR(ident.bitwiseAND(F.lit(MASK32))))
    return mix32(h.bitwiseXOR(F.shiftright(ident, 32).bitwiseAND(F.lit(MASK32))))


def dropout_keep(id_col, i, keep_prob: float, seed: int, step: int | Column) -> Column:
    """Keep flag of feature ``i`` of row ``id``: ``mix32(row_hash ^ i) < keep_prob · 2^32``."""
    h = mix32(row_hash(id_col, seed, step).bitwiseXOR(_col(i).cast("bigint")))
    return h < F.lit(int(keep_prob * TWO_32))


def dropout_mask(id_col, width: int, keep_prob: float, seed: int, step: int | Column) -> Column:
    """``array<boolean>`` of keep flags for features ``0 .. width-1``."""
    thr = F.lit(int(keep_prob * TWO_32))
    return _let(row_hash(id_col, seed, step), lambda rh: F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)), lambda i: mix32(rh.bitwiseXOR(i.cast("bigint"))) < thr))


# ---- the same hash in numpy (used inside training tasks) -----------------------------

def mix32_np(x):
    import numpy as np

    x = np.asarray(x, dtype=np.uint64)
    m, mask = np.uint64(MIX_MUL), np.uint64(MASK32)
    for _ in range(2):
        x = (((x >> np.uint64(16)) ^ x) * m) & mask
    return (x >> np.uint64(16)) ^ x


def dropout_mask_np(ids, width: int, keep_prob: float, seed: int, step: int):
    """Boolean keep mask (rows × width) equal to :func:`dropout_mask` row by row."""
    import numpy as np

    ident = np.asarray(ids, dtype=np.int64).astype(np.uint64)
    base = np.uint64((seed * 65537 + step) % (1 << 32))
    h = mix32_np(np.full(len(ident), base, dtype=np.uint64))
    h = mix32_np(h ^ (ident & np.uint64(MASK32)))
    h = mix32_np(h ^ ((ident >> np.uint64(32)) & np.uint64(MASK32)))
    full = mix32_np(h[:, None] ^ np.arange(width, dtype=np.uint64)[None, :])
    return full < np.uint64(int(keep_prob * TWO_32))
