"""Language identification (operator 8).

Hashed byte 1- to 4-grams of the lower-cased text, weighted by TF-IDF, feed a sparse
multinomial logistic regression. It is trained with follow-the-regularised-leader (per
coordinate rates, elastic-net penalties: L1 zeroes weights, L2 shrinks them), and its
confidence is calibrated by a temperature on a part of the sample that training left out.

Document frequencies cover every training document. The regression itself is fitted on a
bounded sample: about ``SAMPLE_PER_LANG`` documents of each language, chosen by a hash of
id and text, with their whole texts.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; so is everything
when no document has a language to learn. Every row is predicted by its own text, so ties and
repeated rows agree; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_stage, map_arrow, stage, text_slices

UND = "und"
DIMS = 1 << 14
ORDERS = (1, 2, 3, 4)
SAMPLE_PER_LANG = 800
_OTHER = re.compile(rb"[\x00-@\[-`{-\x7f]+")
_FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the text's letters (runs of other ASCII become one space), and counts."""
    b = np.frombuffer(b" " + _OTHER.sub(b" ", text.lower().encode("utf-8", "replace")) + b" ", np.uint8).astype(np.uint32)
    total = np.zeros(DIMS, np.int64)
    for n in ORDERS:
        m = len(b) - n + 1
        if m <= 0:
            break
        h = np.full(m, n, np.uint32)
        for k in range(n):
            h = h * np.uint32(31) + b[k:k + m] * _FACTORS[k]
        h ^= h >> np.uint32(15)
        total += np.bincount((h * np.uint32(0x2C1B3C6D)) >> np.uint32(18), minlength=DIMS)
    some = np.flatnonzero(total)
    return some, total[some]


def tf_idf(grams: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf[grams]
    return x / max(np.sqrt((x * x).sum()), 1e-12)


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # DIMS x langs
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return UND, 0.0
        grams, counts = gram_counts(text)
        z = (tf_idf(grams, counts, self.idf) @ self.weights[grams] + self.bias) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit_ftrl(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_lang: int, alpha: float = 1.0, beta: float = 1.0,
             l1: float = 1e-3, l2: float = 1e-3, epochs: int = 4, batch: int = 16, seed: int = 8):
    """Weights (DIMS x n_lang) and bias by FTRL-proximal over mini-batches of sparse rows."""
    z, n = np.zeros((DIMS + 1, n_lang)), np.zeros((DIMS + 1, n_lang))
    w, rng = np.zeros((DIMS + 1, n_lang)), np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            dense = np.zeros((len(rows), DIMS + 1))
            dense[:, DIMS] = 1
            for i, r in enumerate(rows):
                dense[i, x[r][0]] = x[r][1]
            p = _softmax(dense @ w)
            p[np.arange(len(rows)), y[rows]] -= 1
            g = dense.T @ p
            root = np.sqrt(n + g * g)
            z += g - (root - np.sqrt(n)) / alpha * w
            n += g * g
            w = np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)
    return w[:DIMS], w[DIMS]


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section on its logarithm."""
    def loss(t: float) -> float:
        p = _softmax(logits / np.exp(t))
        return float(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean())

    a, b, g = -4.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def train(docs: DataFrame, keep: Column | None = None, sample_per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Fit on the rows of ``docs`` (where ``keep``) that have a language and a text."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.filter(keep) if keep is not None else known
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros(DIMS), np.zeros((DIMS, 0)), np.zeros(0), 1.0)
    share = {k: min(1.0, sample_per_lang / n) for k, n in sizes.items()}
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id").cast("string"), F.col("text")), F.lit(1 << 30)) / F.lit(1 << 30)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMS, np.int64), 0
        for b in (part for batch in batches for part in text_slices(batch)):
            rows: list[list] = [[], [], [], []]
            for text, lang, u in zip(*(b.column(c).to_pylist() for c in ("text", "lang", "draw"))):
                if not has_letter(text):
                    continue
                grams, counts = gram_counts(text)
                df[grams] += 1
                n += 1
                if u < share[lang]:
                    for c, v in zip(rows, (lang, u, grams.astype("<i4").tobytes(), counts.astype("<i4").tobytes())):
                        c.append(v)
            yield pa.record_batch({"gram": pa.nulls(len(rows[0]), pa.int32()), "df": pa.nulls(len(rows[0]), pa.int64()),
                                   "lang": pa.array(rows[0], pa.string()), "draw": pa.array(rows[1], pa.float64()),
                                   "grams": pa.array(rows[2], pa.binary()), "counts": pa.array(rows[3], pa.binary())})
        some = np.flatnonzero(df)
        grams = np.append(some, -1).astype(np.int32)  # gram -1 counts the documents
        yield pa.record_batch({"gram": pa.array(grams), "df": pa.array(np.append(df[some], n)),
                               "lang": pa.nulls(len(grams), pa.string()), "draw": pa.nulls(len(grams), pa.float64()),
                               "grams": pa.nulls(len(grams), pa.binary()), "counts": pa.nulls(len(grams), pa.binary())})

    counted = stage(map_arrow(known.select("text", "lang", draw.alias("draw")), count,
                              "gram int, df long, lang string, draw double, grams binary, counts binary"), "langid")
    df_rows = counted.filter("gram is not null").groupBy("gram").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(DIMS + 1)
    df[df_rows["gram"].to_numpy()] = df_rows["df"].to_numpy()
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    # the bounded sample, in an order that doesn't depend on the partitioning
    sample = counted.filter("gram is null").orderBy("draw", "lang", "grams").toArrow()
    drop_stage(counted)
    grams = [np.frombuffer(g.as_buffer(), "<i4") for g in sample["grams"]]
    x = [(g, tf_idf(g, np.frombuffer(c.as_buffer(), "<i4"), idf).astype(np.float32)) for g, c in zip(grams, sample["counts"])]
    y = np.array([langs.index(v) for v in sample["lang"].to_pylist()], np.int64)
    if not len(x):
        return Model([], idf, np.zeros((DIMS, 0)), np.zeros(0), 1.0)
    held = np.arange(len(x)) % 5 == 0 if len(x) >= 10 else np.zeros(len(x), bool)
    w, bias = fit_ftrl([x[i] for i in np.flatnonzero(~held)], y[~held], len(langs))
    logits = np.array([x[i][1] @ w[x[i][0]] + bias for i in np.flatnonzero(held)]).reshape(-1, len(langs))
    del sample, grams, x
    pa.default_memory_pool().release_unused()
    return Model(langs, idf, w, bias, fit_temperature(logits, y[held]) if len(logits) else 1.0)


def predict(docs: DataFrame, model: Model, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its calibrated probability appended."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMS x languages, whatever the corpus size
    schema = docs.drop(pred, score).schema.add(pred, "string").add(score, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in (part for batch in batches for part in text_slices(batch)):
            got = [m.predict(t) for t in b.column("text").to_pylist()]
            yield (b.append_column(pred, pa.array([g[0] for g in got], pa.string()))
                   .append_column(score, pa.array([g[1] for g in got], pa.float64())))

    return map_arrow(docs.drop(pred, score), run, schema)
