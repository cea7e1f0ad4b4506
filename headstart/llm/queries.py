"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, ann, idfile, langid, licenses, lm_score, mixing, near_dedup, packing, periodic, pii, secret_scan, topk
from .common import fold_of
from .tokens import vocabulary


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfile.encode_and_check(_table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_table(spark, sf_dir, "documents"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fold = fold_of(F.col("doc_id"), 5)
    model = langid.train(docs, fold != 0)
    return langid.predict(docs.select("doc_id", (fold == 0).alias("held_out"), "text"), model).drop("text")


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("key")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fold = fold_of(F.col("doc_id"), 7)
    role = F.when(fold == 2, lm_score.TEST).when(fold == 0, lm_score.HELD).otherwise(lm_score.CORE)
    scored = lm_score.score(docs, role)
    return scored.withColumn("held_out", F.col("role") == lm_score.TEST).drop("role")


def periodic_digest(found: DataFrame) -> DataFrame:
    """Counts and digests of ``periodic_runs``."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.with_periodic_tails(_table(spark, sf_dir, "documents"))
    return periodic_digest(periodic.periodic_runs(docs))


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return align.align(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")).withColumnRenamed("groups", "groups_sha256")


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents")).drop("spans")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_near_dedup, op2_pack, op3_huffman_ids, op4_secrets, op5_ann, op6_topk, op7_pii, op8_langid, op9_mix, op10_lm_score,
                              op11_periodic, op12_align, op13_licenses)}

_INT = ("SELECT vec_id, CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS w, "
        "unnest(range(len(embedding))) AS i FROM embeddings")

#: Sources in code point order, weights 1, 2, 3; the sources that stop at three times their
#: size are those with the smallest size for their weight, as many as the shared rest asks for.
_MIX = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('9:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
      FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY 3.0 * size / weight, source NULLS LAST) AS n,
             3.0 * size / weight AS stop, sum(size) OVER () AS total FROM s WHERE size > 0),
u AS (SELECT *, (total - coalesce(sum(3 * size) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unit FROM r),
f AS (SELECT min(n) AS first_open FROM u WHERE stop >= unit),
t AS (SELECT source, size AS source_size, CAST(CASE WHEN n < first_open THEN 3.0 * size
             ELSE (SELECT x.unit FROM u x, f WHERE x.n = f.first_open) * weight END AS DOUBLE) AS target FROM u, f),
p AS (SELECT d.doc_id, d.size, s.size AS source_size, coalesce(t.target, 0.0) AS target,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN s ON s.source IS NOT DISTINCT FROM d.source LEFT JOIN t ON t.source IS NOT DISTINCT FROM d.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, CAST(round(target) AS BIGINT) - epochs * source_size - before)) AS BIGINT) AS taken FROM e
"""

ORACLES: dict[str, str] = {
    "op6_topk": (
        "SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM (SELECT *, "
        "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM ("
        "SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score "
        f"FROM ({_INT}) q JOIN ({_INT}) c ON c.i = q.i AND c.vec_id <> q.vec_id "
        "WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, c.vec_id)) WHERE n <= 5"),
    "op9_mix": _MIX,
}
