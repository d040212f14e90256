"""The queries of this subpackage, op1_ to op10_, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import balltree, katz, licenses, linededup, lz, minhash, mixing, ppm, secrets, spm

#: Where the public vocabulary lies; a parameter, as the files are not part of this repository.
PIECES = os.environ.get("LAKELINK_SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket(n: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n, F.lit(0))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = ppm.train(docs.filter(bucket(4) != 2))
    return ppm.identify(docs.select("doc_id", "text", (bucket(4) == 2).alias("held_out")), model).drop("text")


def op2_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz.with_next(table(spark, sf_dir, "documents"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op5_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_texts(table(spark, sf_dir, "documents"), bucket(10) == 0)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), PIECES).drop("text")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def as_files(docs: DataFrame) -> DataFrame:
    """Documents as files: source/<thousands>/<hundreds>/<id>.txt, where each hundred's first is the licence file of its directory."""
    i = F.col("doc_id")
    place = F.concat_ws("/", "source", F.floor(i / 1000).cast("string"), F.floor(i / 100 % 10).cast("string"))
    return docs.select("doc_id", F.concat(place, F.when(i % 100 == 0, "/LICENSE").otherwise(F.concat(F.lit("/"), i.cast("string"), F.lit(".txt")))).alias("path"), "text")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(as_files(table(spark, sf_dir, "documents")), "doc_id")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language, op2_lz_fingerprint, op3_minhash, op4_mixing, op5_katz, op6_sentencepiece, op7_line_dedup, op8_licenses, op9_secrets, op10_top_k)}


def oracle_sql() -> dict[str, str]:
    return {"op10_top_k": OP10_SQL}
