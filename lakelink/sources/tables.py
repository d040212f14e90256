"""Readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = ["entity_id", "business_name", "business_address", "country"]


def read_lenient(spark: SparkSession, path: str, country: str | None = None) -> DataFrame:
    """Tab-separated, no quoting; lines are stripped and missing fields are empty."""
    d = _lines(spark, path).select(F.split(F.regexp_replace("value", r"^\s+|\s+$", ""), "\t").alias("f"))
    d = d.select(*(F.coalesce(F.get("f", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(FIELDS))).filter(F.col("entity_id") != FIELDS[0])
    return d.filter(F.upper(F.trim("country")) == country) if country else d


def read_strict(spark: SparkSession, path: str, country: str | None = None) -> DataFrame:
    """Lines of fewer than four fields are skipped."""
    d = _lines(spark, path).select(F.split(F.regexp_replace("value", "\r$", ""), "\t").alias("f")).filter(F.size("f") >= 4)
    d = d.select(*(F.get("f", F.lit(i)).alias(c) for i, c in enumerate(FIELDS))).filter(F.col("entity_id") != FIELDS[0])
    return d.filter(F.upper(F.trim("country")) == country) if country else d


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).filter("value <> ''")


def read_ordered(spark: SparkSession, path: str, country: str | None = None) -> DataFrame:
    """Queries with their ordinal: the data line's position in the file. Blank ids are skipped but keep their number; another header is an error."""
    first = spark.read.text(path).limit(1).collect()
    head = first[0][0].split("\t")[0].strip() if first else ""
    if head not in ("entity_id", "source1_entity_id"):
        raise ValueError(f"unexpected header {head!r}")
    numbered = spark.read.text(path).rdd.zipWithIndex().map(lambda x: (x[1] - 1, x[0][0]))  # line numbers need the order of splits
    d = spark.createDataFrame(numbered, "ordinal long, value string").filter("ordinal >= 0").select("ordinal", F.split(F.regexp_replace("value", "\r$", ""), "\t").alias("f"))
    d = d.select("ordinal", *(F.coalesce(F.get("f", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(FIELDS))).filter(F.trim("entity_id") != "")
    return d.filter(F.upper(F.trim("country")) == country) if country else d


def read_quoted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, quote='"', escape='"')


def read_truth(spark: SparkSession, path: str, s1: DataFrame | None = None) -> DataFrame:
    """(s1_id, target_ids); queries of s1 that the file lacks get an empty list."""
    d = _lines(spark, path).select(F.split("value", "\t").alias("f")).select(F.trim(F.col("f")[0]).alias("s1_id"), F.filter(F.transform(F.split(F.coalesce(F.get("f", F.lit(1)), F.lit("")), ","), F.trim), lambda x: x != "").alias("target_ids")).filter("s1_id <> 'source1_entity_id'")
    if s1 is None:
        return d
    return s1.select(F.col("entity_id").alias("s1_id")).join(d, "s1_id", "left").withColumn("target_ids", F.coalesce("target_ids", F.array().cast("array<string>")))


def smoke(targets: DataFrame, truth_pairs: DataFrame, most: int = 3000) -> DataFrame:
    """Targets that are matches, or among the file's first lines (ordinal)."""
    hit = targets.join(truth_pairs.select(F.col("target_id").alias("entity_id")).distinct(), "entity_id", "left_semi")
    return hit.unionByName(targets.filter(F.col("ordinal") < most)).distinct()


def write_ids(rows: DataFrame, path: str, column: str = "matched_entity_ids") -> None:
    """Tab-separated (source1_entity_id, ids) with header, in ordinal order over the part files."""
    rows.orderBy("ordinal").select(F.col("s1_id").alias("source1_entity_id"), column).write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="", quote="\u0000")


def write_parts(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").partitionBy("country").parquet(path)


def merge_parts(s1: DataFrame, *parts: DataFrame) -> DataFrame:
    """All parts in the queries' order; a query without a row, or with two, is an error."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    lost = s1.select("s1_id").join(every, "s1_id", "left_anti").limit(5).collect()
    if lost:
        raise ValueError(f"queries without a row: {[r[0] for r in lost]}")
    twice = every.groupBy("s1_id").count().filter("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"queries with several rows: {[r[0] for r in twice]}")
    return s1.select("s1_id", "ordinal").join(every.drop("ordinal"), "s1_id").orderBy("ordinal")


def write_features(df: DataFrame, path: str) -> None:
    """Doubles as floats, zstd."""
    df.select(*(F.col(c).cast("float").alias(c) if t == "double" else F.col(c) for c, t in df.dtypes)).write.mode("overwrite").option("compression", "zstd").parquet(path)
