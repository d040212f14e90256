"""Profiling aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from .metrics import index_percentile


def empty_rate(records: DataFrame) -> DataFrame:
    return records.groupBy("source", "country").agg(F.count("*").alias("n"), F.count_if("addr_empty").alias("n_empty"), F.round(F.avg(F.col("addr_empty").cast("double")), 9).alias("empty_rate"))


def match_distribution(truth: DataFrame) -> DataFrame:
    """Matches of a query: all, those with any, and by source."""
    of = lambda p: F.size(F.filter("target_ids", lambda x: x.startswith(p)))
    n = F.size("target_ids")
    d = truth.select(F.explode(F.array(F.struct(F.lit("all").alias("kind"), n.alias("m")), F.struct(F.when(n > 0, "nonsingleton").alias("kind"), n.alias("m")), F.struct(F.lit("S2").alias("kind"), of("S2").alias("m")), F.struct(F.lit("S3").alias("kind"), of("S3").alias("m")))).alias("x")).select("x.kind", "x.m").filter("kind is not null")
    main = d.groupBy("kind").agg(F.count("*").alias("n"), F.min("m").cast("long").alias("least"), F.max("m").cast("long").alias("most"), F.round(F.avg("m"), 9).alias("mean"))
    return main.join(index_percentile(d, "m", {"median": 0.5, "p95": 0.95}, ["kind"]), "kind")


def histogram(truth: DataFrame, top: int = 15) -> DataFrame:
    return truth.groupBy(F.size("target_ids").alias("matches")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "matches").limit(top)


def multi_link(pairs: DataFrame) -> DataFrame:
    """Times a target is seen again under another query."""
    return pairs.groupBy("target_id").agg((F.countDistinct("s1_id") - 1).alias("again")).agg(F.count_if(F.col("again") > 0).alias("targets"), F.coalesce(F.sum("again"), F.lit(0)).cast("long").alias("again"))


def coverage_classes(truth: DataFrame) -> DataFrame:
    has = lambda p: F.exists("target_ids", lambda x: x.startswith(p))
    kind = F.when(has("S2") & has("S3"), "both").when(has("S2"), "only_s2").when(has("S3"), "only_s3").otherwise("neither")
    return truth.groupBy(kind.alias("coverage")).agg(F.count("*").alias("n"))


def script_profile(records: DataFrame, text: Column, by: str) -> DataFrame:
    """Records by dominant script, and how many hold any character of each Indic block."""
    counts = {f"any_{k.lower()}": F.count_if(v > 0) for k, v in X.script_counts(text).items()}
    return records.groupBy(by, X.script(text).alias("script")).agg(F.count("*").alias("n"), F.count_if(X.has_indic(text)).alias("n_indic"), *(v.alias(k) for k, v in counts.items()))


def sample_groups(truth: DataFrame, s1: DataFrame, each: dict[str, int]) -> DataFrame:
    """Examples for a report: in each country, queries of the most frequent kinds of size, one of each size, at most each[country]."""
    d = truth.join(s1.select(F.col("entity_id").alias("s1_id"), "country"), "s1_id").withColumn("m", F.size("target_ids")).filter("m > 0")
    one = d.groupBy("country", "m").agg(F.min("s1_id").alias("s1_id"))
    most = F.create_map(*[F.lit(x) for kv in each.items() for x in kv])
    return one.withColumn("n", F.row_number().over(Window.partitionBy("country").orderBy("m"))).filter(F.col("n") <= F.coalesce(most[F.col("country")], F.lit(0))).select("country", "m", "s1_id")


def source_histograms(truth: DataFrame) -> DataFrame:
    """Queries by their number of matches in each source."""
    of = lambda p: F.size(F.filter("target_ids", lambda x: x.startswith(p)))
    d = truth.select(F.explode(F.array(*(F.struct(F.lit(p).alias("source"), of(p).alias("matches")) for p in ("S2", "S3")))).alias("x"))
    return d.groupBy("x.source", "x.matches").agg(F.count("*").alias("n"))


def empty_among_matches(targets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Matched targets and those without an address, by source and country."""
    held = targets.join(pairs.select(F.col("target_id").alias("entity_id")).distinct(), "entity_id", "left_semi")
    return held.groupBy("source", "country").agg(F.count("*").alias("matched"), F.count_if("addr_empty").alias("n_empty"))


def run_summary(lists: DataFrame) -> DataFrame:
    """One row on a run's output (s1_id, ids): queries, those with a match, all matches and the mean of a query."""
    n = F.size("ids")
    return lists.agg(F.count("*").alias("queries"), F.count_if(n > 0).alias("with_match"), F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("matches"), F.round(F.coalesce(F.avg(n), F.lit(0.0)), 9).alias("mean_matches"))
