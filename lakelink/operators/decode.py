"""Decisions from scored pairs (s1_id, target_id, prob)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exclusive(scored: DataFrame, threshold: float) -> DataFrame:
    """Each target goes to its most probable query at or above threshold, ties to the smaller query id. Aggregates before it shuffles."""
    best = scored.filter(F.col("prob") >= threshold).groupBy("target_id").agg(F.min(F.struct((-F.col("prob")).alias("p"), "s1_id")).alias("w"))
    return best.select(F.col("w.s1_id").alias("s1_id"), "target_id", (-F.col("w.p")).alias("prob"))


def nonexclusive(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.filter(F.col("prob") >= threshold).select("s1_id", "target_id", "prob")


def complete(s1: DataFrame, links: DataFrame, name: str = "matched_entity_ids") -> DataFrame:
    """Every query once, its target ids sorted and joined by commas; none gives an empty string."""
    ids = links.groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_set(F.col("target_id").cast("string"))), ",").alias("_ids"))
    return s1.join(ids, "s1_id", "left").select(*s1.columns, F.coalesce("_ids", F.lit("")).alias(name))


def sweep(scored: DataFrame, truth: DataFrame, thresholds: list[float]) -> DataFrame:
    """Macro F0.5 of each policy (exclusive or not) and threshold, over the queries of truth (s1_id, target_ids).

    A pair survives threshold h up to its own prob, and is a target's winner for every h: so one aggregate over thresholds serves both policies.
    """
    spark = scored.sparkSession
    h = spark.createDataFrame([(float(x),) for x in thresholds], "threshold double")
    gold = truth.select("s1_id", F.explode("target_ids").alias("target_id")).withColumn("hit", F.lit(1))
    sizes = truth.select("s1_id", F.size("target_ids").alias("n_true"))
    won = exclusive(scored, float("-inf")).select("s1_id", "target_id").withColumn("won", F.lit(True))
    pairs = scored.join(won, ["s1_id", "target_id"], "left").join(gold, ["s1_id", "target_id"], "left").join(sizes.select("s1_id"), "s1_id", "left_semi")
    each = pairs.join(F.broadcast(h), F.col("prob") >= F.col("threshold"))
    policy = each.select("s1_id", "threshold", "hit", F.explode(F.when(F.col("won"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))).alias("exclusive"))
    counts = policy.groupBy("exclusive", "threshold", "s1_id").agg(F.count("*").alias("n"), F.count("hit").alias("tp")).join(sizes, "s1_id")
    f = F.when(F.col("tp") == 0, 0.0).otherwise(5.0 * F.col("tp") / (5.0 * F.col("tp") + 4.0 * (F.col("n") - F.col("tp")) + (F.col("n_true") - F.col("tp"))))
    # queries without predictions score 1 if they have no match: all such, less those that got a prediction
    total = sizes.agg(F.count("*").alias("all"), F.count_if(F.col("n_true") == 0).alias("empty"))
    sums = counts.groupBy("exclusive", "threshold").agg(F.sum(f).alias("s"), F.count_if(F.col("n_true") == 0).alias("spoilt"))
    grid = h.crossJoin(spark.createDataFrame([(True,), (False,)], "exclusive boolean"))  # two policies
    full = grid.join(sums, ["exclusive", "threshold"], "left").crossJoin(F.broadcast(total))
    return full.select("exclusive", "threshold", F.round((F.coalesce("s", F.lit(0.0)) + F.col("empty") - F.coalesce("spoilt", F.lit(0))) / F.col("all"), 9).alias("macro_f05"))


def best_policy(swept: DataFrame) -> DataFrame:
    """The best score; among equals exclusivity first, then the smallest threshold."""
    return swept.agg(F.max(F.struct("macro_f05", "exclusive", (-F.col("threshold")).alias("m"))).alias("b")).select("b.exclusive", (-F.col("b.m")).alias("threshold"), "b.macro_f05")
