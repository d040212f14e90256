"""Set metrics of candidates and predictions. truth: (s1_id, target_ids); others: (s1_id, ids)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.similarity import f_half

EMPTY = "array<string>"


def aligned(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    return truth.join(predicted.select("s1_id", "ids"), "s1_id", "left").withColumn("ids", F.coalesce("ids", F.array().cast(EMPTY)))


def macro_f_half(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    return aligned(truth, predicted).agg(F.round(F.coalesce(F.avg(f_half(F.col("target_ids"), F.col("ids"))), F.lit(0.0)), 9).alias("macro_f05"))


def index_percentile(df: DataFrame, column: str, shares: dict[str, float], keys: list[str] | None = None) -> DataFrame:
    """sorted[min(floor(p n), n - 1)] of a whole-number column, from its histogram: no single task sorts the rows."""
    keys = keys or []
    hist = df.groupBy(*keys, column).agg(F.count("*").alias("c"))
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    upto = hist.withColumn("upto", F.sum("c").over(w.orderBy(column))).withColumn("n", F.sum("c").over(w))
    at = {k: F.least(F.floor(F.lit(p) * F.col("n")), F.col("n") - 1) for k, p in shares.items()}
    return upto.groupBy(*keys).agg(*(F.min(F.when(F.col("upto") > v, F.col(column))).alias(k) for k, v in at.items()))


def blocking_report(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """Recall by source, complete-entity recall, oracle F0.5 and the distribution of candidate counts."""
    d = aligned(truth, candidates).withColumns({"hit": F.array_intersect("target_ids", "ids"), "n_cand": F.size("ids")})
    of = lambda c, s: F.sum(F.size(F.filter(c, lambda x: x.startswith(s))))
    rate = lambda a, b: F.round(F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(1.0)), 9)
    main = d.agg(
        rate(F.sum(F.size("hit")), F.sum(F.size("target_ids"))).alias("pair_recall"), rate(of("hit", "S2"), of("target_ids", "S2")).alias("s2_recall"), rate(of("hit", "S3"), of("target_ids", "S3")).alias("s3_recall"),
        F.round(F.avg((F.size("hit") == F.size("target_ids")).cast("double")), 9).alias("complete_recall"), F.round(F.avg(f_half(F.col("target_ids"), F.col("hit"))), 9).alias("oracle_f05"),
        F.round(F.avg("n_cand"), 9).alias("mean_candidates"), F.max("n_cand").cast("long").alias("max_candidates"), F.sum("n_cand").cast("long").alias("total_candidates"),
    )
    spread = index_percentile(d, "n_cand", {"median_candidates": 0.5, "p95_candidates": 0.95, "p99_candidates": 0.99})
    return main.crossJoin(F.broadcast(spread))  # one row each


def pareto(truth: DataFrame, ranked: DataFrame, budgets: list[int]) -> DataFrame:
    """For each budget K: recall, oracle F0.5 and the linear P95 of candidates of the K best (s1_id, target_id, rank), the gain over the K before, and whether it is the first within 99.5 % of the best."""
    ks = truth.sparkSession.createDataFrame([(k,) for k in budgets], "k int")
    gold = truth.select("s1_id", F.explode("target_ids").alias("target_id")).distinct().withColumn("hit", F.lit(1))
    found = ranked.join(gold, ["s1_id", "target_id"], "left").join(F.broadcast(ks), F.col("rank") <= F.col("k"))
    counts = found.groupBy("k", "s1_id").agg(F.count("*").alias("n_cand"), F.count("hit").alias("tp"))
    n = truth.select("s1_id", F.size("target_ids").alias("n"))
    f = F.when(F.col("n") == 0, 1.0).when(F.col("tp") == 0, 0.0).otherwise(5.0 * F.col("tp") / (4.0 * F.col("tp") + F.col("n")))
    every = n.crossJoin(F.broadcast(ks)).join(counts, ["k", "s1_id"], "left").fillna(0, ["tp", "n_cand"])
    out = every.groupBy("k").agg(
        F.round(F.sum("tp") / F.sum("n"), 9).alias("pair_recall"), F.round(F.avg((F.col("tp") == F.col("n")).cast("double")), 9).alias("complete_recall"), F.round(F.avg(f), 9).alias("oracle_f05"),
        F.round(F.percentile("n_cand", F.lit(0.95)), 9).alias("p95_candidates"),
    )
    w = Window.partitionBy(F.lit(0)).orderBy("k")  # as many rows as budgets
    top = Window.partitionBy(F.lit(0))
    d = out.withColumn("delta", F.round(F.col("oracle_f05") - F.lag("oracle_f05").over(w), 9)).withColumn("_ok", F.col("oracle_f05") >= 0.995 * F.max("oracle_f05").over(top))
    return d.withColumn("recommended", F.col("k") == F.min(F.when(F.col("_ok"), F.col("k"))).over(top)).drop("_ok")
