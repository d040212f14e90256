"""Token dictionaries from matched pairs (a, b: token lists), and their coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _best(counts: DataFrame, least: int, share: float) -> DataFrame:
    """For each left token the commonest right one, ties to the smaller, if frequent and dominant enough."""
    d = counts.groupBy("l").agg(F.sum("c").alias("total"), F.min(F.struct((-F.col("c")).alias("m"), "r")).alias("b"))
    return d.filter((F.col("total") >= least) & (-F.col("b.m") / F.col("total") >= share)).select(F.col("l").alias("token"), F.col("b.r").alias("translation"), (-F.col("b.m")).alias("n"), "total")


def cooccurrence(pairs: DataFrame, least: int = 5, share: float = 0.8) -> DataFrame:
    """Every distinct token of a with every distinct token of b."""
    d = pairs.select(F.explode(F.array_distinct("a")).alias("l"), "b").select("l", F.explode(F.array_distinct("b")).alias("r"))
    return _best(d.groupBy("l", "r").agg(F.count("*").alias("c")), least, share)


def positional(pairs: DataFrame, least: int = 3, share: float = 0.75) -> DataFrame:
    """Tokens at the same place of lists of equal length."""
    d = pairs.filter(F.size("a") == F.size("b")).select(F.explode(F.arrays_zip("a", "b")).alias("z")).select(F.col("z.a").alias("l"), F.col("z.b").alias("r"))
    return _best(d.groupBy("l", "r").agg(F.count("*").alias("c")), least, share)


def coverage(lists: DataFrame, column: Column, dictionary: DataFrame) -> DataFrame:
    """How many token lists a dictionary (token, ...) translates fully, partly or not at all."""
    d = lists.select(F.monotonically_increasing_id().alias("i"), column.alias("t")).filter(F.size("t") > 0).select("i", F.explode("t").alias("token"))
    hit = d.join(dictionary.select("token", F.lit(1).alias("hit")), "token", "left").groupBy("i").agg(F.count("*").alias("n"), F.count("hit").alias("k"))
    kind = F.when(F.col("k") == F.col("n"), "full").when(F.col("k") > 0, "partial").otherwise("none")
    return hit.groupBy(kind.alias("coverage")).agg(F.count("*").alias("n"))


def cross_script(truth_pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """Matched pairs whose target's name holds Indic characters: (a, b) = target's and query's tokens."""
    t = targets.filter("is_indic").select(F.col("entity_id").alias("target_id"), F.col("name_tokens").alias("a"))
    return truth_pairs.join(t, "target_id").join(s1.select(F.col("entity_id").alias("s1_id"), F.col("name_tokens").alias("b")), "s1_id")
