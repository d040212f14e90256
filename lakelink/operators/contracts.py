"""Contract checks: each returns the violations it found, as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METADATA = ["source", "channel_count", "best_rank", "exact_name", "exact_addr", "rare_token", "address_anchor", "tfidf_name_score", "tfidf_addr_score", "number_overlap"]


def rows(df: DataFrame, rules: dict[str, object], key: str) -> DataFrame:
    """(key, rule) for every broken rule."""
    broken = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(name)) for name, c in rules.items())))
    return df.select(F.col(key).cast("string").alias("key"), F.explode(broken).alias("rule"))


def metadata(df: DataFrame, key: str = "target_id") -> DataFrame:
    numbers = ["tfidf_name_score", "tfidf_addr_score", "number_overlap"]
    rules = {"channels": (F.size("channels") < 1) | (F.size(F.array_distinct("channels")) != F.size("channels")), "source": F.coalesce(F.trim("source"), F.lit("")) == "", "best_rank": F.col("best_rank") < 1}
    return rows(df, rules | {c: F.isnan(c) | (F.abs(c) == float("inf")) | F.col(c).isNull() for c in numbers}, key)


def shard_rows(df: DataFrame) -> DataFrame:
    """df: ordinal, s1_id, candidate_ids, prediction_ids."""
    unsorted = lambda c: F.array_sort(F.array_distinct(c)) != F.col(c)
    own = rows(df, {
        "ordinal": F.col("ordinal") < 0, "s1_id": F.trim("s1_id") == "", "candidates_sorted_unique": unsorted("candidate_ids"), "predictions_sorted_unique": unsorted("prediction_ids"),
        "predictions_are_candidates": F.size(F.array_except("prediction_ids", "candidate_ids")) > 0,
    }, "s1_id")
    again = df.groupBy("s1_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("s1_id").alias("key"), F.lit("s1_id_repeats").alias("rule"))
    twice = df.groupBy("ordinal").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("ordinal").cast("string").alias("key"), F.lit("ordinal_repeats").alias("rule"))
    gaps = df.agg(F.min("ordinal").alias("a"), F.max("ordinal").alias("b"), F.countDistinct("ordinal").alias("n")).filter("b - a + 1 <> n").select(F.lit("").alias("key"), F.lit("ordinals_contiguous").alias("rule"))
    return own.unionByName(again).unionByName(twice).unionByName(gaps)


def output(s1: DataFrame, candidates: DataFrame, matches: DataFrame) -> DataFrame:
    """Final files (ordinal, source1_entity_id, ids as text) against the queries in order (ordinal, entity_id)."""
    found = None
    for name, d in (("candidates", candidates), ("matches", matches)):
        ids = F.split("ids", ",", -1)
        bad = rows(d.withColumn("_l", F.when(F.col("ids") == "", F.array().cast("array<string>")).otherwise(ids)), {
            f"{name}_empty_id": F.exists("_l", lambda x: x == ""), f"{name}_padded_id": F.exists("_l", lambda x: x != F.trim(x)), f"{name}_prefix": F.exists("_l", lambda x: ~x.rlike("^S[23]-")),
            f"{name}_sorted_unique": F.array_sort(F.array_distinct("_l")) != F.col("_l"),
        }, "source1_entity_id")
        order = s1.join(d, "ordinal", "full_outer").filter(~F.col("entity_id").eqNullSafe(F.col("source1_entity_id"))).select(F.coalesce("entity_id", "source1_entity_id").alias("key"), F.lit(f"{name}_order").alias("rule"))
        found = bad.unionByName(order) if found is None else found.unionByName(bad).unionByName(order)
    split = lambda d, c: d.select("source1_entity_id", F.explode(F.split("ids", ",")).alias("id")).filter("id <> ''")
    extra = split(matches, "m").join(split(candidates, "c"), ["source1_entity_id", "id"], "left_anti").select(F.col("source1_entity_id").alias("key"), F.lit("matches_are_candidates").alias("rule")).distinct()
    return found.unionByName(extra)


def overlap(*sources: DataFrame, key: str = "entity_id") -> DataFrame:
    """Ids that more than one source holds."""
    every = None
    for k, d in enumerate(sources):
        one = d.select(F.col(key).cast("string").alias("key"), F.lit(k).alias("k"))
        every = one if every is None else every.unionByName(one)
    return every.groupBy("key").agg(F.min("k").alias("a"), F.max("k").alias("b")).filter("a < b").select("key", F.lit("sources_disjoint").alias("rule"))


def rebuilt_metadata(compact: DataFrame, key: str = "target_id") -> DataFrame:
    """Compact rows with channels rebuilt: opaque names, of which only the number counts. A missing column or broken field is an error."""
    lost = [c for c in METADATA if c not in compact.columns]
    if lost:
        raise ValueError(f"metadata lacks {lost}")
    d = compact.withColumn("channels", F.when(F.col("channel_count") > 0, F.transform(F.sequence(F.lit(1), F.greatest("channel_count", F.lit(1))), lambda i: F.concat(F.lit("channel_"), i.cast("string")))).otherwise(F.array().cast("array<string>")))
    require_none(metadata(d, key))
    return d


def feature_columns(df: DataFrame, features: list[str]) -> list[str]:
    """Required columns that df lacks; more are allowed."""
    return [c for c in ["ordinal", "s1_id", "target_id", *features, *METADATA] if c not in df.columns]


def require_none(violations: DataFrame) -> None:
    first = violations.limit(5).collect()
    if first:
        raise ValueError(f"contract broken: {[tuple(r) for r in first]}")
