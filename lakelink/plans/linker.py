"""The whole linkage. Candidates write intermediate tables when they are called for; the rest is lazy."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import blocking, decode, features, training


def prepare(raw: DataFrame) -> DataFrame:
    """raw: entity_id, source, country, business_name, business_address, and more columns that stay."""
    out = raw.withColumn("country", F.upper(F.trim("country")))
    for step in X.record(F.col("business_name"), F.col("business_address")):
        out = out.withColumns(step)
    return out.drop("addr_digit_words")


@dataclass
class Linker:
    k: int = 15
    budget: int = 25
    percentile: float = 0.8
    threshold: float = 0.45
    exclusive: bool = True

    def candidates(self, s1: DataFrame, targets: DataFrame) -> DataFrame:
        return blocking.balanced(blocking.candidates(s1, targets, self.k, self.percentile), self.budget)

    def features(self, pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
        return features.pair_features(pairs, s1, targets)

    def fit(self, labelled: DataFrame, **params):
        return training.fit(labelled, features.FEATURES, **params)

    def score(self, model, table: DataFrame) -> DataFrame:
        return training.predict(model, table, features.FEATURES).select(F.col("q_id").alias("s1_id"), F.col("t_id").alias("target_id"), "prob")

    def decode(self, scored: DataFrame, s1: DataFrame) -> DataFrame:
        links = (decode.exclusive if self.exclusive else decode.nonexclusive)(scored, self.threshold)
        return decode.complete(s1.select(F.col("entity_id").alias("s1_id")), links)
