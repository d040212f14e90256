"""One owner for each target over a stream of scored pairs: batches are folded into a table of winners."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.decode import exclusive

SCHEMA = "s1_id string, target_id string, prob double"


def fold(winners: DataFrame, batch: DataFrame, threshold: float) -> DataFrame:
    """A better or equally good pair with a smaller query id replaces the winner; so order of arrival does not matter."""
    return exclusive(winners.select("s1_id", "target_id", "prob").unionByName(batch.select("s1_id", "target_id", "prob")), threshold)


def run(stream: DataFrame, folder: str, threshold: float, checkpoint: str, **trigger):
    """Keep winners of a stream (s1_id, target_id, prob) in versions under folder; a batch that is repeated gives the same version."""
    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = spark.read.schema(SCHEMA).parquet(f"{folder}/v{number - 1}") if number else spark.createDataFrame([], SCHEMA)
        fold(old, batch, threshold).write.mode("overwrite").parquet(f"{folder}/v{number}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def latest(spark, folder: str, last_batch: int) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(f"{folder}/v{last_batch}").orderBy(F.col("target_id"))
