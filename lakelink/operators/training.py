"""Training pairs, splits, the classifier and its persistence."""

from __future__ import annotations

import json

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def training_pairs(candidates: DataFrame, truth_pairs: DataFrame, negatives: int = 8) -> DataFrame:
    """candidates (s1_id, target_id, rank) with label: retrieved matches, and the first `negatives` non-matches of each query by rank."""
    d = candidates.join(truth_pairs.select("s1_id", "target_id").distinct().withColumn("label", F.lit(1)), ["s1_id", "target_id"], "left").fillna(0, ["label"])
    w = Window.partitionBy("s1_id", "label").orderBy("rank", "target_id")
    return d.withColumn("n", F.row_number().over(w)).filter((F.col("label") == 1) | (F.col("n") <= negatives)).drop("n")


def split_share(key: Column) -> Column:
    """A number from 0 to 99 by the key's MD5: the same in every engine and run."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") % 100).cast("int")


def fit(pairs: DataFrame, features: list[str], label: str = "label", *, trees: int = 600, rate: float = 0.05, depth: int = 8, least: int = 50, validation: Column | None = None, seed: int = 42):
    d = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="keep").transform(pairs)
    if validation is not None:
        d = d.withColumn("_validation", validation)
    model = GBTClassifier(featuresCol="_x", labelCol=label, maxIter=trees, stepSize=rate, maxDepth=depth, minInstancesPerNode=least, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed)
    return (model.setValidationIndicatorCol("_validation") if validation is not None else model).fit(d)


def predict(model, pairs: DataFrame, features: list[str]) -> DataFrame:
    """pairs with prob. The ordered features must be present and as many as the model's."""
    missing = [f for f in features if f not in pairs.columns]
    if missing or len(features) != model.numFeatures:
        raise ValueError(f"features do not fit the model: {len(features)} given, {model.numFeatures} wanted, missing {missing}")
    d = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="keep").transform(pairs)
    return model.transform(d).withColumn("prob", vector_to_array("probability")[1]).drop("_x", "rawPrediction", "probability", "prediction")


def importance(model, features: list[str], top: int = 15) -> list[tuple[str, float]]:
    return sorted(zip(features, model.featureImportances.toArray().tolist()), key=lambda x: (-x[1], x[0]))[:top]


def save(model, features: list[str], path: str, spark) -> None:
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(features),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/features")


def load(path: str, spark):
    from pyspark.ml.classification import GBTClassificationModel

    return GBTClassificationModel.load(f"{path}/model"), json.loads(spark.read.text(f"{path}/features").first()[0])
