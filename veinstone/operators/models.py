"""The tabular head: features, random forest and boosted trees, evaluation and prediction."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinstone.functions.science import clamp


def place(group: Column, seed: int = 0) -> Column:
    """A group's number from 0 to 99, from its MD5, so that any engine finds the same."""
    return (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(group.cast("string"), F.lit(""))).cast("binary")), 1, 8), 16, 10).cast("long") % 100).cast("int")


def split(rows: DataFrame, group: str, share: int = 80, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of their group, so that no group is in both; all rows twice if one side were empty."""
    at = place(F.col(group), seed)
    train, test = rows.where(at < share), rows.where(at >= share)
    return (rows, rows) if train.isEmpty() or test.isEmpty() else (train, test)


def features(numeric: list[str], categorical: list[str]) -> list:
    """Stages that put numbers (null as 0) and one-hot categories (unseen kept apart) in a vector."""
    index = [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep") for c in categorical]
    hot = [OneHotEncoder(inputCols=[f"{c}_index" for c in categorical], outputCols=[f"{c}_hot" for c in categorical])] if categorical else []
    return [*index, *hot, VectorAssembler(inputCols=[*numeric, *[f"{c}_hot" for c in categorical]], outputCol="features", handleInvalid="keep")]


def prepared(rows: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    return rows.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric} | {c: F.coalesce(F.col(c), F.lit("")) for c in categorical})


def train(rows: DataFrame, label: str, quality: str, numeric: list[str], categorical: list[str], trees: int = 20, seed: int = 17) -> PipelineModel:
    """A classifier of label and a regressor of quality over the same features."""
    target = StringIndexer(inputCol=label, outputCol="label_index", handleInvalid="keep")
    forest = RandomForestClassifier(labelCol="label_index", featuresCol="features", numTrees=trees, seed=seed, predictionCol="label_prediction", probabilityCol="label_probability", rawPredictionCol="label_raw")
    boosted = GBTRegressor(labelCol=quality, featuresCol="features", maxIter=10, seed=seed, predictionCol="quality_prediction")
    return Pipeline(stages=[target, *features(numeric, categorical), forest, boosted]).fit(prepared(rows, numeric, categorical))


def predict(model: PipelineModel, rows: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """rows with label, probability of it, quality and uncertainty 1 - (.65 p + .35 q)."""
    labels = F.array(*[F.lit(x) for x in model.stages[0].labels])
    out = model.transform(prepared(rows, numeric, categorical))
    p, q = F.array_max(vector_to_array("label_probability")), clamp(F.col("quality_prediction"))
    return out.withColumns({"predicted_label": F.get(labels, F.col("label_prediction").cast("int")), "phase_prob": p, "quality": q, "uncertainty": clamp(1 - (0.65 * p + 0.35 * q))})


def evaluate(model: PipelineModel, rows: DataFrame, quality: str, numeric: list[str], categorical: list[str]) -> dict[str, float]:
    out = model.transform(prepared(rows, numeric, categorical)).cache()
    f1 = MulticlassClassificationEvaluator(labelCol="label_index", predictionCol="label_prediction", metricName="f1").evaluate(out)
    rmse = RegressionEvaluator(labelCol=quality, predictionCol="quality_prediction", metricName="rmse").evaluate(out)
    out.unpersist()
    return {"f1": f1, "rmse": rmse}


def gate(base: dict[str, float], tuned: dict[str, float], policy: str = "absolute", f1: float = 0.80, uplift: float = 0.05) -> dict[str, bool]:
    """Whether a tuned model passes: by absolute thresholds and uplift, by uplift short of the ceiling, or by not being worse."""
    gain = tuned["f1"] - base["f1"]
    if policy == "non_degradation":
        return {"f1": gain >= 0}
    need = min(uplift, 1 - base["f1"]) if policy == "ceiling_aware" else uplift
    return {"f1": tuned["f1"] >= f1, "uplift": gain >= need}


def neighbour_mean(nodes: DataFrame, edges: DataFrame, value: str) -> DataFrame:
    """One step of message passing: each node's value and the mean of its neighbours'."""
    n = nodes.select("node_id", F.col(value).alias("_v"))
    both = edges.select("source_id", "target_id").union(edges.select("target_id", "source_id"))
    means = both.join(n, both["target_id"] == n["node_id"]).groupBy("source_id").agg(F.avg("_v").alias(f"{value}_neighbours"))
    return nodes.join(means, nodes["node_id"] == means["source_id"], "left").drop("source_id")
