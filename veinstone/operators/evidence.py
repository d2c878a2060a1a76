"""Evidence rows in long form: pivots, provenance, validation, reasons, calibration, votes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veinstone.functions.science import clamp, jitter
from veinstone.functions.text import blank, filled


def unpivot(rows: DataFrame, ids: list[str], variables: list[str]) -> DataFrame:
    """One row per id and variable: variable_name, normalized_value."""
    return rows.unpivot(ids, [F.col(v).cast("double").alias(v) for v in variables], "variable_name", "normalized_value")


def pivot(rows: DataFrame, variables: list[str], order: str, last: bool = False, key: str = "point_id") -> DataFrame:
    """A row per point with the first (or last) value of each variable by order."""
    pick = F.max_by if last else F.min_by
    chosen = [pick(F.when(F.col("variable_name") == v, F.col("normalized_value")), F.when((F.col("variable_name") == v) & F.col("normalized_value").isNotNull(), F.col(order))).alias(v) for v in variables]
    return rows.groupBy(key).agg(*chosen)


def with_provenance(rows: DataFrame, provenance: DataFrame, key: str = "point_id") -> DataFrame:
    """rows left-joined with one provenance row per key, the least of several; clashing columns get the suffix _prov."""
    clash = {c: f"{c}_prov" for c in provenance.columns if c in rows.columns and c != key}
    rest = [c for c in provenance.columns if c != key]
    one = provenance.groupBy(key).agg(F.min(F.struct(*rest)).alias("_p")).select(key, *[F.col(f"_p.{c}").alias(c) for c in rest])
    return rows.join(one.withColumnsRenamed(clash), key, "left")


def reasons(checks: list[tuple[str, Column]]) -> Column:
    """The codes whose condition holds, distinct and sorted, joined by semicolons."""
    return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(c, F.lit(code)) for code, c in checks])))), ";")


def validate(rows: DataFrame, checks: list[tuple[str, Column]], primary: tuple[str, str], key: str = "point_id") -> DataFrame:
    """rows with reject_reason: the checks' codes, and missing_primary_variables on every row of a point that lacks a primary variable among all its rows."""
    w = Window.partitionBy(key)
    has = [F.max(F.col("variable_name") == v).over(w) for v in primary]
    own = rows.withColumn("_own", reasons(checks)).withColumn("_whole", reduce(lambda a, b: a & b, has))
    return own.withColumn("reject_reason", F.concat_ws(";", F.nullif("_own", F.lit("")), F.when(~F.col("_whole"), "missing_primary_variables"))).drop("_own", "_whole")


def reason_taxonomy(rejected: DataFrame, by: list[str]) -> DataFrame:
    return rejected.where(F.col("reject_reason") != "").select(F.explode(F.split("reject_reason", ";")).alias("reason"), *by).groupBy("reason", *by).agg(F.count(F.lit(1)).alias("n"))


def calibration(points: DataFrame, predicted: str, correct: str, n_bins: int) -> DataFrame:
    """Every equal-width bin with its count, mean prediction, accuracy and share of the calibration error."""
    n_bins = max(2, n_bins)
    spark = points.sparkSession
    at = F.least(F.floor(F.col(predicted) * n_bins), F.lit(n_bins - 1)).cast("int")
    found = points.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(predicted).alias("mean_predicted"), F.avg(F.col(correct).cast("double")).alias("accuracy"))
    every = spark.range(n_bins).select(F.col("id").cast("int").alias("bin")).join(found, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))  # n_bins rows
    return every.withColumn("ece_part", F.when(F.col("n") > 0, F.abs(F.col("accuracy") - F.col("mean_predicted")) * F.col("n") / total).otherwise(0.0))


#: Models that may vote on each point.
MOST_MODELS = 1000


def model_votes(points: DataFrame, models: DataFrame, policy: str = "balanced") -> DataFrame:
    """Each point judged by each model: confidence with a jitter hashed from model, point and policy."""
    names = models.limit(MOST_MODELS + 1).collect()
    if len(names) > MOST_MODELS:
        raise ValueError(f"more than {MOST_MODELS} models would vote on every point")
    crossed = points.join(F.broadcast(points.sparkSession.createDataFrame(names, models.schema)))
    conf = clamp(F.col("confidence") + (jitter(F.col("model_id"), F.col("point_id").cast("string"), F.lit(policy)) * 0.18 - 0.09) + F.when(F.col("rule_valid"), 0.05).otherwise(-0.12), 0.01, 0.99)
    return crossed.withColumn("model_confidence", conf)


def swarm_vote(votes: DataFrame, mode: str, minimum: float, key: str = "point_id") -> DataFrame:
    """Per point: support and acceptance. majority: over half of the votes valid and their mean confident enough; weighted: valid confidence over all votes."""
    valid = F.col("valid")
    agg = votes.groupBy(key).agg(F.count(F.lit(1)).alias("n_votes"), F.count_if(valid).alias("n_valid"), F.coalesce(F.sum(F.when(valid, F.col("confidence"))), F.lit(0.0)).alias("valid_sum"))
    if mode == "majority":
        support = F.when(F.col("n_valid") > 0, F.col("valid_sum") / F.col("n_valid")).otherwise(0.0)
        accepted = (F.col("n_valid") >= F.floor(F.col("n_votes") / 2) + 1) & (F.round(support, 9) >= minimum)
    else:
        support = F.col("valid_sum") / F.col("n_votes")
        accepted = F.round(support, 9) >= minimum
    return agg.select(key, "n_votes", "n_valid", support.alias("support"), accepted.alias("accepted"))


def envelope_vote(tuples: DataFrame, keys: list[Column], n_models: int, minimum: float) -> DataFrame:
    """Groups of equal (rounded) tuples: 0.7 of their mean confidence and 0.3 of the share of distinct models."""
    agg = tuples.groupBy(*keys).agg(F.avg("confidence").alias("mean_confidence"), F.countDistinct("model_id").alias("n_distinct"), F.max("confidence").alias("top_confidence"))
    support = clamp(0.7 * F.col("mean_confidence") + 0.3 * F.col("n_distinct") / n_models)
    return agg.withColumn("support", support).withColumn("accepted", F.round("support", 9) >= minimum)


def reason_mode(rows: DataFrame, by: str, reason: str = "drop_reason") -> DataFrame:
    """The most frequent code of each group; ties go to the first by name."""
    counts = rows.select(by, F.explode(F.split(reason, ";")).alias("code")).where("code <> ''").groupBy(by, "code").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(by).agg(F.min_by("code", F.struct((-F.col("n")).alias("m"), "code")).alias("mode_reason"), F.max("n").alias("n"))


def provenance_rollup(rows: DataFrame, key: str, order: str, first: list[str], confidence: str = "confidence") -> DataFrame:
    """First row by order per key with the mean confidence; point-level from 0.85."""
    picked = [F.min_by(c, order).alias(c) for c in first]
    mean = F.avg(confidence)
    return rows.groupBy(key).agg(*picked, mean.alias("mean_confidence"), F.when(F.round(mean, 9) >= 0.85, "point-level").otherwise("aggregate").alias("provenance_mode"))


def keep_one(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def tiers(rows: DataFrame, minor: list[str], key: str = "point_id", primary: tuple[str, str] = ("x", "y")) -> DataFrame:
    """strict: accepted rows; broad: those and rows rejected for minor reasons alone, of points that are complete in them."""
    own = F.array_except(F.split("reject_reason", ";"), F.array(*[F.lit(m) for m in minor]))
    strict = F.col("reject_reason") == ""
    fine = rows.withColumn("strict", strict).where(strict | (F.size(own) == 0))
    w = Window.partitionBy(key)
    whole = reduce(lambda a, b: a & b, [F.max(F.col("variable_name") == v).over(w) for v in primary])
    return fine.withColumn("broad", whole & filled(F.col("entity"))).withColumn("tier", F.when(F.col("strict"), "strict").when(F.col("broad"), "broad").otherwise("none"))


def non_empty(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, [F.trim(blank(F.col(c))) != "" for c in columns])
