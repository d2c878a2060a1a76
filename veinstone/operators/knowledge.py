"""Phase events out of validated points, their conditions and outcomes, and benchmark metrics over points."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinstone.functions import science
from veinstone.functions.text import blank, stable_id
from veinstone.operators.validation import CONTEXT_FIELDS, text_of

#: Columns that a point's first row hands on to its event.
HANDED_ON = ("article_key", "provider", "substrate_material", "substrate_orientation", "doping_elements", "alloy_elements", "citation_url", "doi", "locator", "snippet", "mp_status", "mp_interpretation_label")
#: Columns of the view of outcomes.
OUTCOME = ("event_id", "phase_label", "film_quality_score_numeric", "film_quality_label", "method_family", "mp_status", "mp_best_material_id", "mp_interpretation_score", "mp_interpretation_label", "mp_energy_above_hull_min", "citation_url", "doi")


def phase_events(rows: DataFrame, x: str, y: str, order: str) -> DataFrame:
    """One event per point that has both variables: first values, what its first row says, and what that row's snippet tells of time, pressure, strain, vacancies, quality and method."""
    first = lambda c: F.min_by(F.coalesce(F.col(c).cast("string"), F.lit("")), F.col(order)).alias(c) if c in rows.columns else F.lit("").alias(c)
    value = lambda v: F.min_by(F.when(F.col("variable_name") == v, F.col("normalized_value")), F.when(F.col("variable_name") == v, F.col(order)))
    own = rows.groupBy("point_id").agg(value(x).alias("thickness_nm"), value(y).alias("anneal_temperature_c"), first("entity"), F.avg("confidence").alias("film_quality_score_numeric"), *[first(c) for c in (*HANDED_ON, "doping_composition", "alloy_composition")])
    s = F.col("snippet")
    out = own.where("thickness_nm is not null and anneal_temperature_c is not null").withColumns({
        "phase_label": F.col("entity"), "film_material": F.col("entity"), "anneal_time_s": science.seconds_in(s), "pressure_pa": science.pascals_in(s), "strain_pct": science.strain_in(s), "vacancy_concentration_cm3": science.vacancies_in(s),
        "composition_value": science.first_composition(F.col("doping_composition"), F.col("alloy_composition")), "film_quality_label": science.quality_label(s), "method_family": science.method_family(s),
    })
    return out.withColumn("event_id", stable_id(F.col("point_id"), F.col("phase_label"), F.col("thickness_nm"), F.col("anneal_temperature_c"))).drop("entity")


def quality_outcomes(events: DataFrame) -> DataFrame:
    return events.select(*[F.col(c) if c in events.columns else F.lit(None).cast("string").alias(c) for c in OUTCOME])


def context_completeness(points: DataFrame) -> DataFrame:
    """One row: the share of points with all context fields."""
    whole = reduce(lambda a, b: a & b, [text_of(points, c) != "" for c in CONTEXT_FIELDS])
    return points.agg(F.coalesce(F.avg(whole.cast("double")), F.lit(0.0)).alias("context_completeness"))


def context_match(matched: DataFrame) -> DataFrame:
    """matched pairs (fields of the gold row begin with gold_) with the fields that differ; blank if none does."""
    differs = [F.when(F.lower(F.trim(blank(F.col(c)))) != F.lower(F.trim(blank(F.col(f"gold_{c}")))), F.lit(c)) for c in CONTEXT_FIELDS]
    return matched.withColumn("mismatches", F.concat_ws(";", *differs))


def context_scores(predictions: DataFrame, gold: DataFrame, matched: DataFrame) -> DataFrame:
    """One row: precision, recall and F1 of predictions matched one to one with gold rows of equal context. matched: of context_match."""
    one = lambda t, name: t.agg(F.count(F.lit(1)).alias(name))
    n = one(predictions, "n_pred").join(one(gold, "n_gold")).join(matched.agg(F.count_if(F.col("mismatches") == "").alias("tp")))  # a row each
    p, r = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0), F.when(F.col("n_gold") > 0, F.col("tp") / F.col("n_gold")).otherwise(0.0)
    return n.select("tp", p.alias("precision"), r.alias("recall")).withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0))


def context_errors(predictions: DataFrame, matched: DataFrame, key: str) -> DataFrame:
    """(error, n): predictions without a gold row, and matched ones by field that differs."""
    alone = predictions.join(matched.select(key), key, "left_anti").select(F.lit("no_xy_entity_match").alias("error"))
    fields = matched.where("mismatches <> ''").select(F.explode(F.split("mismatches", ";")).alias("error"))
    return alone.union(fields).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


#: Statuses that count as covered by the reference service.
COVERED = ("success", "no_match", "fetch_error", "parse_error", "no_api_key", "disabled")


def reference_metrics(points: DataFrame) -> DataFrame:
    """One row: share of points with a status, and of those whose references support or conflict."""
    label = F.lower(text_of(points, "mp_interpretation_label"))
    share = lambda c: F.coalesce(F.avg(c.cast("double")), F.lit(0.0))
    return points.agg(share(F.lower(text_of(points, "mp_status")).isin(*COVERED)).alias("mp_coverage"), share(label == "supports").alias("mp_support_rate"), share(label == "conflicts").alias("mp_conflict_rate"))


def reference_alignment(points: DataFrame) -> DataFrame:
    """Per entity the share of points whose references support them."""
    e = F.lower(text_of(points, "entity"))
    return points.where(e != "").groupBy(e.alias("entity")).agg(F.avg((F.lower(text_of(points, "mp_interpretation_label")) == "supports").cast("double")).alias("supported"))


def labelled_precision(candidates: DataFrame, key: str) -> DataFrame:
    """One row over (prediction, gold) pairs in tolerance, each prediction with its first gold row: how many have an expected label, and how often `supports` is right. candidates: key, gold_id, mp_interpretation_label, mp_expected_label."""
    first = candidates.groupBy(key).agg(F.min_by(F.struct("mp_interpretation_label", "mp_expected_label"), "gold_id").alias("f"))
    said, want = F.lower(F.trim(blank(F.col("f.mp_interpretation_label")))), F.lower(F.trim(blank(F.col("f.mp_expected_label"))))
    labelled = first.where(want != "")
    hits, all_ = F.count_if((said == "supports") & (want == "supports")), F.count_if(said == "supports")
    return labelled.agg(F.count(F.lit(1)).alias("labeled_rows"), F.when(all_ > 0, hits / all_).otherwise(0.0).alias("mp_support_precision"))


def error_breakdown(predictions: DataFrame, matches: DataFrame, reasons: DataFrame, key: str, entity: str) -> tuple[DataFrame, DataFrame]:
    """(entity, n, precision) of predictions, and (reason, n) of those without a match. matches: key; reasons: key, reason."""
    hit = predictions.select(key, F.lower(F.trim(blank(F.col(entity)))).alias("entity")).join(matches.select(key, F.lit(1).alias("hit")), key, "left")
    per = hit.groupBy("entity").agg(F.count(F.lit(1)).alias("n"), (F.count("hit") / F.count(F.lit(1))).alias("precision"))
    return per, reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def vote_suite(votes: DataFrame) -> DataFrame:
    """One row: votes, the share accepted and the mean support."""
    return votes.agg(F.count(F.lit(1)).alias("vote_rows"), F.coalesce(F.avg(F.col("accepted").cast("double")), F.lit(0.0)).alias("accepted_ratio"), F.coalesce(F.avg("aggregated_support"), F.lit(0.0)).alias("mean_support"))


def phase_suite(events: DataFrame) -> DataFrame:
    """One row: events and distinct phases."""
    return events.agg(F.count(F.lit(1)).alias("phase_event_count"), F.countDistinct("phase_label").alias("phase_diversity"))


def ranked_gain(ranked: DataFrame, rank: str, relevance: str, k: int = 10) -> DataFrame:
    """One row: nDCG of the first k rows by rank, against the best order of those k. Only k rows leave the sort."""
    from pyspark.sql import Window

    top = ranked.orderBy(rank).limit(k)
    w = lambda o: F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(o))  # noqa: E731 - k rows
    gain = lambda i: (F.pow(F.lit(2.0), F.col(relevance)) - 1) / F.log2(F.col(i) + 1)
    both = top.withColumn("_i", w(F.col(rank))).withColumn("_j", w(F.desc(relevance)))
    best = F.sum(gain("_j"))
    return both.agg(F.count(F.lit(1)).alias("ranked_rows"), F.coalesce(F.when(best > 0, F.sum(gain("_i")) / best).otherwise(0.0), F.lit(0.0)).alias("ndcg"))


def projection(docs: int, seconds: float, size: float, target: int = 10_000) -> dict[str, float]:
    """Documents an hour, and hours and gigabytes for `target` documents at that rate; zeros without documents or time."""
    per_hour = docs / seconds * 3600 if docs and seconds > 0 else 0.0
    return {"docs_per_hour": per_hour, "hours": target / per_hour if per_hour else 0.0, "gigabytes": size / docs * target / 1e9 if docs else 0.0}
