"""Queries over evidence: consensus, pivots, validation, votes. Points are line items: x quantity, y price, entity return flag, context line status, confidence 1 - discount."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinstone.operators import consensus, evidence

KEY = "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice::decimal(18,2))"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def point_key():
    return F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").cast("decimal(18,2)"))


def lines(spark, sf_dir):
    return read(spark, sf_dir, "lineitem")


def points(spark, sf_dir):
    return lines(spark, sf_dir).select(point_key().alias("point_id"), F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"), F.col("l_returnflag").alias("entity"), (1 - F.col("l_discount")).alias("confidence"), F.col("l_linestatus").alias("context"))


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def consensus_bins(spark, sf_dir):
    return rounded(consensus.bins(points(spark, sf_dir)), {"weight": 4, "entropy": 6, "consensus_y": 3, "consensus_y_std": 3})


BINS_SQL = """
with p as (select round_even(l_quantity, 3) as x_bin, l_linestatus as context, l_returnflag as entity, 1 - l_discount as c, l_extendedprice as y from lineitem),
e as (select x_bin, context, entity, sum(c) as w, sum(c * y) / sum(c) as my, stddev_pop(y) as sy, count(*) as n from p group by all),
t as (select *, sum(w) over (partition by x_bin, context) as tw from e)
select x_bin, context, sum(n)::bigint as support_count, round(sum(w), 4) as weight, round(greatest(sum(-(w / tw) * log2(w / tw)), 0), 6) as entropy,
  arg_min(entity, row(-w, entity)) as consensus_entity, round(arg_min(my, row(-w, entity)), 3) as consensus_y, round(arg_min(sy, row(-w, entity)), 3) as consensus_y_std, false as low_support
from t group by x_bin, context"""


def scored_points(spark, sf_dir):
    p = points(spark, sf_dir).withColumn("mp_score", F.col("x") % 10 / 10).withColumn("mp_conflict", F.col("mp_score") < 0.25)
    return consensus.mad_outliers(p, "y", ["entity"], 1.5)


def consensus_points(spark, sf_dir):
    out = consensus.points(scored_points(spark, sf_dir), min_support=3)
    return rounded(out.select("point_id", "x_bin", "consensus_entity", "entropy", "consensus_y", "is_outlier", "model_confidence", "display_alpha"), {"entropy": 6, "consensus_y": 3, "model_confidence": 6})


POINTS_SQL = f"""
with m as (select {KEY} as point_id, round_even(l_quantity, 3) as x_bin, l_linestatus as context, l_returnflag as entity, 1 - l_discount as c, l_extendedprice as y, l_quantity % 10 / 10 as mp, median(l_extendedprice) over (partition by l_returnflag) as med from lineitem),
d as (select *, 0.6745 * abs(y - med) / median(abs(y - med)) over (partition by entity) > 1.5 as out from (select *, abs(y - med) as dev from m)),
e as (select x_bin, context, entity, sum(c) as w, sum(c * y) / sum(c) as my, count(*) as n from m group by all),
t as (select *, sum(w) over (partition by x_bin, context) as tw from e),
b as (select x_bin, context, sum(n) as support, greatest(sum(-(w / tw) * log2(w / tw)), 0) as entropy, arg_min(entity, row(-w, entity)) as best, arg_min(my, row(-w, entity)) as cy from t group by x_bin, context),
a as (select *, case when out then 0.15 when entity = best then 0.9 else 0.35 end as alpha from d join b using (x_bin, context))
select point_id, x_bin, best as consensus_entity, round(entropy, 6) as entropy, round(cy, 3) as consensus_y, out as is_outlier,
  round(least(greatest(c / (1 + entropy) * case when support < 3 then 0.85 else 1 end * (0.90 + 0.20 * mp), 0), 1), 6) as model_confidence,
  case when mp < 0.25 and not out then least(alpha, 0.20) else alpha end::double as display_alpha from a"""


def outlier_mad(spark, sf_dir):
    p = consensus.mad_outliers(points(spark, sf_dir), "y", ["entity", "context"], 1.2)
    return p.groupBy("entity", "context").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_outlier").alias("n_outliers"), F.round(F.max(F.when(~F.col("is_outlier"), F.col("y"))), 2).alias("top_inlier"))


OUTLIER_SQL = """
with m as (select l_returnflag as entity, l_linestatus as context, l_extendedprice as y, median(l_extendedprice) over (partition by l_returnflag, l_linestatus) as med, count(*) over (partition by l_returnflag, l_linestatus) as g from lineitem),
d as (select *, median(abs(y - med)) over (partition by entity, context) as mad from m),
o as (select *, g >= 5 and mad > 0 and 0.6745 * abs(y - med) / mad > 1.2 as out from d)
select entity, context, count(*) as n, count(*) filter (out) as n_outliers, round(max(y) filter (not out), 2) as top_inlier from o group by all"""


def consensus_summary(spark, sf_dir):
    p = points(spark, sf_dir).withColumns({"mp_score": F.lit(0.5), "mp_conflict": F.col("confidence") < 0.93, "is_outlier": F.col("y") > 90000})
    return rounded(consensus.summary(consensus.points(p)), {"mean_entropy": 6, "mean_model_confidence": 6, "conflict_rate": 6})


SUMMARY_SQL = f"""
with b as ({BINS_SQL}),
raw as (select round_even(l_quantity, 3) as x_bin, l_linestatus as context, l_returnflag as entity, 1 - l_discount as c, l_extendedprice as y from lineitem),
ent as (select x_bin, context, entity, sum(c) as w from raw group by all),
h as (select x_bin, context, greatest(sum(-(w / tw) * log2(w / tw)), 0) as entropy from (select *, sum(w) over (partition by x_bin, context) as tw from ent) group by all),
j as (select raw.*, h.entropy, b.consensus_entity from raw join h using (x_bin, context) join b using (x_bin, context))
select count(*) as n_points, count(distinct entity) as n_entities, count(*) filter (y > 90000) as n_outliers, round(avg(entropy), 6) as mean_entropy,
  round(avg(least(greatest(c / (1 + entropy) * (0.90 + 0.20 * 0.5), 0), 1)), 6) as mean_model_confidence, round(avg((c < 0.93)::int), 6) as conflict_rate, count(*) filter (entity = consensus_entity) as n_agreeing from j"""


def consensus_curve(spark, sf_dir):
    return consensus.curve(points(spark, sf_dir), "x", "confidence", [F.asc("point_id")]).select("x", "point_id", "y", F.round("confidence", 6).alias("confidence"))


CURVE_SQL = f"""select x, point_id, y, round(confidence, 6) as confidence from (select l_quantity as x, {KEY} as point_id, l_extendedprice as y, 1 - l_discount as confidence,
  row_number() over (partition by l_quantity order by 1 - l_discount desc, {KEY}) as rn from lineitem) where rn = 1"""


def long_rows(spark, sf_dir):
    base = lines(spark, sf_dir).select(point_key().alias("ord"), F.col("l_orderkey").alias("point_id"), "l_quantity", "l_extendedprice", "l_tax")
    return evidence.unpivot(base, ["point_id", "ord"], ["l_quantity", "l_extendedprice", "l_tax"])


def eav_unpivot(spark, sf_dir):
    return long_rows(spark, sf_dir).groupBy("variable_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("normalized_value"), 2).alias("total"), F.min("normalized_value").alias("low"), F.max("normalized_value").alias("high"))


UNPIVOT_SQL = """with u as (unpivot (select l_quantity, l_extendedprice, l_tax from lineitem) on l_quantity, l_extendedprice, l_tax into name variable_name value v)
select variable_name, count(*) as n, round(sum(v), 2) as total, min(v) as low, max(v) as high from u group by 1"""


def eav_pivot_first(spark, sf_dir):
    return evidence.pivot(long_rows(spark, sf_dir), ["l_quantity", "l_extendedprice", "l_tax"], "ord")


def eav_pivot_last(spark, sf_dir):
    return evidence.pivot(long_rows(spark, sf_dir), ["l_quantity", "l_extendedprice", "l_tax"], "ord", last=True)


def pivot_sql(pick: str) -> str:
    return f"with l as (select *, {KEY} as ord from lineitem) select l_orderkey as point_id, " + ", ".join(f"{pick}({c}, ord) as {c}" for c in ("l_quantity", "l_extendedprice", "l_tax")) + " from l group by 1"


def observed(spark, sf_dir):
    """Events as evidence rows: the user as point, the type as variable."""
    return read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("point_id"), "event_id", F.col("event_type").alias("variable_name"), F.col("value").alias("normalized_value"))


def point_completeness(spark, sf_dir):
    rows = observed(spark, sf_dir)
    out = evidence.validate(rows, [("out_of_range", F.col("normalized_value") > 50)], ("click", "purchase"))
    return out.select("event_id", "point_id", "variable_name", "reject_reason")


COMPLETENESS_SQL = """
with r as (select *, bool_or(event_type = 'click') over (partition by user_id) and bool_or(event_type = 'purchase') over (partition by user_id) as whole from events)
select event_id, user_id::varchar as point_id, event_type as variable_name,
  concat_ws(';', case when value > 50 then 'out_of_range' end, case when not whole then 'missing_primary_variables' end) as reject_reason from r"""


def checked(spark, sf_dir):
    """Line items left-joined with orders as provenance, and the codes of all checks."""
    rows = lines(spark, sf_dir).select(point_key().alias("ord"), F.col("l_orderkey").cast("string").alias("point_id"), F.when(F.col("l_linenumber") % 2 == 0, "x").otherwise("y").alias("variable_name"), F.col("l_quantity").alias("normalized_value"), F.col("l_returnflag").alias("entity"), (1 - F.col("l_discount")).alias("confidence"), F.col("l_linestatus").alias("extraction_type"))
    prov = read(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").cast("string").alias("point_id"), F.col("o_orderpriority").alias("locator"), F.col("o_totalprice").alias("confidence"))
    joined = evidence.with_provenance(rows, prov)
    limit = F.when(F.col("extraction_type") == "F", 0.95).otherwise(0.92)
    checks = [
        ("out_of_range", ~F.col("normalized_value").between(3, 45)),
        ("low_confidence", F.round("confidence", 6) < limit),
        ("missing_locator", ~evidence.non_empty("locator")),
        ("unknown_entity", ~F.col("entity").isin("A", "R")),
    ]
    return evidence.validate(joined, checks, ("x", "y"))


CHECKED_SQL = f"""
with rows as (select {KEY} as ord, l_orderkey::varchar as point_id, case when l_linenumber % 2 = 0 then 'x' else 'y' end as variable_name, l_quantity as v, l_returnflag as entity, 1 - l_discount as c, l_linestatus as t from lineitem),
j as (select rows.*, o_orderpriority as locator, bool_or(variable_name = 'x') over (partition by point_id) and bool_or(variable_name = 'y') over (partition by point_id) as whole
  from rows left join (select o_orderkey::varchar as k, o_orderpriority from orders where o_orderstatus <> 'P') o on o.k = point_id),
v as (select *, array_to_string(list_sort(list_filter([case when v not between 3 and 45 then 'out_of_range' end, case when round(c, 6) < case when t = 'F' then 0.95 else 0.92 end then 'low_confidence' end,
  case when coalesce(locator, '') = '' then 'missing_locator' end, case when entity not in ('A', 'R') then 'unknown_entity' end], lambda x: x is not null)), ';') as own from j),
checked as (select *, concat_ws(';', nullif(own, ''), case when not whole then 'missing_primary_variables' end) as reject_reason from v)"""


def validate_reasons(spark, sf_dir):
    return checked(spark, sf_dir).select("ord", "point_id", "variable_name", "reject_reason")


def accept_reject(spark, sf_dir):
    return checked(spark, sf_dir).groupBy("extraction_type").agg(F.count_if(F.col("reject_reason") == "").alias("n_accepted"), F.count_if(F.col("reject_reason") != "").alias("n_rejected"))


def reason_taxonomy(spark, sf_dir):
    return evidence.reason_taxonomy(checked(spark, sf_dir), ["extraction_type"])


def tiers_broad(spark, sf_dir):
    return evidence.tiers(checked(spark, sf_dir), ["missing_locator", "unknown_entity"]).groupBy("tier", "variable_name").agg(F.count(F.lit(1)).alias("n"), F.count_if("broad").alias("n_broad"))


def calibration_ece(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    p = docs.join(labels, "doc_id").select(F.least(F.lit(1.0), F.col("n_chars") / 5000).alias("p"), (F.col("quality") == 1).alias("ok"))
    return rounded(evidence.calibration(p, "p", "ok", 10), {"mean_predicted": 6, "accuracy": 6, "ece_part": 6})


CALIBRATION_SQL = """
with p as (select least(1.0, n_chars / 5000) as p, quality = 1 as ok from documents join labels using (doc_id)),
b as (select least(floor(p * 10)::int, 9) as bin, count(*) as n, avg(p) as mp, avg(ok::int) as acc from p group by 1)
select r.bin::int as bin, coalesce(n, 0) as n, round(mp, 6) as mean_predicted, round(acc, 6) as accuracy, round(coalesce(abs(acc - mp) * n / (select count(*) from p), 0), 6) as ece_part
from range(10) r(bin) left join b on b.bin = r.bin"""


def votes(spark, sf_dir):
    return lines(spark, sf_dir).select(F.col("l_partkey").alias("point_id"), F.col("l_suppkey").alias("model_id"), (1 - F.col("l_discount")).alias("confidence"), (F.col("l_returnflag") != "N").alias("valid"))


def swarm_vote_majority(spark, sf_dir):
    return rounded(evidence.swarm_vote(votes(spark, sf_dir), "majority", 0.94), {"support": 6})


def swarm_vote_weighted(spark, sf_dir):
    return rounded(evidence.swarm_vote(votes(spark, sf_dir), "weighted", 0.6), {"support": 6})


VOTES = "with v as (select l_partkey as point_id, 1 - l_discount as c, l_returnflag <> 'N' as valid from lineitem), a as (select point_id, count(*) as n_votes, count(*) filter (valid) as n_valid, coalesce(sum(c) filter (valid), 0) as s from v group by 1)"
MAJORITY_SQL = f"{VOTES} select point_id, n_votes, n_valid, round(case when n_valid > 0 then s / n_valid else 0 end, 6) as support, n_valid >= n_votes // 2 + 1 and round(case when n_valid > 0 then s / n_valid else 0 end, 9) >= 0.94 as accepted from a"
WEIGHTED_SQL = f"{VOTES} select point_id, n_votes, n_valid, round(s / n_votes, 6) as support, round(s / n_votes, 9) >= 0.6 as accepted from a"


def envelope_vote(spark, sf_dir):
    t = lines(spark, sf_dir).select("l_returnflag", "l_quantity", "l_tax", F.pmod("l_suppkey", F.lit(5)).alias("model_id"), (1 - F.col("l_discount")).alias("confidence"))
    keys = [F.lower("l_returnflag").alias("entity"), F.round("l_quantity", 4).alias("x"), F.round("l_tax", 4).alias("y")]
    out = evidence.envelope_vote(t, keys, 5, 0.93)
    # a hair off exact halves, which the engines round differently
    return rounded(out.withColumns({c: F.col(c) + 1e-9 for c in ("mean_confidence", "support")}), {"mean_confidence": 6, "top_confidence": 6, "support": 6})


ENVELOPE_SQL = """
with g as (select lower(l_returnflag) as entity, round(l_quantity, 4) as x, round(l_tax, 4) as y, avg(1 - l_discount) as m, count(distinct l_suppkey % 5) as d, max(1 - l_discount) as top from lineitem group by all)
select entity, x, y, round(m + 1e-9, 6) as mean_confidence, d as n_distinct, round(top, 6) as top_confidence, round(least(greatest(0.7 * m + 0.3 * d / 5, 0), 1) + 1e-9, 6) as support, round(least(0.7 * m + 0.3 * d / 5, 1), 9) >= 0.93 as accepted from g"""


def drop_reason_mode(spark, sf_dir):
    return evidence.reason_mode(checked(spark, sf_dir).withColumnRenamed("reject_reason", "drop_reason"), "entity")


def model_vote_jitter(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("point_id"), F.lit(0.8).alias("confidence"), (F.col("p_size") > 10).alias("rule_valid"))
    models = spark.createDataFrame([("a",), ("b",), ("c",)], "model_id string")
    return rounded(evidence.model_votes(parts, models), {"model_confidence": 6})


JITTER_SQL = """select p_partkey as point_id, 0.8::double as confidence, p_size > 10 as rule_valid, m as model_id,
  round(least(greatest(0.8::double + ((('0x' || substr(sha1(m || '|' || p_partkey || '|balanced'), 1, 6))::bigint / 16777215.0::double) * 0.18 - 0.09) + case when p_size > 10 then 0.05 else -0.12 end, 0.01), 0.99), 6) as model_confidence
from part, (values ('a'), ('b'), ('c')) t(m)"""


def provenance_rollup(spark, sf_dir):
    rows = lines(spark, sf_dir).select(point_key().alias("ord"), "l_orderkey", "l_partkey", "l_linestatus", (1 - F.col("l_discount") * 2).alias("confidence"))
    return rounded(evidence.provenance_rollup(rows, "l_orderkey", "ord", ["l_partkey", "l_linestatus"]), {"mean_confidence": 6})


ROLLUP_SQL = f"""with r as (select *, {KEY} as ord, 1 - l_discount * 2 as c from lineitem)
select l_orderkey, arg_min(l_partkey, ord) as l_partkey, arg_min(l_linestatus, ord) as l_linestatus, round(avg(c), 6) as mean_confidence, case when round(avg(c), 9) >= 0.85 then 'point-level' else 'aggregate' end as provenance_mode from r group by 1"""

REGISTRY = {
    "consensus_bins": (consensus_bins, BINS_SQL),
    "consensus_points": (consensus_points, POINTS_SQL),
    "consensus_summary": (consensus_summary, SUMMARY_SQL),
    "consensus_curve": (consensus_curve, CURVE_SQL),
    "outlier_mad": (outlier_mad, OUTLIER_SQL),
    "eav_unpivot": (eav_unpivot, UNPIVOT_SQL),
    "eav_pivot_first": (eav_pivot_first, pivot_sql("arg_min")),
    "eav_pivot_last": (eav_pivot_last, pivot_sql("arg_max")),
    "point_completeness": (point_completeness, COMPLETENESS_SQL),
    "validate_reasons": (validate_reasons, CHECKED_SQL + " select ord, point_id, variable_name, reject_reason from checked"),
    "accept_reject": (accept_reject, CHECKED_SQL + " select t as extraction_type, count(*) filter (reject_reason = '') as n_accepted, count(*) filter (reject_reason <> '') as n_rejected from checked group by 1"),
    "reason_taxonomy": (reason_taxonomy, CHECKED_SQL + ", e as (select t, unnest(string_split(reject_reason, ';')) as reason from checked where reject_reason <> '') select reason, t as extraction_type, count(*) as n from e group by all"),
    "tiers_broad": (tiers_broad, CHECKED_SQL + """, f as (select *, reject_reason = '' as strict from checked where len(list_filter(string_split(reject_reason, ';'), lambda x: x not in ('missing_locator', 'unknown_entity', ''))) = 0),
        b as (select *, bool_or(variable_name = 'x') over (partition by point_id) and bool_or(variable_name = 'y') over (partition by point_id) and entity <> '' as broad from f)
        select case when strict then 'strict' when broad then 'broad' else 'none' end as tier, variable_name, count(*) as n, count(*) filter (broad) as n_broad from b group by all"""),
    "calibration_ece": (calibration_ece, CALIBRATION_SQL),
    "swarm_vote_majority": (swarm_vote_majority, MAJORITY_SQL),
    "swarm_vote_weighted": (swarm_vote_weighted, WEIGHTED_SQL),
    "envelope_vote": (envelope_vote, ENVELOPE_SQL),
    "drop_reason_mode": (drop_reason_mode, CHECKED_SQL + ", e as (select entity, unnest(string_split(reject_reason, ';')) as code from checked where reject_reason <> ''), c as (select entity, code, count(*) as n from e group by all) select entity, arg_min(code, row(-n, code)) as mode_reason, max(n) as n from c group by 1"),
    "model_vote_jitter": (model_vote_jitter, JITTER_SQL),
    "provenance_rollup": (provenance_rollup, ROLLUP_SQL),
}
