"""Candidate recipes: scores, safety, progressive gates, ranking; quality gates and drift."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veinstone.functions.science import clamp, jitter
from veinstone.functions.text import blank
from veinstone.operators.evidence import keep_one
from veinstone.session import stored

#: Fixed values: (gate, least evidence, least reproducibility, most uncertainty), from loose to strict.
GATES = (("loose", 0.35, None, 0.45), ("balanced", 0.55, 0.50, 0.35), ("strict", 0.70, 0.65, 0.25))


def scored(candidates: DataFrame, quality: Column, hint: Column, target: Column, bonus: Column, ids: list[Column]) -> DataFrame:
    """candidates with evidence, reproducibility, uncertainty, novelty, phase_prob and weighted score."""
    raw_e, raw_r = clamp(0.35 + 0.45 * quality + 0.20 * hint), clamp(0.30 + 0.40 * quality + 0.30 * hint)
    out = candidates.withColumns({"target_satisfaction": target, "evidence": clamp(raw_e + 0.5 * bonus), "reproducibility": clamp(raw_r + 0.35 * bonus), "novelty": 0.15 + 0.75 * jitter(*ids, digits=4)})
    out = out.withColumn("uncertainty", 1 - (0.6 * F.col("evidence") + 0.4 * F.col("reproducibility"))).withColumn("phase_prob", clamp(0.55 * F.col("target_satisfaction") + 0.45 * F.col("evidence"), 0, 0.99))
    return out.withColumn("weighted", clamp(0.45 * clamp(F.col("target_satisfaction")) + 0.30 * F.col("evidence") + 0.20 * F.col("reproducibility") + 0.05 * F.col("novelty") + bonus))


def safety(candidates: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """candidates with the reasons that block them, sorted, and safe."""
    why = F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rules])))
    return candidates.withColumn("blocked_by", F.array_join(why, ";")).withColumn("safe", F.size(why) == 0)


def progressive(candidates: DataFrame) -> DataFrame:
    """candidates with the last gate passed; each gate applies to the survivors of the one before. An uncertainty of 0 counts as missing and fails."""
    unsure = F.coalesce(F.nullif(F.col("uncertainty"), F.lit(0.0)), F.lit(1.0))
    nine = lambda c: F.round(c, 9)
    passed, label = F.lit(True), F.lit("none")
    for name, evidence, reproducibility, most in GATES:
        passed = passed & (nine(F.col("evidence")) >= evidence) & (nine(unsure) <= most)
        if reproducibility is not None:
            passed = passed & (nine(F.col("reproducibility")) >= reproducibility)
        label = F.when(passed, F.lit(name)).otherwise(label)
    return candidates.withColumn("gate", label)


def gate_audit(candidates: DataFrame) -> DataFrame:
    """A row per candidate and gate that it came to, with passed and, if not, the reasons."""
    nine = lambda c: F.round(c, 9)
    unsure = F.coalesce(F.nullif(F.col("uncertainty"), F.lit(0.0)), F.lit(1.0))
    own, before = [], F.lit(True)
    for name, evidence, reproducibility, most in GATES:
        weak = F.lit(False) if reproducibility is None else nine(F.col("reproducibility")) < reproducibility
        why = F.concat_ws(";", F.when(nine(F.col("evidence")) < evidence, "low_evidence_support"), F.when(weak, "low_reproducibility"), F.when(nine(unsure) > most, "high_uncertainty"))
        own.append(F.when(before, F.struct(F.lit(name).alias("stage"), (why == "").alias("passed"), why.alias("reason"))))
        before = before & (why == "")
    return progressive(candidates).withColumn("s", F.explode(F.array_compact(F.array(*own)))).select("*", "s.*").drop("s")


def phase_matches(material: str, kind: str, value: str) -> Column:
    """Whether an event is of the material that a request names, and of its phase: by label, amorphous, or space group."""
    label, film, snippet = (F.lower(F.trim(blank(F.col(c)))) for c in ("phase_label", "film_material", "snippet"))
    m, v = material.strip().lower(), value.strip().lower()
    base = label.contains(m) | film.contains(m) | snippet.contains(m)
    own = {"phase_label": label.contains(v) | snippet.contains(v), "amorphous": snippet.contains("amorph") | label.contains("amorph"), "space_group": snippet.contains(v)}
    return base & own.get(kind, F.lit(True))


def within(value: Column, low: float | None, high: float | None) -> Column:
    """Within bounds, each of which may be missing; a missing value is within."""
    ok = F.lit(True)
    ok = ok if low is None else ok & (value >= low)
    ok = ok if high is None else ok & (value <= high)
    return value.isNull() | ok


#: Methods without a constraint, and precursors by method.
METHODS = ("PVD", "CVD", "ALD")
PRECURSORS = {"ALD": "metal-organic precursor", "CVD": "gas precursor"}


def methods_of(named: list[str] | None) -> list[str]:
    """The methods that a request names, each once, else the usual ones."""
    return list(dict.fromkeys(n.strip() for n in named or [] if n.strip())) or list(METHODS)


def precursor_of(method: Column, named: list[str] | None = None) -> Column:
    """The first precursor that a request names, else the method's."""
    own = [n.strip() for n in named or [] if n.strip()]
    if own:
        return F.lit(own[0])
    return reduce(lambda w, kv: w.when(F.upper(method) == kv[0], F.lit(kv[1])), PRECURSORS.items(), F.when(F.lit(False), F.lit(""))).otherwise("sputter target")


#: Rows that a limit keeps in each task's memory; more are cut out of a sort.
IN_MEMORY = 10_000


def first_rows(rows: DataFrame, most: int, order: list[Column | str]) -> DataFrame:
    """The first `most` rows by order, which must tell all rows apart.

    Spark's own limit after a sort reserves memory for `most` rows in every task, so above IN_MEMORY
    rows are only sorted if there are no more of them; else the sorted ranges are stored and each
    gives as many rows as those before it leave.
    """
    if most <= IN_MEMORY:
        return rows.orderBy(*order).limit(most)
    if rows.count() <= most:
        return rows.orderBy(*order)
    ranges = stored(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    before, last = 0, None
    for r in ranges.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():  # a row per range
        if before + r["n"] > most:
            last = (r["part"], most - before)
            break
        before += r["n"]
    return ranges.where((part < last[0]) | (part == last[0]) & (at < last[1])).orderBy("_at").drop("_at")


def pool(events: DataFrame, matches: Column, most: int, n_methods: int, attempt: int, tie: str) -> DataFrame:
    """The events that candidates are made of: on the first attempt those that match, if any do; the best by quality, as many as the request's candidates leave to each method, 20 at least."""
    own = events.where(matches) if attempt == 0 and not events.where(matches).isEmpty() else events
    return first_rows(own, max(20, most // max(n_methods, 1)), [F.desc(F.coalesce("film_quality_score_numeric", F.lit(0.0))), F.asc(blank(F.col("phase_label"))), tie])


def reference_signal(evidence: Column, reproducibility: Column, label: Column, score: Column) -> tuple[Column, Column]:
    """Both after what an event's references say of it; unchanged without a score."""
    low = F.lower(F.trim(blank(label)))
    moved = lambda c, up, down, some: F.when(score.isNull(), c).otherwise(clamp(c + F.when(low == "supports", up * score).when(low == "conflicts", -down * (1 - score)).when(low == "neutral", some * score).otherwise(0.0)))
    return moved(evidence, 0.08, 0.14, 0.02), moved(reproducibility, 0.06, 0.10, 0.0)


def candidates(events: DataFrame, request: dict, attempt: int = 0, seed: int = 17, tie: str = "event_id") -> DataFrame:
    """Candidate recipes of a request: pool x methods, with conditions, scores and recipe_id.

    request: film_material, phase_type, phase_value, methods, precursors, substrates, bounds (name ->
    (low, high)), max_candidates, references. Later attempts move temperature and time by a hash of
    event, method and attempt in place of a sequential random generator. Missing and zero conditions
    take defaults.
    """
    methods, most = methods_of(request.get("methods")), int(request.get("max_candidates", 200))
    fits = phase_matches(request["film_material"], request["phase_type"], request["phase_value"])
    own = pool(events.withColumn("_fits", fits), F.col("_fits"), most, len(methods), attempt, tie)
    crossed = own.withColumn("method", F.explode(F.array(*[F.lit(m) for m in methods]))).withColumn("precursor", precursor_of(F.col("method"), request.get("precursors")))
    value = lambda c, other: F.coalesce(F.nullif(F.col(c).cast("double"), F.lit(0.0)), F.lit(other)) if c in events.columns else F.lit(other)
    luck = lambda tag: jitter(F.col(tie).cast("string"), F.col("method"), F.lit(f"{seed}|{attempt}|{tag}"))
    t, s = value("anneal_temperature_c", 400.0), value("anneal_time_s", 120.0)
    if attempt:
        t, s = F.greatest(F.lit(20.0), t + (luck("t") * 45 - 20) * attempt), F.greatest(F.lit(1.0), s * (1 + (luck("s") * 0.6 - 0.2) * attempt))
    out = crossed.withColumns({"thickness_nm": value("thickness_nm", 10.0), "anneal_temperature_c": t, "anneal_time_s": s, "pressure_pa": value("pressure_pa", 101325.0), "strain_pct": value("strain_pct", 0.0)})
    off = [F.when(~within(F.col(c), low, high), 0.25).otherwise(0.0) for c, (low, high) in request.get("bounds", {}).items()]
    substrates = [x.strip().lower() for x in request.get("substrates", []) if x.strip()]
    strange = F.when(~F.lower(F.trim(blank(F.col("substrate_material")))).isin(*substrates), 0.15).otherwise(0.0) if substrates else F.lit(0.0)
    target = F.when(F.col("_fits"), 1.0).otherwise(0.65) - sum(off, F.lit(0.0)) - strange
    from veinstone.operators.materials import reference_bonus

    bonus = reference_bonus(F.col("film_material"), F.col("phase_label"), request["film_material"], request["phase_type"], request["phase_value"], request.get("references", []))
    quality, hint = clamp(F.coalesce(F.col("film_quality_score_numeric"), F.lit(0.0))), F.when(F.col("_fits"), 1.0).otherwise(0.6)
    e, r = reference_signal(clamp(0.35 + 0.45 * quality + 0.20 * hint), clamp(0.30 + 0.40 * quality + 0.30 * hint), F.col("mp_interpretation_label"), F.col("mp_interpretation_score").cast("double")) if {"mp_interpretation_label", "mp_interpretation_score"} <= set(events.columns) else (clamp(0.35 + 0.45 * quality + 0.20 * hint), clamp(0.30 + 0.40 * quality + 0.30 * hint))
    out = out.withColumns({"target_satisfaction": target, "bonus": bonus, "evidence": clamp(e + 0.5 * bonus), "reproducibility": clamp(r + 0.35 * bonus), "novelty": 0.15 + 0.75 * jitter(F.col(tie).cast("string"), F.col("method"), F.lit(str(attempt)), digits=4)})
    out = out.withColumn("uncertainty", clamp(1 - (0.6 * F.col("evidence") + 0.4 * F.col("reproducibility")))).withColumn("phase_prob", clamp(0.55 * F.col("target_satisfaction") + 0.45 * F.col("evidence"), 0, 0.99))
    out = out.withColumn("weighted", clamp(0.45 * F.col("target_satisfaction") + 0.30 * F.col("evidence") + 0.20 * F.col("reproducibility") + 0.05 * F.col("novelty") + F.col("bonus")))
    digits = lambda c: F.format_string("%.3f", F.col(c))
    parts = F.concat_ws("|", F.col(tie).cast("string"), F.upper("method"), digits("thickness_nm"), digits("anneal_temperature_c"), digits("anneal_time_s"), F.lit(str(attempt)))
    made = out.withColumns({"recipe_id": F.concat(F.lit("rcp_"), F.substring(F.sha1(parts.cast("binary")), 1, 14)), "method_family": F.upper("method"), "attempt": F.lit(attempt), "target_satisfaction": clamp(F.col("target_satisfaction"))})
    return first_rows(made.drop("_fits", "method"), most, [F.desc(F.coalesce("film_quality_score_numeric", F.lit(0.0))), blank(F.col("phase_label")), tie, "method_family"])


def attempts_union(attempts: list[DataFrame], key: str = "recipe_id", order: str = "attempt") -> DataFrame:
    """All attempts' candidates, of equal ones the earliest."""
    return keep_one(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), attempts), [key], [F.asc(order)])


def generate(events: DataFrame, request: dict, rules: list[tuple[str, Column]], retries: int = 2, top_k: int = 5) -> tuple[DataFrame, DataFrame]:
    """(ranked, all candidates): attempts until one has a candidate that is safe and passes the strict gate, which are ranked then; none otherwise."""
    made = []
    for attempt in range(retries + 1):
        made.append(stored(candidates(events, request, attempt), "candidates"))
        strict = progressive(safety(made[-1], rules).where("safe")).where("gate = 'strict'")
        if not strict.isEmpty():
            break
    return top(strict, top_k, "recipe_id"), attempts_union(made)


def blended(scored_rows: DataFrame) -> DataFrame:
    """Candidates with weighted score, phase probability, quality and uncertainty mixed with the processor's (processor_phase_prob, processor_quality_score, processor_uncertainty)."""
    p, q, u = (F.col(f"processor_{c}") for c in ("phase_prob", "quality_score", "uncertainty"))
    return scored_rows.withColumns({
        "weighted": clamp(0.35 * F.col("weighted") + 0.35 * p + 0.20 * q + 0.10 * (1 - u)), "phase_prob": clamp(0.55 * F.col("phase_prob") + 0.45 * p), "film_quality_score_numeric": clamp(0.60 * F.col("film_quality_score_numeric") + 0.40 * q), "uncertainty": clamp(0.50 * F.col("uncertainty") + 0.50 * u),
    })


def cards(ranked: DataFrame, request: dict) -> DataFrame:
    """(recipe_id, card): each ranked recipe as a JSON document of target, steps, conditions, outcomes, uncertainty and evidence."""
    c = lambda *names: [F.col(n) if n in ranked.columns else F.lit(None).cast("string").alias(n) for n in names]
    deposit = F.struct(F.lit(1).alias("step"), F.lit("deposit").alias("action"), F.col("method_family"), F.struct(*c("precursor", "substrate_material", "substrate_orientation", "thickness_nm")).alias("inputs"))
    anneal = F.struct(F.lit(2).alias("step"), F.lit("anneal").alias("action"), F.lit("ANNEAL").alias("method_family"), F.struct(F.col("anneal_temperature_c").alias("temperature_c"), F.col("anneal_time_s").alias("time_s"), "pressure_pa", F.lit("N2").alias("ambient")).alias("inputs"))
    card = F.struct(
        "recipe_id", F.struct(F.lit(request["film_material"]).alias("film_material"), F.struct(F.lit(request["phase_type"]).alias("type"), F.lit(request["phase_value"]).alias("value")).alias("phase_target")).alias("target"), F.struct(deposit.alias("deposit"), anneal.alias("anneal")).alias("method_flow"),
        F.struct("thickness_nm", F.col("anneal_temperature_c").alias("temperature_c"), F.col("anneal_time_s").alias("time_s"), "pressure_pa", "strain_pct").alias("condition_vector"), F.struct("phase_prob", F.col("film_quality_score_numeric").alias("quality_score")).alias("predicted_outcomes"),
        F.struct(F.col("uncertainty").alias("epistemic"), F.col("evidence").alias("data_support")).alias("uncertainty"), F.struct(*c("doi", "locator", "citation_url")).alias("evidence"), F.lit("best").alias("gate_stage_passed"),
    )
    return ranked.select("recipe_id", F.to_json(card, {"ignoreNullFields": "false"}).alias("card"))


def proposed(events: DataFrame, material: str, most: int, order: str) -> DataFrame:
    """Events whose phase or snippet names the material, up to `most` by order; any, if none does."""
    m = material.strip().lower()
    own = events.where(F.lower(blank(F.col("phase_label"))).contains(m) | F.lower(blank(F.col("snippet"))).contains(m))
    return (events if own.isEmpty() else own).orderBy(order).limit(most)


def support_hint(quality: Column) -> Column:
    return clamp(0.45 + 0.50 * F.coalesce(quality, F.lit(0.0)))


def top(candidates: DataFrame, k: int, tie: str) -> DataFrame:
    digits = [F.desc(F.round(c, 6)) for c in ("weighted", "target_satisfaction", "evidence", "reproducibility")]
    return candidates.orderBy(*digits, tie).limit(k)


def ndcg(rows: DataFrame, by: str, score: Column, relevance: str, k: int, tie: str) -> DataFrame:
    """Per group the discounted gain of the order by score over that of the best order."""
    own, best = Window.partitionBy(by).orderBy(score.desc(), tie), Window.partitionBy(by).orderBy(F.desc(relevance), tie)
    ranked = rows.withColumn("_i", F.row_number().over(own)).withColumn("_j", F.row_number().over(best))
    gain = lambda i: F.when(F.col(i) <= k, (F.pow(F.lit(2.0), F.col(relevance)) - 1) / F.log2(F.col(i) + 1))
    dcg, ideal = F.sum(gain("_i")), F.sum(gain("_j"))
    return ranked.groupBy(by).agg(F.when(ideal > 0, dcg / ideal).otherwise(0.0).alias("ndcg"))


def drift(before: DataFrame, after: DataFrame, key: str, value: str, most: float) -> DataFrame:
    """Relative change of each metric, absent ones as 0, and whether it is within `most`."""
    a, b = before.select(key, F.col(value).alias("before")), after.select(key, F.col(value).alias("after"))
    both = a.join(b, key, "full").select(key, F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))
    change = F.abs(F.col("after") - F.col("before")) / F.greatest(F.abs("before"), F.lit(1))
    return both.withColumn("drift", change).withColumn("ok", F.round(change, 9) <= most)


def link_difference(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Links added and removed."""
    return new.join(old, keys, "left_anti").select(*keys, F.lit("added").alias("change")).union(old.join(new, keys, "left_anti").select(*keys, F.lit("removed").alias("change")))


def fingerprint(rows: DataFrame, columns: list[str], by: str) -> DataFrame:
    """SHA-1 of each group's number of rows and two sums over its rows' SHA-1: the same in any order of rows, and no list of them. (A hash of the sorted rows themselves would need a whole group in one task.)"""
    own = rows.select(F.col(by), F.sha1(F.concat_ws("|", *columns).cast("binary")).alias("h"))
    part = lambda a: F.sum(F.conv(F.substring("h", a, 15), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)").cast("string")
    return own.groupBy(by).agg(F.sha1(F.concat_ws("|", F.count(F.lit(1)).cast("string"), part(1), part(16)).cast("binary")).alias("fingerprint"))


def oversample(rows: DataFrame, where: Column, times: int) -> DataFrame:
    """rows and `times` more copies of those that the condition names."""
    return reduce(DataFrame.unionAll, [rows, *[rows.where(where)] * times])
