"""Candidate articles and documents: scoring, gates, caps, deduplication, stop rules, quality."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veinstone.functions.text import blank, filled, overlap_ratio, phrase_overlap, tokens, word_in


def discovery_score(title: Column, abstract: Column, query: list[str], keywords: list[str], entities: list[str], phrases: list[str], provider_weight: Column, url: Column, boost: Column, penalty: Column, gate: Column) -> Column:
    """The weighted sum of overlaps; the weights add up to 1.08, so that it may exceed 1."""
    lit = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    t, a = tokens(title), tokens(abstract)
    both = F.array_union(t, a)
    score = (
        0.34 * overlap_ratio(lit(query), t) + 0.22 * overlap_ratio(lit(query), a) + 0.16 * overlap_ratio(lit(keywords), both) + 0.14 * overlap_ratio(lit(entities), both)
        + 0.08 * phrase_overlap(phrases, F.concat_ws(" ", blank(title), blank(abstract))) + 0.08 * provider_weight + 0.06 * url + boost - penalty - F.when(gate, 0.0).otherwise(0.35)
    )
    return F.bround(score, 6)


#: Terms of the relevance gate.
MATERIAL_TERMS = ["nickel", "ni"]
PROCESS_TERMS = ["anneal", "annealing", "thermal", "temperature"]
ANCHOR_TERMS = ["silicide", "ni2si", "nisi", "nisi2"]
NEGATIVE_TERMS = ["diamond", "curie", "ferromagnetic", "ferromagnetism", "hfo2", "hafnia"]
#: Words of a query or specification that turn the gate on.
GATE_WORDS = ("nickel", "ni2si", "nisi2", "silicide")
#: How far providers are trusted.
PROVIDER_WEIGHTS = {"openalex": 0.9, "europepmc": 0.85, "crossref": 0.7, "arxiv": 0.65, "localfs": 0.72}


def gate_enabled(*texts: str) -> bool:
    """Whether the query or the specification's words call for the relevance gate."""
    whole = " ".join(texts).lower()
    return any(w in whole for w in GATE_WORDS)


def relevance_gate(title: Column, abstract: Column, anchor: list[str] = ANCHOR_TERMS, material: list[str] = MATERIAL_TERMS, process: list[str] = PROCESS_TERMS, enabled: bool = True) -> Column:
    """struct(ok, reasons): an anchor term and a term of material or process must stand in title or abstract."""
    if not enabled:
        return F.struct(F.lit(True).alias("ok"), F.lit("").alias("reasons"))
    whole = F.concat_ws(" ", blank(title), blank(abstract))
    has_anchor, has_other = word_in(whole, anchor), word_in(whole, material) | word_in(whole, process)
    why = F.concat_ws(",", F.when(~has_anchor, "missing_silicide_term"), F.when(~has_other, "missing_material_or_process_term"))
    return F.struct((has_anchor & has_other).alias("ok"), why.alias("reasons"))


def negative_penalty(title: Column, abstract: Column, negative: list[str] = NEGATIVE_TERMS, anchor: list[str] = ANCHOR_TERMS, process: list[str] = PROCESS_TERMS) -> Column:
    """0.18 for a negative term in a text without both an anchor and a process term."""
    whole = F.concat_ws(" ", blank(title), blank(abstract))
    return F.when(word_in(whole, negative) & ~(word_in(whole, anchor) & word_in(whole, process)), 0.18).otherwise(0.0)


def provider_weight(provider: Column) -> Column:
    pairs = [F.lit(x) for kv in PROVIDER_WEIGHTS.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[F.lower(blank(provider))], F.lit(0.55))


def eligible(is_oa: Column, article_type: Column, language: Column, oa_required: bool = True, types: tuple[str, ...] = ("journal-article", "preprint"), languages: tuple[str, ...] = ("en",), english_first: bool = False) -> Column:
    """Open access if required, an allowed type or none, and an allowed language unless English only goes first."""
    kind = F.lower(F.trim(blank(article_type)))
    fine = (F.coalesce(is_oa, F.lit(False)) if oa_required else F.lit(True)) & ((kind == "") | kind.isin(*types))
    return fine if english_first or not languages else fine & F.lower(F.trim(blank(language))).isin(*languages)


def dedupe_quality(rows: DataFrame) -> Column:
    """What makes one record of an article better than another: readable here, fields that are filled, an open URL, the provider, the year."""
    c = F.col
    fields = sum((filled(c(x)).cast("int") for x in ("title", "abstract", "venue", "doi", "oa_url", "language", "license")), F.lit(0))
    readable = c("local_readable") if "local_readable" in rows.columns else F.lit(False)
    return F.struct(((c("provider") == "localfs") & readable).alias("a"), fields.alias("b"), filled(c("oa_url")).alias("c"), (c("provider") == "openalex").alias("d"), F.coalesce("year", F.lit(0)).alias("e"))


def selection_label(score: Column, minimum: float, gate: Column) -> Column:
    """keep, or why not; the relevance gate overrides the score."""
    return F.when(~gate, "drop:relevance_gate").when(score < minimum, "drop:min_discovery_score").otherwise("keep")


def per_group_cap(rows: DataFrame, by: str, order: list[Column], cap: int) -> DataFrame:
    """The first rows of each group; Spark keeps only so many per task before the shuffle."""
    w = Window.partitionBy(by).orderBy(*order)
    return rows.withColumn("group_rank", F.row_number().over(w)).where(F.col("group_rank") <= cap)


def dedupe_best(rows: DataFrame, key: Column, quality: Column, order: str) -> DataFrame:
    """Of rows with equal keys that of the highest quality; ties keep the earlier one. Only the key, quality and order are aggregated before the row is picked."""
    best = rows.withColumn("_key", key).withColumn("_quality", quality)
    return best.groupBy("_key").agg(F.max_by(F.struct(*rows.columns), F.struct("_quality", (-F.col(order)).alias("o"))).alias("r")).select("r.*")


def dedupe_years(rows: DataFrame, key: str, year: str) -> DataFrame:
    """rows with cluster: within a key and by year, a row joins the cluster whose first year is at most one before its own, else begins one; a row without a year makes one cluster of its whole key.

    Clusters depend on a key's distinct years alone, which are few whatever the key's rows.
    """
    begun = F.aggregate("_ys", F.array().cast("array<int>"), lambda a, y: F.when((F.size(a) == 0) | (y - F.coalesce(F.try_element_at(a, F.lit(-1)), y) > 1), F.concat(a, F.array(y))).otherwise(a))
    per = rows.groupBy(F.col(key).alias("_key")).agg(F.array_sort(F.collect_set(F.col(year).cast("int"))).alias("_ys"), F.max(F.col(year).isNull()).alias("_open")).select("_key", "_open", begun.alias("_begun"))
    joined = rows.join(per, F.col(key).eqNullSafe(F.col("_key")))
    return joined.withColumn("cluster", F.when(F.col("_open"), 0).otherwise(F.size(F.filter("_begun", lambda a: a <= F.col(year))) - 1)).drop("_key", "_open", "_begun")


def saturation(pages: DataFrame, by: str, order: str, value: str, window: int, minimum: float, least: int) -> DataFrame:
    """pages with the mean of the last `window` values and whether the stop rule holds there; kept is false beyond the first stop."""
    w = Window.partitionBy(by).orderBy(order)
    rolled = pages.withColumn("page_no", F.row_number().over(w)).withColumn("rolling_mean", F.avg(value).over(w.rowsBetween(-(window - 1), 0)))
    stop = rolled.withColumn("stop", (F.col("page_no") >= least) & (F.round("rolling_mean", 9) < minimum))
    return stop.withColumn("kept", F.coalesce(F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)) == F.lit(False))


def document_quality(status: Column, mime: Column, text: Column, least: int) -> Column:
    """usable, or the first reason against it."""
    return (
        F.when(status.isin("fetch_failed", "skipped_non_english"), status)
        .when(F.lower(blank(mime)).contains("json"), "json_not_fulltext")
        .when(~status.isin("parsed_html", "parsed_text", "parsed_xml", "parsed_pdf"), "unsupported_parse_status")
        .when(F.length(F.trim(blank(text))) < max(1, least), F.format_string("short_text<%d", F.lit(least)))
        .otherwise("usable")
    )


#: Where providers' records hold URLs of full texts.
RECORD_URLS = "struct<best_oa_location: struct<pdf_url: string, landing_page_url: string>, open_access: struct<oa_url: string>, locations: array<struct<pdf_url: string, landing_page_url: string>>, link: array<struct<URL: string>>, fullTextUrlList: struct<fullTextUrl: array<struct<url: string>>>>"


def provider_urls(provider: Column, raw_json: Column) -> Column:
    """The URLs in a provider's record, in its order; none of providers without any."""
    r, none = F.from_json(blank(raw_json), RECORD_URLS), F.array().cast("array<string>")
    places = F.flatten(F.transform(F.coalesce(r["locations"], F.array().cast("array<struct<pdf_url: string, landing_page_url: string>>")), lambda x: F.array(x["pdf_url"], x["landing_page_url"])))
    openalex = F.concat(F.array(r["best_oa_location"]["pdf_url"], r["best_oa_location"]["landing_page_url"], r["open_access"]["oa_url"]), places)
    return F.coalesce(F.when(provider == "openalex", openalex).when(provider == "crossref", F.transform(r["link"], lambda x: x["URL"])).when(provider == "europepmc", F.transform(r["fullTextUrlList"]["fullTextUrl"], lambda x: x["url"])), none)


def url_candidates(first: Column, *rest: Column, listed: Column | None = None) -> Column:
    """The distinct fetchable URLs in order of preference: the first, those listed in the record, the rest. Metadata APIs are not fetched."""
    every = F.concat(F.array(first), F.array().cast("array<string>") if listed is None else listed, F.array(*rest).cast("array<string>"))
    return F.array_distinct(F.filter(F.transform(every, lambda u: F.trim(blank(u))), lambda u: u.rlike("^(https?://|file:|/)") & ~F.lower(u).contains("api.openalex.org/works")))


def chunk_sentences(docs: DataFrame, key: str, sentences: str, size: int, overlap: int) -> DataFrame:
    """Sentences packed greedily into chunks of at most `size` words, each starting with the tail of the one before of at most `overlap` words; longer sentences are cut."""

    def pack(parts: list[str]) -> Iterator[str]:
        pieces: list[list[str]] = []
        for s in parts:
            words = s.split()
            pieces += [words[i : i + size] for i in range(0, len(words), size)]
        held: list[list[str]] = []
        n = 0
        for words in pieces:
            if held and n + len(words) > size:
                yield " ".join(w for p in held for w in p)
                tail: list[list[str]] = []
                left = min(overlap, size - len(words))
                for p in reversed(held):
                    if len(p) > left:
                        break
                    tail.insert(0, p)
                    left -= len(p)
                held, n = tail, sum(map(len, tail))
            held.append(words)
            n += len(words)
        if held:
            yield " ".join(w for p in held for w in p)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, i, c, len(c.split())) for k, parts in zip(batch["k"], batch["s"]) for i, c in enumerate(pack([x for x in parts if x]))]
            yield pd.DataFrame(rows, columns=[key, "chunk_index", "chunk", "n_words"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(sentences).alias("s")).mapInPandas(run, f"{key} {kind}, chunk_index int, chunk string, n_words int")


def read_through(requests: DataFrame, cache: DataFrame, now: Column, key: str = "cache_key") -> tuple[DataFrame, DataFrame]:
    """(hits, misses): requests answered by an unexpired cache row, and the others."""
    live = cache.where(F.col("expires_at") > now)
    return requests.join(live, key), requests.join(live.select(key), key, "left_anti")


def carry_forward(rows: DataFrame, by: str, order: str, heading: Column) -> DataFrame:
    """rows with the last heading seen at or before them in their group."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("heading", F.last(heading, ignorenulls=True).over(w))
