"""Tuples out of language-model replies: prompts, calls with a pluggable client, tolerant parsing."""

from __future__ import annotations

import importlib
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinstone.functions.text import blank

REPLY = "array<struct<entity: string, x: double, y: double, confidence: double>>"


def prompt(chunk: Column, variables: list[str], entities: list[str]) -> Column:
    return F.format_string("Extract (entity, x, y, confidence) as JSON.\nVariables: %s\nEntities: %s\nText:\n%s", F.lit(", ".join(variables)), F.lit(", ".join(entities)), chunk)


def reply_text(body: object) -> str:
    """The text of an endpoint's answer, in any of its envelopes."""
    first = body[0] if isinstance(body, list) and body else body
    if isinstance(first, dict):
        choice = first["choices"][0] if isinstance(first.get("choices"), list) and first["choices"] else None
        if isinstance(choice, dict):
            return str(choice.get("text") or (choice.get("message") or {}).get("content") or "")
        return str(first.get("generated_text") or first.get("text") or "") if {"generated_text", "text"} & set(first) else str(first)
    return "" if first is None else str(first)


def call(requests: DataFrame, client: str, retries: int = 0, cache: DataFrame | None = None) -> DataFrame:
    """requests (request_id, model_id, prompt) with reply, attempts and seconds; client names a function (model, prompt) -> answer, of which a failure gives a null reply after `retries` more attempts.

    Equal prompts of a model are asked once; those that the cache (model_id, prompt_key, reply) holds, never.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        module, _, name = client.partition(":")
        ask = getattr(importlib.import_module(module), name)

        def answer(model: str, text: str) -> tuple[str | None, int, float]:
            began = time.monotonic()
            for attempt in range(1, retries + 2):
                try:
                    return reply_text(ask(model, text)), attempt, time.monotonic() - began
                except Exception:
                    continue
            return None, attempt, time.monotonic() - began

        for batch in batches:
            found = [answer(m, p) for m, p in zip(batch["model_id"], batch["prompt"])]
            yield pd.DataFrame({"model_id": batch["model_id"], "prompt_key": batch["prompt_key"], "reply": [f[0] for f in found], "attempts": [f[1] for f in found], "seconds": [f[2] for f in found]})

    keyed = requests.select("request_id", "model_id", "prompt", F.sha1(blank(F.col("prompt")).cast("binary")).alias("prompt_key"))
    new = keyed if cache is None else keyed.join(cache.select("model_id", "prompt_key"), ["model_id", "prompt_key"], "left_anti")
    answered = new.dropDuplicates(["model_id", "prompt_key"]).select("model_id", "prompt_key", "prompt").mapInPandas(run, "model_id string, prompt_key string, reply string, attempts int, seconds double")
    if cache is not None:
        answered = answered.unionByName(cache.select("model_id", "prompt_key", "reply", F.lit(0).alias("attempts"), F.lit(0.0).alias("seconds")))
    return keyed.join(answered, ["model_id", "prompt_key"]).select("request_id", "model_id", "prompt", "reply", "attempts", "seconds")


def overridden(votes: DataFrame, opinions: DataFrame) -> DataFrame:
    """votes (point_id, model_id, confidence, valid) with the confidence and validity that an endpoint gave for some of them."""
    own = opinions.select("point_id", "model_id", F.col("confidence").alias("_c"), F.col("valid").alias("_v"))
    return votes.join(own, ["point_id", "model_id"], "left").withColumns({"confidence": F.coalesce("_c", "confidence"), "valid": F.coalesce("_v", "valid")}).drop("_c", "_v")


def recovered(reply: Column) -> Column:
    """The first part of a reply that is JSON: all of it, a fenced block, from the first to the last bracket or brace; null if none is."""
    parts = [reply, F.regexp_extract(reply, r"(?s)```(?:json)?\s*(.*?)```", 1), F.regexp_extract(reply, r"(?s)(\[.*\])", 1), F.regexp_extract(reply, r"(?s)(\{.*\})", 1)]
    return F.coalesce(*[F.when((F.trim(p) != "") & F.try_parse_json(p).isNotNull() & F.trim(p).rlike(r"^[\[{]"), F.trim(p)) for p in parts])


def tuples(reply: Column) -> Column:
    """The tuples of a reply; a single object counts as a list of one."""
    json = recovered(reply)
    listed = F.when(F.substring(json, 1, 1) == "{", F.concat(F.lit("["), json, F.lit("]"))).otherwise(json)
    return F.coalesce(F.from_json(listed, REPLY, {"allowSingleQuotes": "false"}), F.array().cast(REPLY))


#: Other names of a tuple's fields.
FIELDS = {"entity": ("entity", "phase", "phase_name", "target_phase"), "x": ("x", "thickness", "thickness_nm", "film_thickness_nm", "as_deposited_thickness_nm"), "y": ("y", "temperature", "temperature_c", "anneal_temperature_c", "annealing_temperature_c"), "snippet": ("snippet", "evidence", "text", "quote"), "locator": ("locator", "location", "source_locator")}


def points(reply: Column) -> Column:
    """The points of a reply, in its envelopes (a list, points, data, one object, else the first flat object in the text) and under any of their fields' names; those without entity, x or y are left out."""
    maps = "array<map<string,string>>"
    json = recovered(reply)
    parse = lambda c, schema: F.from_json(c, schema, {"allowSingleQuotes": "false"})
    wrapped = parse(json, f"points {maps}, data {maps}")
    one = F.when(F.substring(json, 1, 1) == "{", F.array(parse(json, "map<string,string>")))
    flat = F.transform(F.regexp_extract_all(blank(reply), F.lit(r"\{[^{}]+\}"), F.lit(0)), lambda x: parse(x, "map<string,string>"))
    listed = F.when(F.substring(json, 1, 1) == "[", parse(json, maps))
    found = F.coalesce(wrapped["points"], wrapped["data"], listed, one, flat)
    pick = lambda m, names: F.coalesce(*[F.nullif(F.trim(m[n]), F.lit("")) for n in names])
    made = F.transform(found, lambda m: F.struct(pick(m, FIELDS["entity"]).alias("entity"), pick(m, FIELDS["x"]).try_cast("double").alias("x"), pick(m, FIELDS["y"]).try_cast("double").alias("y"), blank(pick(m, FIELDS["snippet"])).alias("snippet"), blank(pick(m, FIELDS["locator"])).alias("locator"), F.coalesce(m["confidence"].try_cast("double"), F.lit(0.75)).alias("confidence")))
    whole = F.filter(made, lambda p: p["entity"].isNotNull() & p["x"].isNotNull() & p["y"].isNotNull())
    whole = F.when(F.coalesce(wrapped["points"], wrapped["data"], listed, one).isNull(), F.slice(whole, 1, 1)).otherwise(whole)
    return F.coalesce(whole, F.array().cast("array<struct<entity: string, x: double, y: double, snippet: string, locator: string, confidence: double>>"))
