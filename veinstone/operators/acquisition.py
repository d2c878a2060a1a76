"""Fetching of candidate URLs with a pluggable client: resume, polite lanes, first success."""

from __future__ import annotations

import importlib
import time
from collections.abc import Iterator
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinstone.operators.evidence import keep_one

RESULT = "article_key string, candidate_rank int, url string, ok boolean, status int, mime string, content binary, reason string"


def pending(candidates: DataFrame, progress: DataFrame, order: list[Column], most: int) -> DataFrame:
    """Candidates whose article has no final status yet, up to `most` in order."""
    done = progress.where(F.col("status").isin("success", "skipped")).select("article_key").distinct()
    return candidates.join(done, "article_key", "left_anti").orderBy(*order).limit(most)


class Robots:
    """What domains allow, asked once a task and domain; a domain without an answer allows everything."""

    def __init__(self, call, agent: str):
        self.call, self.agent, self.known = call, agent, {}

    def allows(self, url: str) -> bool:
        parts = urlsplit(url)
        if not parts.scheme.startswith("http"):
            return True  # files have no robots
        if parts.netloc not in self.known:
            rules = RobotFileParser()
            try:
                status, _, content = self.call(f"{parts.scheme}://{parts.netloc}/robots.txt")
                rules.parse(content.decode("utf-8", "replace").splitlines() if status < 400 else ["User-agent: *", "Allow: /"])
            except Exception:
                rules.parse(["User-agent: *", "Allow: /"])
            self.known[parts.netloc] = rules
        return self.known[parts.netloc].can_fetch(self.agent, url)


def fetch(candidates: DataFrame, client: str, delay: float = 1.0, retries: int = 1, lanes: int = 1, robots: bool = False, agent: str = "veinstone") -> DataFrame:
    """One result per candidate (article_key, candidate_rank, url). With robots, what a domain's robots.txt forbids is not fetched: its reason is robots.

    client names a function (url) -> (status, mime, content). Candidates of a domain are dealt to
    `lanes` tasks, each of which waits `delay` seconds between requests to it and retries with a
    growing pause: lanes is the politeness towards a domain, and what bounds a popular one.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        module, _, name = client.partition(":")
        call = getattr(importlib.import_module(module), name)
        last: dict[str, float] = {}
        rules = Robots(call, agent)
        for batch in batches:
            rows = []
            for key, rank, url, domain in zip(batch["article_key"], batch["candidate_rank"], batch["url"], batch["domain"]):
                status, mime, content, reason = 0, "", b"", "not_tried"
                if robots and not rules.allows(url):
                    rows.append((key, rank, url, False, status, mime, content, "robots"))
                    continue
                for attempt in range(retries + 1):
                    wait = last.get(domain, 0.0) + delay * (1 + attempt) - time.monotonic()
                    if wait > 0:
                        time.sleep(wait)
                    last[domain] = time.monotonic()
                    try:
                        status, mime, content = call(url)
                        reason = "" if status < 400 else f"http_{status}"
                    except Exception as e:
                        reason = type(e).__name__
                    if not reason:
                        break
                rows.append((key, rank, url, not reason, status, mime, content, reason))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    domain = F.coalesce(F.nullif(F.regexp_extract("url", "^[a-z]+://([^/:?#]+)", 1), F.lit("")), F.lit("local"))
    dealt = candidates.select("article_key", "candidate_rank", "url", domain.alias("domain")).withColumn("lane", F.pmod(F.xxhash64("url"), F.lit(lanes)))
    return dealt.repartition("domain", "lane").mapInPandas(run, RESULT)


def first_success(results: DataFrame) -> DataFrame:
    """Per article the successful result of the least rank, or the failure of the first candidate."""
    rank = F.struct((~F.col("ok")).alias("failed"), "candidate_rank")
    return results.groupBy("article_key").agg(F.min_by(F.struct(*[c for c in results.columns if c != "article_key"]), rank).alias("r"), F.count(F.lit(1)).alias("attempts")).select("article_key", "attempts", "r.*")


def resumed(rows: DataFrame, before: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """New rows and those of an earlier run, of equal keys the first by order."""
    return keep_one(rows.unionByName(before, allowMissingColumns=True), keys, order)
