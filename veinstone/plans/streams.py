"""Queries that stream the events table to its end; results are those of the batch form."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from veinstone.plans.evidence import read
from veinstone.streaming import events as ops


def stream(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    return ops.source(spark, path, read(spark, sf_dir, "events").schema)


def name(kind: str) -> str:
    return f"veinstone_{kind}_{uuid.uuid4().hex[:8]}"


def stream_tumbling(spark, sf_dir):
    # complete mode: windows that the watermark has not closed yet are results too
    out = ops.drain(ops.tumbling(stream(spark, sf_dir), "1 day"), name("tumbling"), "complete")
    return out.select("window_start", "event_type", "n", F.round("total", 2).alias("total"))


def stream_sliding(spark, sf_dir):
    return ops.drain(ops.sliding(stream(spark, sf_dir), "2 days", "1 day"), name("sliding"), "complete")


def stream_session(spark, sf_dir):
    out = ops.drain(ops.sessions(stream(spark, sf_dir), "6 hours"), name("session"), "complete")
    return out.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("n").alias("n"))


def stream_dedupe_watermark(spark, sf_dir):
    s = stream(spark, sf_dir)
    return ops.drain(ops.deduplicated(s.union(s), ["event_id"], "365 days").select("event_id"), name("dedupe"))


def stream_stateful_saturation(spark, sf_dir):
    out = ops.drain(ops.saturation(stream(spark, sf_dir)), name("saturation"), "update")
    return out.groupBy("event_type").agg(F.max_by(F.struct("n", "mean", "saturated"), "n").alias("s")).select("event_type", F.col("s.n").alias("n"), F.round("s.mean", 4).alias("mean"), "s.saturated")


REGISTRY = {
    "stream_tumbling": (stream_tumbling, "select date_trunc('day', ts)::timestamp as window_start, event_type, count(*) as n, round(sum(value), 2) as total from events group by all"),
    "stream_sliding": (stream_sliding, "with w as (select unnest([date_trunc('day', ts)::timestamp, date_trunc('day', ts)::timestamp - interval 1 day]) as window_start, value from events) select window_start, count(*) as n, max(value) as high from w group by 1"),
    "stream_session": (stream_session, "with l as (select user_id, ts, lag(ts) over (partition by user_id order by ts) as p from events) select user_id, count(*) filter (p is null or ts - p >= interval 6 hours) as sessions, count(*) as n from l group by 1"),
    "stream_dedupe_watermark": (stream_dedupe_watermark, "select event_id from events"),
    "stream_stateful_saturation": (stream_stateful_saturation, "select event_type, count(*) as n, round(avg(value), 4) as mean, avg(value) < 10 as saturated from events group by 1"),
}
