"""Structured Streaming over a table of events: windows, deduplication, sessions, a stop rule with state.

Every function takes a streaming (or batch) frame with ts, event_type, user_id and value;
`drain` runs one to the end of its source and returns what was written.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from veinstone.session import shared_folder


def source(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 1000) -> DataFrame:
    """A table as a file stream; path is a folder of Parquet files, or one file."""
    folder, _, name = path.rpartition("/")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.option("pathGlobFilter", name).parquet(folder) if _is_file(spark, path) else reader.parquet(path)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))  # event time needs an instant


def _is_file(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def tumbling(events: DataFrame, width: str, late: str = "1 hour") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str, step: str, late: str = "1 hour") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width, step)).agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("high"))
    return w.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "n", "high")


def sessions(events: DataFrame, gap: str, late: str = "1 hour") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return w.select("user_id", F.col("s.start").cast("timestamp_ntz").alias("session_start"), "n")


def deduplicated(events: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Each key once, as long as its repeats come within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def _running(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    n, total = state.get if state.exists else (0, 0.0)
    for f in frames:
        n, total = n + len(f), total + float(f["value"].sum())
    state.update((n, total))
    yield pd.DataFrame({"event_type": [key[0]], "n": [n], "mean": [total / n if n else 0.0], "saturated": [bool(n and total / n < 10)]})


def saturation(events: DataFrame) -> DataFrame:
    """Per event type the running count and mean, and whether the yield has fallen below 10; state is two numbers a type."""
    return events.select("event_type", "value").groupBy("event_type").applyInPandasWithState(_running, "event_type string, n long, mean double, saturated boolean", "n long, total double", "update", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Runs a stream to the end of what its source holds; what it wrote as a table in the shared folder.

    Each batch is a folder named by its number, so that a batch that is repeated after a failure
    replaces itself. In complete mode the last batch is the result.
    """
    spark = stream.sparkSession
    path, ids = shared_folder(spark, name), []

    def write(batch: DataFrame, k: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={k}")
        ids.append(k)

    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True).foreachBatch(write).option("checkpointLocation", checkpoint or f"{path}-state")
    writer.start().awaitTermination()
    if not ids:
        return spark.createDataFrame([], stream.schema)
    if mode == "complete":
        return spark.read.schema(stream.schema).parquet(f"{path}/batch={max(ids)}")
    return spark.read.schema(stream.schema).parquet(*[f"{path}/batch={k}" for k in sorted(set(ids))])


def cached(requests: DataFrame, key: str, ttl_hours: float, late: str = "1 hour") -> DataFrame:
    """Requests (key, ts, value) with miss: whether no entry of the key was alive, which then begins one for ttl_hours; entries are state that expires with the watermark."""
    ttl = int(ttl_hours * 3_600_000)

    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows, until, misses = pd.concat(list(frames)).sort_values("ts"), state.get[0] if state.exists else -1, []
        for ms in (t.value // 1_000_000 for t in rows["ts"]):
            misses.append(ms >= until)
            until = ms + ttl if misses[-1] else until
        state.update((until,))
        state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"key": k[0], "ts": rows["ts"], "value": rows["value"], "miss": misses})

    keyed = requests.withWatermark("ts", late).select(F.col(key).cast("string").alias("key"), "ts", "value").groupBy("key")
    return keyed.applyInPandasWithState(run, "key string, ts timestamp, value double, miss boolean", "until long", "append", GroupStateTimeout.EventTimeTimeout)


def cursors(spark: SparkSession, path: str) -> dict[tuple[str, str], str | None]:
    """The next token of each (provider, query) of an earlier run; empty where there is none."""
    if not _exists(spark, path):
        return {}
    rows = spark.read.parquet(path).groupBy("provider", "query").agg(F.max_by("next_token", "page_index").alias("t")).collect()  # a row a provider and query
    return {(r["provider"], r["query"]): r["t"] for r in rows}


def save_cursors(spark: SparkSession, path: str, pages: list[tuple[str, str, int, str | None]]) -> None:
    """Adds (provider, query, page_index, next_token) of pages that are done."""
    spark.createDataFrame(pages, "provider string, query string, page_index int, next_token string").coalesce(1).write.mode("append").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def job_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Job requests that are dropped into a folder as JSON files (job_type, payload), as a stream."""
    return spark.readStream.schema("job_type string, payload string").json(folder)


def serve(requests: DataFrame, jobs, handlers: dict, checkpoint: str) -> int:
    """Submits what a stream of requests holds by now and works it off; each request once, by the checkpoint. Returns the number of jobs done."""
    done = 0

    def run(batch: DataFrame, _: int) -> None:
        nonlocal done
        for r in batch.collect():  # requests of people, a few a batch
            jobs.submit(r["job_type"], json.loads(r["payload"] or "{}"))
        while jobs.work(handlers):
            done += 1

    requests.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return done
