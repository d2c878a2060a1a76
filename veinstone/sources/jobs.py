"""Jobs as an append-only table of events: the last event of a job is its state, so that a lost driver loses nothing.

A worker takes the oldest pending job. The folder is written by one worker at a time; several
workers need a store with conditional writes, which a folder of files is not.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinstone.operators.evidence import keep_one

EVENT = "job_id string, seq long, status string, job_type string, payload string, result string, error string, retries int, max_retries int, parent string, at timestamp"
ARTIFACT = "job_id string, name string, path string, at timestamp"


class Jobs:
    """States: PENDING, RUNNING, SUCCEEDED, FAILED."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        for name, schema in (("events", EVENT), ("artifacts", ARTIFACT)):
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.root}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def _append(self, name: str, row: dict, schema: str) -> None:
        columns = [c.split()[0] for c in schema.split(", ")]
        one = self.spark.createDataFrame([tuple(row.get(c) for c in columns)], schema)
        one.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")

    def table(self) -> DataFrame:
        """The state of every job."""
        return keep_one(self._read("events", EVENT), ["job_id"], [F.desc("seq")])

    def get(self, job_id: str) -> dict | None:
        row = self.table().where(F.col("job_id") == job_id).first()
        return row.asDict() if row else None

    def _moved(self, job_id: str, status: str, **changes) -> dict:
        job = self.get(job_id)
        if job is None:
            raise KeyError(f"no job {job_id}")
        job = job | changes | {"status": status, "seq": job["seq"] + 1}
        self._append("events", job, EVENT)
        return job

    def submit(self, job_type: str, payload: dict, max_retries: int = 0, retries: int = 0, parent: str = "") -> str:
        job_id = f"job_{uuid.uuid4().hex[:16]}"
        self._append("events", {"job_id": job_id, "seq": 0, "status": "PENDING", "job_type": job_type, "payload": json.dumps(payload, sort_keys=True), "result": "{}", "error": "", "retries": retries, "max_retries": max_retries, "parent": parent}, EVENT)
        return job_id

    def claim(self) -> dict | None:
        """The oldest pending job, now running; None if there is none."""
        first = self._read("events", EVENT).groupBy("job_id").agg(F.min("at").alias("since"))
        row = self.table().where("status = 'PENDING'").join(first, "job_id").orderBy("since", "job_id").select("job_id").first()
        return self._moved(row["job_id"], "RUNNING") if row else None

    def complete(self, job_id: str, result: dict) -> None:
        self._moved(job_id, "SUCCEEDED", result=json.dumps(result, sort_keys=True), error="")

    def fail(self, job_id: str, error: str) -> None:
        self._moved(job_id, "FAILED", error=error)

    def retry(self, job_id: str) -> str:
        """A new job with the same payload; refused when the retries are used up."""
        job = self.get(job_id)
        if job is None:
            raise KeyError(f"no job {job_id}")
        if job["retries"] >= job["max_retries"]:
            raise ValueError(f"{job_id} has been retried {job['retries']} of {job['max_retries']} times")
        return self.submit(job["job_type"], json.loads(job["payload"]), job["max_retries"], job["retries"] + 1, job_id)

    def add_artifact(self, job_id: str, name: str, path: str) -> None:
        self._append("artifacts", {"job_id": job_id, "name": name, "path": path}, ARTIFACT)

    def artifacts(self, job_id: str) -> DataFrame:
        return keep_one(self._read("artifacts", ARTIFACT).where(F.col("job_id") == job_id), ["name", "path"], [F.asc("at")])

    def work(self, handlers: dict[str, Callable[[dict], dict]]) -> dict | None:
        """Runs the oldest pending job by the handler of its type; a failure is the job's, not the worker's."""
        job = self.claim()
        if job is None:
            return None
        try:
            self.complete(job["job_id"], handlers[job["job_type"]](json.loads(job["payload"])))
        except Exception as e:
            self.fail(job["job_id"], f"{type(e).__name__}: {e}")
        return self.get(job["job_id"])
