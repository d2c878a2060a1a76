"""Session for local runs and tests; on a cluster the submitted configuration stands."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(cpus: int | str = "*", app: str = "veinstone", **conf: str) -> SparkSession:
    """A local session with adaptive execution, UTC and Arrow; conf adds or overrides settings."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
    } | conf
    return SparkSession.builder.master(f"local[{cpus}]").appName(app).config(map=settings).getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares (spark.checkpoint.dir). Only a local master may do without one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='veinstone-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/veinstone-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, which is deleted when the driver ends: what iterates reads it instead of a growing plan."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def looked_up(df: DataFrame, name: str, rows: int = 1 << 19) -> DataFrame:
    """df stored, to be joined with a larger table: broadcast if it has at most so many rows, so that the larger one is not shuffled."""
    out = stored(df, name)
    return F.broadcast(out) if out.count() <= rows else out
