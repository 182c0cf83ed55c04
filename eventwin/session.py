"""Session defaults and the shared folder used for durable intermediate results."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "eventwin", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; `conf` overrides any default (use `_` for `.`)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("_", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` of the session.

    Only a master of one process may go without it; there a fresh temporary folder is used.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="eventwin-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def land(df: DataFrame, path: str, *, format: str = "parquet", mode: str = "overwrite") -> DataFrame:
    """Write `df` and read it back: later steps start from the files instead of repeating its plan."""
    writer = df.write.mode(mode)
    (writer.option("header", True).csv if format == "csv" else writer.parquet)(path)
    reader = df.sparkSession.read
    return reader.schema(df.schema).csv(path, header=True) if format == "csv" else reader.parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder, for tables that several jobs will read.

    Unlike a cache it survives lost executors, and unlike a checkpoint it stays columnar.
    """
    return land(df, f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}", mode="errorifexists")
