"""Tables that readers see only when they are complete: files first, then one row in a ledger that names them.

A ledger is a Parquet folder to which each commit adds one file. Spark's commit protocol makes that file appear whole or not at
all, so a job that is lost at any point leaves what was published before in force. A commit takes the number after the
last one; of two writers that take the same number at once, one wins for all readers and the other's files stay unread.
Files that no commit names are left where they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_PUBLISHED = "version bigint, build string, tables array<string>"


def record(spark: SparkSession, path: str, row: Sequence, schema: str) -> None:
    """Add one row to the ledger at `path`."""
    spark.createDataFrame([tuple(row)], schema).coalesce(1).write.mode("append").parquet(path)


def recorded(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of the ledger at `path`, none if there is no ledger."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class Build:
    """One version of a set of tables in `folder`, invisible to `published` until `publish` is called."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.build = spark, folder, uuid.uuid4().hex
        self.tables: list[str] = []

    def add(self, name: str, df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """Write a table, partitioned by `by`, and read it back."""
        path = f"{self.folder}/builds/{self.build}/{name}"
        df.write.partitionBy(*by).parquet(path)
        self.tables.append(name)
        return self.spark.read.parquet(path)

    def publish(self) -> int:
        """Make this version the one that readers get; its number."""
        last = recorded(self.spark, f"{self.folder}/ledger", _PUBLISHED).selectExpr("max(version)").first()[0]
        version = (last or 0) + 1
        record(self.spark, f"{self.folder}/ledger", (version, self.build, self.tables), _PUBLISHED)
        return version


def published(spark: SparkSession, folder: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of the last published version, or of `version`, by name; all of them belong to one build."""
    rows = recorded(spark, f"{folder}/ledger", _PUBLISHED)
    chosen = rows if version is None else rows.where(f"version = {version}")
    row = chosen.selectExpr("max_by(struct(build, tables), struct(version, build)) as r").first()["r"]
    if row is None:
        raise FileNotFoundError(f"{folder} has no published version{'' if version is None else f' {version}'}")
    return {name: spark.read.parquet(f"{folder}/builds/{row['build']}/{name}") for name in row["tables"]}
