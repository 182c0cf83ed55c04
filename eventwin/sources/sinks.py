"""Tables written by the pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from eventwin.operators.split import split_summary
from eventwin.session import land, staged  # noqa: F401  (also known by this module)
from eventwin.sources.versions import Build


def write_splits(matrix: DataFrame, folder: str, features: Sequence[str], *, label: str = "label_storm",
                 year: str = "year") -> None:
    """`matrix/` partitioned by split, `features/` with the ordered names, `summary/` with one row per split."""
    spark = matrix.sparkSession
    matrix.write.mode("overwrite").partitionBy("split").parquet(f"{folder}/matrix")
    names = spark.createDataFrame(list(enumerate(features)), "position int, feature string")
    names.coalesce(1).write.mode("overwrite").parquet(f"{folder}/features")
    summary = split_summary(spark.read.parquet(f"{folder}/matrix"), features, label=label, year=year)
    summary.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/summary")


def publish_splits(matrix: DataFrame, folder: str, features: Sequence[str], *, label: str = "label_storm",
                   year: str = "year") -> int:
    """The tables of `write_splits` as one version, which `versions.published` returns whole; its number.

    A run that is lost on the way leaves the version before in force.
    """
    build = Build(matrix.sparkSession, folder)
    names = matrix.sparkSession.createDataFrame(list(enumerate(features)), "position int, feature string")
    written = build.add("matrix", matrix, ["split"])
    build.add("features", names.coalesce(1))
    build.add("summary", split_summary(written, features, label=label, year=year).coalesce(1))
    return build.publish()


def write_scores(scores: DataFrame, path: str) -> None:
    """A score table as one CSV file (a row per model and split)."""
    scores.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
