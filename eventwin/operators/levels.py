"""Categories with any number of levels: their positions in sorted order, and rows as positions or sparse vectors.

`prep.fit_preprocessor` makes a column of every level, so its levels pass through the driver. Here the levels are a table
that is cut by ranges and looked up by a join; only one row per column (its size and commonest level) is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eventwin.operators.clean import require
from eventwin.operators.scan import _q, _text
from eventwin.session import land, staged


@dataclass(frozen=True)
class Levels:
    """`table` (column, level, n, position): each column's levels, how often they occur, their positions from 0 in UTF-8 order."""

    table: DataFrame
    columns: tuple[str, ...]
    sizes: dict[str, int]
    modes: dict[str, str]

    @property
    def width(self) -> int:
        return sum(self.sizes.values())

    def positions(self, df: DataFrame) -> DataFrame:
        """`df` with the position of its level in place of each column, as BIGINT.

        A missing value counts as the commonest training level (the smallest of equally common ones), an unseen
        level has a null position. Each column is a join with its part of the table, which adaptive execution
        broadcasts if it turns out small and whose hot levels it may split.
        """
        require(df, self.columns, "table to encode")
        for i, c in enumerate(self.columns):
            known = self.table.where(f"column = {_text(c)}").selectExpr("level as _level", f"position as _position{i}")
            value = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(self.modes[c]))
            df = df.withColumn("_level", value).join(known, "_level", "left").drop("_level")
        found = {c: f"_position{i} as `{c}`" for i, c in enumerate(self.columns)}
        return df.selectExpr(*[found.get(c, f"`{c}`") for c in df.columns if c not in {f"_position{i}" for i in range(len(self.columns))}])

    def vectors(self, df: DataFrame, name: str = "levels") -> DataFrame:
        """`df` with one sparse vector of `width` places for its columns, which are dropped; unseen levels have no place."""
        if not self.columns:
            raise ValueError("no column has a level")
        numbered, flags = [f"_n{i}" for i in range(len(self.columns))], [f"_f{i}" for i in range(len(self.columns))]
        coded = self.positions(df).withColumns(
            {n: F.coalesce(f"`{c}`", F.lit(self.sizes[c])).cast("double") for n, c in zip(numbered, self.columns)}).drop(*self.columns)
        # the encoder learns the sizes from one row of last positions; what lies beyond is unseen and gets no place
        last = df.sparkSession.range(1).select(*[F.lit(float(self.sizes[c] - 1)).alias(n) for n, c in zip(numbered, self.columns)])
        encoder = OneHotEncoder(inputCols=numbered, outputCols=flags, handleInvalid="keep", dropLast=True).fit(last)
        return VectorAssembler(inputCols=flags, outputCol=name).transform(encoder.transform(coded)).drop(*numbered, *flags)

    def save(self, path: str) -> None:
        land(self.table, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Levels":
        return cls.of(spark.read.parquet(path))

    @classmethod
    def of(cls, table: DataFrame) -> "Levels":
        rows = table.groupBy("column").agg(F.count(F.lit(1)).alias("size"), F.min_by("level", F.struct(-F.col("n"), "level")).alias("mode"),
                                           F.min("place").alias("place")).orderBy("place").collect()
        return cls(table, tuple(r["column"] for r in rows), {r["column"]: r["size"] for r in rows}, {r["column"]: r["mode"] for r in rows})


def fit_levels(train: DataFrame, columns: Sequence[str]) -> Levels:
    """The levels of `columns` as text. A column without any value has none and is left out.

    One pass counts the levels of all columns, combined before the shuffle. The counts are cut into ranges in
    sorted order and written once, so ranges stay as they are when a task runs again; a position is the rank inside
    a range plus the sizes of the ranges before it.
    """
    require(train, columns, "training table")
    if not columns:
        raise ValueError("no columns to fit")
    cells = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("level"))
                      for i, c in enumerate(columns)])
    counts = train.select(F.inline(cells)).where("level is not null").groupBy("place", "column", "level").agg(F.count(F.lit(1)).alias("n"))
    ranges = staged(counts.repartitionByRange("place", "level").withColumn("_range", F.spark_partition_id()), "level-ranges")
    sizes = ranges.groupBy("place", "_range").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.partitionBy("place").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("place", "_range", F.coalesce(before, F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("place", "_range").orderBy("level"))
    ranked = ranges.withColumn("_rank", rank).join(starts, ["place", "_range"])
    table = ranked.select("place", "column", "level", "n", (F.col("_before") + F.col("_rank") - 1).alias("position"))
    return Levels.of(staged(table, "levels"))

