"""Imputation, scaling and encoding, fitted on training rows only.

Fitting collects a few numbers per column; applying is one projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from math import isfinite

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventwin.operators.clean import column_kinds, levels_of
from eventwin.operators.scan import _q, exact_quantiles

_SCHEMA = ("position int, column string, kind string, scaled boolean, median double, mean double, std double, "
           "mode string, levels array<string>")


@dataclass(frozen=True)
class ColumnFit:
    """What was learned about one column. Numeric: median, mean, std. Categorical: mode, levels."""

    column: str
    kind: str
    scaled: bool = False
    median: float | None = None
    mean: float | None = None
    std: float | None = None
    mode: str | None = None
    levels: list[str] = field(default_factory=list)

    def outputs(self) -> list[tuple[str, Column]]:
        """(output name, value)"""
        given = F.col(f"`{self.column}`")
        if self.kind == "categorical":
            value = F.coalesce(given.cast("string"), F.lit(self.mode))
            return [(f"{self.column}_{v}", F.when(value == v, 1.0).otherwise(0.0)) for v in self.levels]
        value = F.coalesce(F.nanvl(given.cast("double"), F.lit(None)), F.lit(self.median))
        if self.scaled:
            value = (value - F.lit(self.mean)) / F.lit(self.std or 1.0)
        return [(self.column, value)]


@dataclass(frozen=True)
class Preprocessor:
    columns: tuple[ColumnFit, ...]

    @property
    def feature_names(self) -> list[str]:
        return [name for c in self.columns for name, _ in c.outputs()]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """`keep` columns as they are, then every output feature; other columns are dropped."""
        return df.select(*_q(keep), *[value.alias(name) for c in self.columns for name, value in c.outputs()])

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, *asdict(c).values()) for i, c in enumerate(self.columns)]
        spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Preprocessor":
        rows = spark.read.schema(_SCHEMA).parquet(path).orderBy("position").drop("position").collect()
        return cls(tuple(ColumnFit(**row.asDict()) for row in rows))


def medians(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians; columns without any value are absent from the result."""
    return {r["column"]: r["value"] for r in exact_quantiles(train, columns, [0.5]).collect()} if columns else {}


def most_frequent(train: DataFrame, column: str) -> str | None:
    """The commonest value as text, the smallest of equally common ones."""
    top = train.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("v")).count().orderBy(
        F.desc("count"), "v").limit(1).collect()
    return top[0]["v"] if top else None


def fit_preprocessor(train: DataFrame, features: Sequence[str], *, scale: bool = True, max_levels: int | None = None
                     ) -> Preprocessor:
    """Median imputation and (optionally) standardisation of numeric columns with the population
    deviation, a constant column being divided by 1; commonest-value imputation and one-hot encoding
    of categorical ones. A column without any training value is left out; infinite training values are an
    error, and so are more categories of a column than `max_levels`, if given."""
    numeric, categorical = column_kinds(train, features)
    middle = medians(train, numeric)
    numeric = [c for c in numeric if c in middle]
    fits: dict[str, ColumnFit] = {}
    if numeric:
        filled = train.selectExpr(*[f"coalesce(nanvl(cast(`{c}` as double), null), double('{middle[c]!r}')) as x{i}"
                                    for i, c in enumerate(numeric)])
        stats = filled.agg(*[F.expr(f"avg(x{i}) as m{i}") for i in range(len(numeric))],
                           *[F.expr(f"stddev_pop(x{i}) as s{i}") for i in range(len(numeric))]).first()
        endless = [c for i, c in enumerate(numeric) if not (isfinite(stats[f"m{i}"]) and isfinite(stats[f"s{i}"]) and isfinite(middle[c]))]
        if endless:
            raise ValueError(f"infinite training values in {endless}")
        for i, c in enumerate(numeric):
            fits[c] = ColumnFit(c, "numeric", scale, middle[c], stats[f"m{i}"], stats[f"s{i}"])
    for c in categorical:
        mode = most_frequent(train, c)
        if mode is not None:
            texts = train.select(F.col(c).cast("string").alias(c))
            fits[c] = ColumnFit(c, "categorical", mode=mode, levels=levels_of(texts, c, max_levels))
    return Preprocessor(tuple(fits[c] for c in [*numeric, *categorical] if c in fits))
