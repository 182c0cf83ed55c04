"""Splits by calendar year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from eventwin.operators.clean import require

SPLITS = ("train", "validation", "test")


def assign_split(df: DataFrame, *, year: str = "year", train_end: int = 2020, val_year: int = 2021,
                 test_start: int = 2022, keep_excluded: bool = False) -> DataFrame:
    """Add `split`: train up to `train_end`, validation in `val_year`, test from `test_start`.

    Rows in the gaps between are dropped unless `keep_excluded`, which leaves their split null.
    """
    require(df, [year], "split")
    if not train_end < val_year < test_start:
        raise ValueError("split years must satisfy train_end < val_year < test_start")
    out = df.withColumn("split", F.expr(
        f"case when `{year}` <= {train_end} then 'train' when `{year}` = {val_year} then 'validation' "
        f"when `{year}` >= {test_start} then 'test' end"))
    return out if keep_excluded else out.where("split is not null")


def excluded_rows(df: DataFrame, **years: int) -> DataFrame:
    """One row: how many rows lie outside all splits."""
    return assign_split(df, keep_excluded=True, **years).agg(F.expr("count_if(split is null) as n_excluded"))


def split_summary(df: DataFrame, features: Sequence[str], *, label: str = "label_storm", year: str = "year"
                  ) -> DataFrame:
    """Per split, empty ones too: rows, features, positives, positive rate, first and last year, share of all rows."""
    rows = df.groupBy("split").agg(
        F.expr("count(1) as n_rows"), F.expr(f"sum(cast(`{label}` as bigint)) as n_storms"),
        F.expr(f"min(`{year}`) as year_min"), F.expr(f"max(`{year}`) as year_max"))
    named = df.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    every = named.join(rows, "split", "full").fillna(0, ["n_rows", "n_storms"])
    return every.selectExpr("split", "n_rows", f"{len(features)} as n_features", "n_storms",
                           "round(cast(n_storms as double) / nullif(n_rows, 0), 4) as storm_rate", "year_min", "year_max",
                           "round(100D * n_rows / nullif(sum(n_rows) over (), 0), 1) as pct_of_rows")  # one row per split
