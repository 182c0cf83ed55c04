"""Checks of a prepared table before training, as rows that can be stored or enforced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from eventwin.operators.scan import _q, _text
from eventwin.operators.split import SPLITS

# Name fragments that betray the label.
LEAK_PATTERNS = ("kp_max_h72", "label_storm", "kp_")


class CheckFailed(ValueError):
    pass


def leaky_names(df: DataFrame, features: Sequence[str], patterns: Sequence[str] = LEAK_PATTERNS) -> DataFrame:
    """(column, pattern) for every feature name that contains a pattern."""
    hits = [(c, p) for c in features for p in patterns if p in c]
    return df.sparkSession.createDataFrame(hits, "column string, pattern string")


def null_counts(df: DataFrame, features: Sequence[str], by: str = "split") -> DataFrame:
    """Features with missing values: (split, column, n_missing)."""
    counts = df.groupBy(*_q([by])).agg(*[F.expr(f"count_if(`{c}` is null or isnan(`{c}`)) as n{i}")
                                         for i, c in enumerate(features)])
    cells = ", ".join(f"{_text(c)}, n{i}" for i, c in enumerate(features))
    return counts.selectExpr(f"`{by}`", f"stack({len(features)}, {cells}) as (column, n_missing)").where("n_missing > 0")


def check_splits(df: DataFrame, features: Sequence[str], *, label: str = "label_storm", by: str = "split",
                 splits: Sequence[str] = SPLITS) -> DataFrame:
    """(check, split, value, passed) for every split that is expected or there, from one pass over the table.

    Checks: rows (an expected split without any fails), how many of the features the table has, missing and
    infinite values of those, labels other than 0/1, and the positive rate, which only warns (passed is null
    outside 0.1..0.9).
    """
    held = [c for c in features if c in df.columns]
    missing = " + ".join(["0L", *(f"if(`{c}` is null or isnan(`{c}`), 1L, 0L)" for c in held)])
    infinite = " + ".join(["0L", *(f"if(abs(`{c}`) = double('infinity'), 1L, 0L)" for c in held)])
    per_split = df.groupBy(F.col(by).alias("split")).agg(
        F.expr("count(1) as n"), F.expr(f"sum({missing}) as missing"), F.expr(f"sum({infinite}) as infinite"),
        F.expr(f"count_if(`{label}` is null or `{label}` not in (0, 1)) as odd"),
        F.expr(f"avg(cast(`{label}` as double)) as rate"))
    expected = df.sparkSession.createDataFrame([(s,) for s in splits], "split string")
    every = expected.join(per_split, "split", "full").fillna(0, ["n", "missing", "infinite", "odd"])
    return every.selectExpr(
        "split",
        "stack(6, 'rows', cast(n as double), n > 0,"
        f" 'features', {float(len(held))!r}D, {str(len(held) == len(features)).lower()},"
        " 'missing values', cast(missing as double), missing = 0,"
        " 'infinite values', cast(infinite as double), infinite = 0,"
        " 'labels not 0/1', cast(odd as double), odd = 0,"
        " 'positive rate', rate, if(rate between 0.1 and 0.9, true, null)) as (check, value, passed)"
    ).select("check", "split", "value", "passed")


def enforce(report: DataFrame) -> bool:
    """True if no check failed, else raise with every failure (a report has six rows per split)."""
    failed = [f"{r['check']} in {r['split']}: {r['value']:g}" for r in report.where("passed = false").collect()]
    if failed:
        raise CheckFailed("; ".join(failed))
    return True
