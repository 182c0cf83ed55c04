"""Table profiles: rates, histograms, box summaries, correlations, missing values."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from eventwin.operators.clean import column_kinds
from eventwin.operators.scan import _q, _text, _unit, exact_quantiles


def _missing(df: DataFrame, column: str) -> str:
    floating = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    return f"(`{column}` is null or isnan(`{column}`))" if floating else f"(`{column}` is null)"


def _long(df: DataFrame, named: Mapping[str, str]) -> DataFrame:
    cells = ", ".join(f"{_text(name)}, cast({expr} as double)" for name, expr in named.items())
    return df.selectExpr(f"stack({len(named)}, {cells}) as (column, v)").where("v is not null and not isnan(v)")


# rates -----------------------------------------------------------------------------------------

def class_counts(df: DataFrame, label: str = "label_storm") -> DataFrame:
    """Rows per class and each class's share of all labelled rows."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("class")).agg(F.expr("count(1) as n"))
    return counts.selectExpr("class", "n", "cast(n as double) / sum(n) over () as share")  # one row per class


def rate_by(df: DataFrame, period: str, label: str = "label_storm", name: str = "period") -> DataFrame:
    """Rows, positives and positive percentage per value of the SQL expression `period`."""
    rows = df.selectExpr(f"{period} as `{name}`", f"`{label}` as _y").where(f"`{name}` is not null and _y is not null")
    return rows.groupBy(name).agg(F.expr("count(1) as total"), F.expr("sum(cast(_y as bigint)) as storms")).selectExpr(
        f"`{name}`", "total", "storms", "100D * storms / total as storm_rate_pct")


def rate_by_year(df: DataFrame, time: str = "startTime", label: str = "label_storm") -> DataFrame:
    return rate_by(df, f"year(`{time}`)", label, "year")


def rate_by_quantile_bin(df: DataFrame, value: str = "analysis_speed", label: str = "label_storm",
                         bins: int = 5) -> DataFrame:
    """Positive percentage in equal-frequency bins: right-closed, the lowest value in the first bin,
    equal edges merged, empty bins left out."""
    rows = df.selectExpr(f"cast(`{value}` as double) as v", f"`{label}` as y").where(
        "v is not null and not isnan(v) and y is not null")
    edges = exact_quantiles(rows, ["v"], [i / bins for i in range(bins + 1)]).agg(
        F.sort_array(F.collect_set("value"))).scalar()  # bins + 1 numbers
    below = " + ".join(f"if(get(e, {i}) < v, 1, 0)" for i in range(bins + 1))
    placed = rows.withColumn("e", edges).selectExpr("y", "e", f"greatest({below}, 1) as bin")
    return placed.groupBy("bin").agg(
        F.expr("first(get(e, bin - 1)) as lo"), F.expr("first(get(e, bin)) as hi"), F.expr("count(1) as n"),
        F.expr("sum(cast(y as bigint)) as storms")).selectExpr(
        "bin", "lo", "hi", "n", "storms", "100D * storms / n as storm_rate_pct")


# distributions ---------------------------------------------------------------------------------

def histograms(df: DataFrame, columns: Sequence[str] | Mapping[str, str], bins: int = 40) -> DataFrame:
    """Equal-width histograms, each over its own range: (column, bin, lo, hi, n), empty bins included.

    The last bin is closed; a constant column gets a range of width 1 around its value.
    """
    named = dict(columns) if isinstance(columns, Mapping) else {c: f"`{c}`" for c in columns}
    long = _long(df, named)
    # one row per requested column
    bounds = F.broadcast(long.groupBy("column").agg(F.expr("min(v) as a"), F.expr("max(v) as b")).selectExpr(
        "column", "if(a = b, a - 0.5D, a) as lo", "if(a = b, b + 0.5D, b) as hi"))
    counts = long.join(bounds, "column").groupBy(
        "column", F.expr(f"cast(least(floor({_unit('v', 'lo', 'hi')} * {bins}), {bins - 1}) as int) as bin")).agg(
        F.expr("count(1) as c"))
    frame = bounds.selectExpr("*", f"explode(sequence(0, {bins - 1})) as bin")
    return frame.join(counts, ["column", "bin"], "left").selectExpr(
        "column", "bin", f"lo + (hi - lo) * bin / {bins} as lo", f"lo + (hi - lo) * (bin + 1) / {bins} as hi",
        "coalesce(c, 0L) as n")


def _per_class(columns: Sequence[str], label: str, classes: Sequence[int]) -> dict[str, str]:
    return {f"{c}|{k}": f"if(`{label}` = {k}, `{c}`, null)" for c in columns for k in classes}


_SPLIT_NAME = ("substring_index(column, '|', -1)", "left(column, length(column) - length(substring_index(column, '|', -1)) - 1)")


def histogram_by_class(df: DataFrame, column: str = "kp_max_h72", label: str = "label_storm",
                       classes: Sequence[int] = (0, 1), bins: int = 30) -> DataFrame:
    """One histogram per class, each over the range of that class."""
    out = histograms(df, _per_class([column], label, classes), bins)
    return out.selectExpr(f"cast({_SPLIT_NAME[0]} as int) as class", "bin", "lo", "hi", "n")


def _boxes(df: DataFrame, features: Sequence[str], label: str, classes: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    named = _per_class([c for c in features if c in df.columns], label, classes)
    quartiles = exact_quantiles(df, named, [0.25, 0.5, 0.75]).groupBy("column").agg(
        *[F.expr(f"max(if(prob = {p}D, value, null)) as {q}") for p, q in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    fenced = quartiles.selectExpr("*", "q1 - 1.5D * (q3 - q1) as fence_lo", "q3 + 1.5D * (q3 - q1) as fence_hi")
    return _long(df, named), F.broadcast(fenced)  # one row per feature and class


def box_stats(df: DataFrame, features: Sequence[str], label: str = "label_storm",
              classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Quartiles, whiskers (last value within 1.5 IQR) and outlier count per feature and class with data."""
    long, boxes = _boxes(df, features, label, classes)
    out = long.join(boxes, "column").groupBy("column", "q1", "median", "q3").agg(
        F.expr("count(1) as n"),
        F.expr("min(if(v >= fence_lo, v, null)) as a"), F.expr("max(if(v <= fence_hi, v, null)) as b"),
        F.expr("count_if(v < fence_lo or v > fence_hi) as n_outliers"))
    return out.selectExpr(f"{_SPLIT_NAME[1]} as feature", f"cast({_SPLIT_NAME[0]} as int) as class", "n", "q1",
                          "median", "q3", "least(a, q1) as whisker_lo", "greatest(b, q3) as whisker_hi", "n_outliers")


def box_outliers(df: DataFrame, features: Sequence[str], label: str = "label_storm",
                 classes: Sequence[int] = (0, 1)) -> DataFrame:
    """The values beyond the whiskers: (feature, class, value)."""
    long, boxes = _boxes(df, features, label, classes)
    return long.join(boxes, "column").where("v < fence_lo or v > fence_hi").selectExpr(
        f"{_SPLIT_NAME[1]} as feature", f"cast({_SPLIT_NAME[0]} as int) as class", "v as value")


# correlations ----------------------------------------------------------------------------------

def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson r of every column pair over the rows where both have values: (a, b, n, r), a before b.

    r is null where a column is constant. One pass in which every task adds up co-moment matrices and
    emits one row per pair, whatever the number of columns.
    """
    names = list(columns) if columns is not None else column_kinds(df)[0]
    if len(names) < 2:
        raise ValueError("correlations need at least two numeric columns")
    rows = df.selectExpr(*[f"if({_missing(df, c)}, null, cast(`{c}` as double)) as x{i}" for i, c in enumerate(names)])
    centre = rows.agg(F.struct(*[F.avg(f"x{i}").alias(f"x{i}") for i in range(len(names))])).scalar()
    centred = rows.withColumn("m", centre).selectExpr(*[f"x{i} - m.x{i} as x{i}" for i in range(len(names))])
    upper = np.triu_indices(len(names), 1)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            seen = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            s, q = x.T @ seen, (x * x).T @ seen
            part = [seen.T @ seen, s, s.T, q, q.T, x.T @ x]
            total = part if total is None else [t + p for t, p in zip(total, part)]
        if total is not None:
            yield pd.DataFrame({"i": upper[0], "j": upper[1],
                                **{k: m[upper] for k, m in zip(("n", "sx", "sy", "sxx", "syy", "sxy"), total)}})

    schema = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    sums = centred.mapInPandas(moments, schema).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    listed = "array(" + ", ".join(map(_text, names)) + ")"
    spread = "sqrt(greatest(n * sxx - sx * sx, 0D)) * sqrt(greatest(n * syy - sy * sy, 0D))"
    return sums.selectExpr(f"{listed}[i] as a", f"{listed}[j] as b", "cast(n as bigint) as n",
                           f"(n * sxy - sx * sy) / nullif({spread}, 0D) as r")


# missing values --------------------------------------------------------------------------------

def _missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counted = df.agg(F.expr("count(1) as n"), *[F.expr(f"count_if({_missing(df, c)}) as m{i}")
                                                for i, c in enumerate(columns)])
    cells = ", ".join(f"{_text(c)}, m{i}" for i, c in enumerate(columns))
    return counted.selectExpr("n", f"stack({len(columns)}, {cells}) as (column, missing)")


def missing_fraction(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing_fraction), most incomplete first."""
    out = _missing_counts(df, columns or df.columns).selectExpr(
        "column", "cast(missing as double) / nullif(n, 0) as missing_fraction")
    return out.orderBy(F.desc("missing_fraction"), "column")


def top_missing(df: DataFrame, n: int = 25) -> DataFrame:
    return missing_fraction(df).limit(n)


def table_quality(df: DataFrame, label: str = "label_storm") -> DataFrame:
    """One row: mean missing fraction, columns more than half missing, positive rate."""
    rate = df.select(F.avg(F.col(label).cast("double"))).scalar()
    return missing_fraction(df).agg(
        F.expr("avg(missing_fraction) as missing_mean"),
        F.expr("count_if(missing_fraction > 0.5) as cols_over_half_missing")).withColumn("storm_rate", rate)


def imputation_audit(train: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Numeric columns with gaps: (column, n_missing, pct_missing), most gaps first."""
    numeric = list(columns) if columns is not None else column_kinds(train)[0]
    return _missing_counts(train, numeric).where("missing > 0").selectExpr(
        "column", "missing as n_missing", "100D * missing / n as pct_missing").orderBy(F.desc("n_missing"), "column")


# series --------------------------------------------------------------------------------------

def series_points(df: DataFrame, time: str = "time", value: str = "kp", every: str | None = None) -> DataFrame:
    """(time, value) in time order; with `every` (such as '1 day') its n, min, mean and max per step instead."""
    if every is None:
        return df.select(F.col(time).alias("time"), F.col(value).alias("value")).orderBy("time")
    step = F.window(time, every)["start"].alias("time")
    return df.groupBy(step).agg(F.count(value).alias("n"), F.min(value).alias("lo"), F.avg(value).alias("mean"),
                                F.max(value).alias("hi")).orderBy("time")
