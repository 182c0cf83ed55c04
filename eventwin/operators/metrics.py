"""Classification metrics over (label, prediction, score) rows, for many models and splits at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from eventwin.operators.scan import _q, _text, running_totals

GROUP = ("model", "split")
_FIRST = "pos_before + neg_before = 0"  # no rows have a higher score


def threshold_rule(df: DataFrame, below: Mapping[str, float], above: Mapping[str, float],
                   name: str = "prediction") -> DataFrame:
    """1 where every column lies beyond its limit, else 0; missing values count as not beyond."""
    missing = [c for c in [*below, *above] if c not in df.columns]
    if missing:
        raise KeyError(f"threshold rule needs column(s) {missing}")
    tests = [F.col(c) < F.lit(v) for c, v in below.items()] + [F.col(c) > F.lit(v) for c, v in above.items()]
    return df.withColumn(name, F.coalesce(reduce(Column.__and__, tests), F.lit(False)).cast("int"))


def confusion(df: DataFrame, by: Sequence[str] = GROUP, label: str = "label",
              prediction: str = "prediction") -> DataFrame:
    """tp, fp, tn, fn per group."""
    def n(y: int, p: int, name: str) -> Column:
        return F.expr(f"count_if(`{label}` = {y} and `{prediction}` = {p}) as {name}")
    return df.groupBy(*_q(by)).agg(n(1, 1, "tp"), n(0, 1, "fp"), n(0, 0, "tn"), n(1, 0, "fn"))


def _ratio(top: str, bottom: str) -> str:
    return f"coalesce(cast({top} as double) / nullif({bottom}, 0), 0D)"


def precision_recall_f1(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 of the positive class from confusion counts; 0 where undefined."""
    return counts.selectExpr(
        "*",
        f"{_ratio('tp', 'tp + fp')} as precision",
        f"{_ratio('tp', 'tp + fn')} as recall",
        f"{_ratio('2 * tp', '2 * tp + fp + fn')} as f1",
    )


def class_report(counts: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """Per class and averaged precision, recall, F1 and support, as one row per (group, class)."""
    rows = ", ".join([
        f"struct('0' as class, {_ratio('tn', 'tn + fn')} as precision, {_ratio('tn', 'tn + fp')} as recall, "
        f"{_ratio('2 * tn', '2 * tn + fn + fp')} as f1, tn + fp as support)",
        f"struct('1' as class, {_ratio('tp', 'tp + fp')} as precision, {_ratio('tp', 'tp + fn')} as recall, "
        f"{_ratio('2 * tp', '2 * tp + fp + fn')} as f1, tp + fn as support)",
    ])
    two = counts.selectExpr("*", f"array({rows}) as c").selectExpr(
        *_q(by), "c", "c[0] as a", "c[1] as b", "tp + fp + tn + fn as n",
        f"{_ratio('tp + tn', 'tp + fp + tn + fn')} as accuracy")
    measures = ("precision", "recall", "f1")
    macro = ", ".join(f"(a.{m} + b.{m}) / 2D as {m}" for m in measures)
    weighted = ", ".join(f"(a.{m} * a.support + b.{m} * b.support) / n as {m}" for m in measures)
    averages = (f"struct('accuracy' as class, accuracy as precision, accuracy as recall, accuracy as f1, n as support), "
                f"struct('macro avg' as class, {macro}, n as support), "
                f"struct('weighted avg' as class, {weighted}, n as support)")
    return two.selectExpr(*_q(by), f"inline(concat(c, array({averages})))")


def _counts(df: DataFrame, by: Sequence[str], label: str, score: str, prediction: str | None = None) -> DataFrame:
    """Positives and negatives per group, score (and prediction): all that the metrics need of the rows."""
    known = df.where(f"`{score}` is not null and not isnan(`{score}`) and `{label}` is not null")
    extra = [F.expr(f"`{prediction}` as prediction")] if prediction else []
    return known.groupBy(*_q(by), F.expr(f"cast(`{score}` as double) as threshold"), *extra).agg(
        F.expr(f"count_if(`{label}` = 1) as pos"), F.expr(f"count_if(`{label}` = 0) as neg"))


def _steps(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    steps = counts.groupBy(*_q(by), "threshold").agg(
        F.expr("sum(pos) as pos"), F.expr("sum(neg) as neg"))
    ranked = running_totals(steps, "threshold", ["pos", "neg"], by=by, descending=True)
    return ranked.selectExpr(*_q(by), "threshold", "pos", "neg", "pos_before", "neg_before", "pos_before + pos as tp",
                             "neg_before + neg as fp", "pos_total as p", "neg_total as n")


def score_steps(df: DataFrame, by: Sequence[str] = GROUP, label: str = "label", score: str = "score"
                ) -> DataFrame:
    """One row per group and distinct score, from the highest score down.

    `pos`, `neg` count rows with this score; `tp`, `fp` count rows with this score or a higher one;
    `p`, `n` are the group's totals.
    """
    return _steps(_counts(df, by, label, score), by)


def _areas(steps: DataFrame, by: Sequence[str]) -> DataFrame:
    # pairs are counted in DECIMAL: exact whatever the order of addition
    pairs = "sum(cast(neg as decimal(19,0)) * (2 * pos_before + pos))"
    return steps.groupBy(*_q(by)).agg(
        F.expr(f"cast({pairs} as double) / nullif(2D * first(p) * first(n), 0D) as auc_roc"),
        F.expr("if(first(p) > 0, sum(cast(pos as double) / nullif(p, 0) * (cast(tp as double) / (tp + fp))), 0D) as avg_prec"),
    )


def ranking_areas(df: DataFrame, by: Sequence[str] = GROUP, **kwargs) -> DataFrame:
    """Exact ROC AUC (ties count half; null with one class only) and average precision per group."""
    return _areas(score_steps(df, by, **kwargs), by)


def roc_curve(df: DataFrame, by: Sequence[str] = GROUP, **kwargs) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score plus the origin (threshold null)."""
    point = "struct(threshold, cast(fp as double) / nullif(n, 0) as fpr, cast(tp as double) / nullif(p, 0) as tpr)"
    origin = "struct(cast(null as double) as threshold, 0D as fpr, 0D as tpr)"
    return score_steps(df, by, **kwargs).selectExpr(*_q(by), f"inline(if({_FIRST}, array({origin}, {point}), array({point})))")


def precision_recall_curve(df: DataFrame, by: Sequence[str] = GROUP, **kwargs) -> DataFrame:
    """(threshold, recall, precision, no_skill) for every distinct score plus recall 0 (threshold null)."""
    skill = "cast(p as double) / (p + n) as no_skill"
    point = f"struct(threshold, cast(tp as double) / nullif(p, 0) as recall, cast(tp as double) / (tp + fp) as precision, {skill})"
    start = f"struct(cast(null as double) as threshold, 0D as recall, 1D as precision, {skill})"
    return score_steps(df, by, **kwargs).selectExpr(*_q(by), f"inline(if({_FIRST}, array({start}, {point}), array({point})))")


def thin_curve(curve: DataFrame, by: Sequence[str], x: str, y: str, bins: int = 200) -> DataFrame:
    """The points with lowest and highest `y` in each of `bins` equal steps of `x` (in 0..1), for drawing."""
    columns = f"struct({', '.join(_q(curve.columns))})"
    cells = curve.groupBy(*_q(by), F.expr(f"cast(least(floor(`{x}` * {bins}), {bins - 1}) as int) as _bin")).agg(
        F.expr(f"array_distinct(array(min_by({columns}, struct(`{y}`, `{x}`)), max_by({columns}, struct(`{y}`, `{x}`)))) as _points"))
    return cells.selectExpr("inline(_points)")


def evaluate(df: DataFrame, by: Sequence[str] = GROUP, label: str = "label", prediction: str = "prediction",
             score: str = "score", digits: int | None = None) -> DataFrame:
    """The score table: model, split, f1_storm, precision, recall, auc_roc, avg_prec, tp, fp, tn, fn, n_unscored.

    Rows without a label or with a null or NaN score enter no figure but `n_unscored`.
    """
    lacking = f"`{score}` is null or isnan(`{score}`) or `{label}` is null"
    every = df.groupBy(*_q(by)).agg(F.expr(f"count_if({lacking}) as n_unscored"))
    counts = _counts(df, by, label, score, prediction)
    cells = [F.expr(f"sum(if(prediction = {p}, {side}, 0L)) as {name}")
             for name, side, p in (("tp", "pos", 1), ("fp", "neg", 1), ("tn", "neg", 0), ("fn", "pos", 0))]
    basics = precision_recall_f1(counts.groupBy(*_q(by)).agg(*cells))
    areas = _areas(_steps(counts, by), by)

    def shown(name: str, source: str) -> str:
        return f"round({source}, {digits}) as {name}" if digits is not None else f"{source} as {name}"

    measured = every.join(basics, list(by), "left").join(areas, list(by), "left")
    return measured.selectExpr(
        *_q(by), shown("f1_storm", "f1"), shown("precision", "precision"), shown("recall", "recall"),
        shown("auc_roc", "auc_roc"), shown("avg_prec", "avg_prec"), "tp", "fp", "tn", "fn", "n_unscored")


def evaluate_threshold_rule(df: DataFrame, below: Mapping[str, float], above: Mapping[str, float], *,
                            label: str = "label_storm", model: str = "physics_baseline", split: str = "val",
                            digits: int | None = None) -> DataFrame:
    """Score row of the threshold rule on raw-unit columns; its 0/1 prediction is also its score."""
    ruled = threshold_rule(df, below, above).selectExpr(
        f"{_text(model)} as model", f"{_text(split)} as split", f"`{label}` as label", "prediction", "prediction as score")
    return evaluate(ruled, digits=digits).drop("avg_prec")


def union_scores(*tables: DataFrame) -> DataFrame:
    """Score tables stacked by column name; columns a table lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def best_model(scores: DataFrame, metric: str = "f1_storm") -> DataFrame:
    """The row with the highest metric; equal metrics go to the first model name."""
    return scores.orderBy(F.col(metric).desc_nulls_last(), *[c for c in GROUP if c in scores.columns]).limit(1)


def compare_variants(scores: DataFrame, full: str, reduced: str,
                     metrics: Sequence[str] = ("f1_storm", "precision", "recall", "auc_roc")) -> DataFrame:
    """Two models side by side: metric, full, reduced, delta."""
    cells = ", ".join(f"{_text(m)}, cast(`{m}` as double)" for m in metrics)
    long = scores.selectExpr("model", f"stack({len(metrics)}, {cells}) as (metric, value)")
    wide = long.where(F.col("model").isin(full, reduced)).groupBy("metric").agg(
        F.max(F.when(F.col("model") == full, F.col("value"))).alias("full"),
        F.max(F.when(F.col("model") == reduced, F.col("value"))).alias("reduced"))
    return wide.selectExpr("*", "reduced - full as delta")
