"""Classification metrics on deterministic scores with many ties."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventwin.operators import metrics as M
from queries.tables import table

YEARS = "case when year(o_orderdate) <= 1998 then 'train' when year(o_orderdate) = 1999 then 'validation' else 'test' end as split"


def scored(spark, d):
    orders = table(spark, d, "orders").selectExpr(
        YEARS, "if(o_orderpriority = '1-URGENT', 1, 0) as label", "floor(o_totalprice / 1000) / 600D as a",
        "(o_custkey % 40 + if(o_orderpriority = '1-URGENT', 5, 0)) / 50D as b")
    return orders.selectExpr("split", "label", "inline(array(struct('a' as model, a as score), struct('b' as model, b as score)))"
                             ).withColumn("prediction", F.expr("if(score > 0.5, 1, 0)"))


def _exact(df, *rounded):
    return df.withColumns({c: F.expr(f"round({c}, 9)") for c in rounded})


def confusion(spark, d):
    return M.confusion(scored(spark, d))


def basics(spark, d):
    return M.precision_recall_f1(M.confusion(scored(spark, d)))


def report(spark, d):
    return _exact(M.class_report(M.confusion(scored(spark, d))), "precision", "recall", "f1")


def areas(spark, d):
    return _exact(M.ranking_areas(scored(spark, d)), "avg_prec")


def roc(spark, d):
    return M.roc_curve(scored(spark, d))


def precision_recall(spark, d):
    return M.precision_recall_curve(scored(spark, d))


def thin(spark, d):
    return M.thin_curve(M.roc_curve(scored(spark, d)), M.GROUP, "fpr", "tpr", 50)


def _table(spark, d):
    return M.evaluate(scored(spark, d), digits=4)


def score_table(spark, d):
    return _table(spark, d)


def _baseline(spark, d):
    orders = table(spark, d, "orders").selectExpr(
        YEARS, "if(o_orderpriority = '1-URGENT', 1, 0) as label_storm", "cast(o_custkey % 40 as double) as bz",
        "if(o_orderkey % 9 = 0, null, o_totalprice) as v")
    return M.evaluate_threshold_rule(orders.where("split = 'validation'"), {"bz": 20.0}, {"v": 250000.0}, split="validation",
                                     digits=4)


def baseline(spark, d):
    return _baseline(spark, d)


def union(spark, d):
    return M.union_scores(_baseline(spark, d), _table(spark, d))


def best(spark, d):
    return M.best_model(_table(spark, d).where("split = 'validation'"))


def variants(spark, d):
    out = M.compare_variants(_table(spark, d).where("split = 'test'"), "a", "b")
    return _exact(out, "delta")


QUERIES = {
    "confusion": confusion, "precision_recall_f1": basics, "class_report": report, "auc_and_average_precision": areas,
    "roc_points": roc, "pr_points": precision_recall, "roc_points_thinned": thin, "score_table": score_table,
    "threshold_baseline": baseline, "score_union": union, "best_model": best, "variant_comparison": variants,
}

_Y = "CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END"
_SPLIT = "CASE WHEN year(o_orderdate) <= 1998 THEN 'train' WHEN year(o_orderdate) = 1999 THEN 'validation' ELSE 'test' END"
_R = f"""r AS (SELECT *, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM (
SELECT 'a' AS model, {_SPLIT} AS split, {_Y} AS label, floor(o_totalprice / 1000) / CAST(600 AS DOUBLE) AS score FROM orders UNION ALL
SELECT 'b', {_SPLIT}, {_Y}, (o_custkey % 40 + 5 * {_Y}) / CAST(50 AS DOUBLE) FROM orders))"""
_C = """c AS (SELECT model, split, count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM {src} GROUP BY ALL)"""
_CR = _C.format(src="r")


def _div(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0)"


_PRF = f"{_div('tp', 'tp + fp')} AS precision, {_div('tp', 'tp + fn')} AS recall, {_div('2 * tp', '2 * tp + fp + fn')} AS f1"
# ranks from below with ties at their mean; precision at each score from running counts
_AREAS = """k AS (SELECT *, rank() OVER (PARTITION BY model, split ORDER BY score)
 + (count(*) OVER (PARTITION BY model, split, score) - 1) / CAST(2 AS DOUBLE) AS mid FROM {src}),
u AS (SELECT model, split, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n,
 sum(mid) FILTER (label = 1) AS ranks FROM k GROUP BY ALL),
g AS (SELECT model, split, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM {src} GROUP BY ALL),
h AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM g WINDOW w AS (PARTITION BY model, split ORDER BY score DESC)),
ap AS (SELECT model, split, sum(CAST(pos AS DOUBLE) / p * (CAST(tp AS DOUBLE) / (tp + fp))) AS avg_prec FROM h JOIN u USING (model, split) GROUP BY ALL),
areas AS (SELECT model, split, (ranks - CAST(p AS DOUBLE) * (p + 1) / 2) / (CAST(p AS DOUBLE) * n) AS auc_roc, avg_prec FROM u JOIN ap USING (model, split))"""
_AR = _AREAS.format(src="r")
_CLASSES = f"""b AS (SELECT model, split, tp + fp + tn + fn AS n, {_div('tp + tn', 'tp + fp + tn + fn')} AS acc,
{_div('tn', 'tn + fn')} AS p0, {_div('tn', 'tn + fp')} AS r0, {_div('2 * tn', '2 * tn + fn + fp')} AS f0, tn + fp AS s0,
{_div('tp', 'tp + fp')} AS p1, {_div('tp', 'tp + fn')} AS r1, {_div('2 * tp', '2 * tp + fp + fn')} AS f1, tp + fn AS s1 FROM c)"""
_SCORES = f"""scores AS (SELECT model, split, round(f1, 4) AS f1_storm, round(precision, 4) AS precision, round(recall, 4) AS recall,
round(auc_roc, 4) AS auc_roc, round(avg_prec, 4) AS avg_prec, tp, fp, tn, fn
FROM (SELECT *, {_PRF} FROM c) JOIN areas USING (model, split))"""
_BASE_ROWS = f"""SELECT 'physics_baseline' AS model, 'validation' AS split, {_Y} AS label, CAST(coalesce(o_custkey % 40 < 20 AND
CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END > 250000, false) AS INTEGER) AS prediction FROM orders
WHERE year(o_orderdate) = 1999"""
_BASELINE = f"""WITH r AS (SELECT *, prediction AS score FROM ({_BASE_ROWS})), {_CR}, {_AR}, {_SCORES}
SELECT model, split, f1_storm, precision, recall, auc_roc, tp, fp, tn, fn, CAST(0 AS BIGINT) AS n_unscored FROM scores"""
_TABLE = f"WITH {_R}, {_CR}, {_AR}, {_SCORES} SELECT *, CAST(0 AS BIGINT) AS n_unscored FROM scores"

ORACLES = {
    "confusion": f"WITH {_R}, {_CR} SELECT * FROM c",
    "precision_recall_f1": f"WITH {_R}, {_CR} SELECT *, {_PRF} FROM c",
    "class_report": f"""WITH {_R}, {_CR}, {_CLASSES}
SELECT model, split, '0' AS class, round(p0, 9) AS precision, round(r0, 9) AS recall, round(f0, 9) AS f1, s0 AS support FROM b
UNION ALL SELECT model, split, '1', round(p1, 9), round(r1, 9), round(f1, 9), s1 FROM b
UNION ALL SELECT model, split, 'accuracy', round(acc, 9), round(acc, 9), round(acc, 9), n FROM b
UNION ALL SELECT model, split, 'macro avg', round((p0 + p1) / 2, 9), round((r0 + r1) / 2, 9), round((f0 + f1) / 2, 9), n FROM b
UNION ALL SELECT model, split, 'weighted avg', round((p0 * s0 + p1 * s1) / n, 9), round((r0 * s0 + r1 * s1) / n, 9),
round((f0 * s0 + f1 * s1) / n, 9), n FROM b""",
    "auc_and_average_precision": f"WITH {_R}, {_AR} SELECT model, split, auc_roc, round(avg_prec, 9) AS avg_prec FROM areas",
    "roc_points": f"""WITH {_R}, {_AR} SELECT model, split, score AS threshold, CAST(fp AS DOUBLE) / n AS fpr, CAST(tp AS DOUBLE) / p AS tpr
FROM h JOIN u USING (model, split) UNION ALL SELECT model, split, NULL, 0, 0 FROM u""",
    "pr_points": f"""WITH {_R}, {_AR} SELECT model, split, score AS threshold, CAST(tp AS DOUBLE) / p AS recall,
CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(p AS DOUBLE) / (p + n) AS no_skill FROM h JOIN u USING (model, split)
UNION ALL SELECT model, split, NULL, 0, 1, CAST(p AS DOUBLE) / (p + n) FROM u""",
    "roc_points_thinned": f"""WITH {_R}, {_AR}, pts AS (SELECT model, split, score AS threshold, CAST(fp AS DOUBLE) / n AS fpr,
CAST(tp AS DOUBLE) / p AS tpr FROM h JOIN u USING (model, split) UNION ALL SELECT model, split, NULL, 0, 0 FROM u),
z AS (SELECT *, least(floor(fpr * 50), 49) AS bin FROM pts),
y AS (SELECT *, row_number() OVER (PARTITION BY model, split, bin ORDER BY tpr, fpr) AS lo,
 row_number() OVER (PARTITION BY model, split, bin ORDER BY tpr DESC, fpr DESC) AS hi FROM z)
SELECT model, split, threshold, fpr, tpr FROM y WHERE lo = 1 OR hi = 1""",
    "score_table": _TABLE,
    "threshold_baseline": _BASELINE,
    "score_union": f"SELECT * FROM ({_TABLE}) UNION ALL BY NAME SELECT * FROM ({_BASELINE})",
    "best_model": f"SELECT * FROM ({_TABLE}) WHERE split = 'validation' ORDER BY f1_storm DESC, model LIMIT 1",
    "variant_comparison": f"""WITH t AS (SELECT * FROM ({_TABLE}) WHERE split = 'test'),
l AS (UNPIVOT (SELECT model, f1_storm, precision, recall, auc_roc FROM t) ON f1_storm, precision, recall, auc_roc INTO NAME metric VALUE value)
SELECT metric, max(value) FILTER (model = 'a') AS "full", max(value) FILTER (model = 'b') AS reduced,
round(max(value) FILTER (model = 'b') - max(value) FILTER (model = 'a'), 9) AS delta FROM l GROUP BY metric""",
}
