"""Training, ablation and tree attribution: SQL checks the counts, weights and closed forms, the tests the rest.

Fits on one feature of two values have closed forms: their scores, score tables and ablation are compared value by value.

Fits are small (8 rounds, 10 trees), named so in the README; the defaults of `eventwin.operators.models` are the full sizes.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from eventwin.operators import attribution as A, models as M
from eventwin.operators.prep import fit_preprocessor
from eventwin.operators.split import assign_split
from eventwin.sources.sinks import staged
from queries.preparation import YEARS
from queries.tables import table

FEATURES = ("price", "items", "quantity", "discount", "late", "cust")
DROPPED = ("late",)


def matrix(spark, d):
    """Orders with totals of their items; the label leans on two of the features."""
    items = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        {"l_quantity": "sum", "l_discount": "avg", "l_shipdate": "max", "l_linenumber": "count"})
    joined = table(spark, d, "orders").join(items.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
    rows = joined.selectExpr(
        "o_orderkey", "year(o_orderdate) as year", "o_totalprice as price", "cast(`count(l_linenumber)` as double) as items",
        "`sum(l_quantity)` as quantity", "`avg(l_discount)` as discount",
        "cast(datediff(`max(l_shipdate)`, o_orderdate) as double) as late", "cast(o_custkey as double) as cust",
        "if(coalesce(datediff(`max(l_shipdate)`, o_orderdate), 0) > 600 or o_totalprice > 430000, 1, 0) as label_storm")
    split = staged(assign_split(rows, **YEARS), "orders")
    fitted = fit_preprocessor(split.where("split = 'train'"), FEATURES)
    return fitted.transform(split, keep=["o_orderkey", "split", "label_storm"])


def _train(m):
    return m.where("split = 'train'")


def _counted(model, m, name):
    """What SQL can tell of a score table: rows and positives that its counts add up to, per split, and the weights of the fit."""
    w0, w1 = model.class_weights
    return M.score_model(model, m, name).selectExpr(
        "model", "split", "tp + fp + tn + fn as n_rows", "tp + fn as positives", f"{w0!r}D as weight_0", f"{w1!r}D as weight_1",
        "auc_roc > 0.5 as better_than_chance")


def logistic(spark, d):
    m = matrix(spark, d)
    return _counted(M.fit_logistic(_train(m), FEATURES), m, "logistic_regression")


def forest(spark, d):
    m = matrix(spark, d)
    return _counted(M.fit_forest(_train(m), FEATURES, trees=10, depth=5), m, "random_forest")


def boosted(spark, d):
    m = matrix(spark, d)
    return _counted(M.fit_boosted(_train(m), FEATURES, rounds=8, depth=3), m, "boosted_trees")


def ablated(spark, d):
    """Rows and positives behind both score rows, and whether the comparison is their difference."""
    m = matrix(spark, d)
    fit = lambda train, kept: M.fit_boosted(train, kept, rounds=5, depth=3)
    scores, compared = M.ablation(_train(m), m.where("split = 'test'"), FEATURES, DROPPED, fit)
    f1 = compared.where("metric = 'f1_storm'").select("full", "reduced", "delta")
    return scores.crossJoin(f1).selectExpr(  # one row
        "model", "tp + fp + tn + fn as n_rows", "tp + fn as positives",
        "f1_storm = if(model = 'full', full, reduced) and abs(delta - (reduced - full)) < 1e-12 as compared")


def tree_importance(spark, d):
    """Per feature: how many rows were explained, and whether base and attributions add up to the model's margin."""
    m = matrix(spark, d)
    model = M.fit_boosted(_train(m), FEATURES, rounds=8, depth=3)
    rows = staged(A.tree_attribution(M.predict(model, _train(m)), model, FEATURES, ["score"]), "attributed")
    total = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.expr(
        "max(abs(base + aggregate(phi, 0D, (s, x) -> s + x) - 0.5 * ln(score / (1 - score)))) < 1e-8 as adds_up"))
    return A.importance(rows, FEATURES).crossJoin(total).selectExpr(  # one row
        "feature", "mean_abs_shap >= 0 as valued", f"rank between 1 and {len(FEATURES)} as ranked", "n_rows", "adds_up")


def tree_dependence(spark, d):
    m = matrix(spark, d)
    model = M.fit_forest(_train(m), FEATURES, trees=5, depth=4)
    rows = A.tree_attribution(_train(m), model, FEATURES, ["o_orderkey"])
    return A.dependence(rows, FEATURES, "late", "price").selectExpr(
        "count(value) as n", "count(colour) as n_colour", "round(avg(value), 6) + 0D as mean", "bool_and(abs(attribution) <= 1) as bounded")


def stump(spark, d):
    """One tree with one split on a binary feature: its attributions have a closed form."""
    rows = table(spark, d, "orders").selectExpr("o_orderkey", "if(o_orderstatus = 'F', 1D, 0D) as closed",
                                                "if(o_totalprice > 200000 or o_orderstatus = 'F' and o_orderkey % 3 = 0, 1, 0) as label_storm")
    rows = staged(rows, "stump")
    model = M.fit_boosted(rows, ["closed"], rounds=1, depth=1, rows=1.0, columns=1.0, positive_weight=2.0)
    return A.tree_attribution(rows, model, ["closed"], ["o_orderkey"]).selectExpr(
        "o_orderkey", "closed", "round(phi[0], 9) + 0D as phi", "round(base, 9) as base")


def _binary(spark, d):
    """Orders by year with one feature of two values, on which fits have closed forms, and one that tells nothing."""
    rows = table(spark, d, "orders").selectExpr(
        "year(o_orderdate) as year", "if(o_orderstatus = 'F', 1D, 0D) as closed", "0D as flat",
        "if(o_totalprice > 200000 or o_orderstatus = 'F' and o_orderkey % 3 = 0, 1, 0) as label_storm")
    return staged(assign_split(rows, **YEARS), "binary")


def _stump(train, features, **options):
    return M.fit_boosted(train, features, rounds=1, depth=1, rows=1.0, columns=1.0, **options)


def _fits(m):
    """Both classes weigh the same in both fits; the logistic one has next to no penalty."""
    return {"logistic_regression": M.fit_logistic(_train(m), ["closed"], c=1e9), "boosted_trees": _stump(_train(m), ["closed"])}


def fitted_scores(spark, d):
    """Whole score tables of fits with closed forms, for all splits."""
    m = _binary(spark, d)
    scores = M.compare_models(_fits(m), m)
    return scores.selectExpr("model", "split", *[f"round({c}, 9) + 0D as {c}" for c in MEASURES], "tp", "fp", "tn", "fn", "n_unscored")


def fitted_predictions(spark, d):
    """Scores of every row's kind, in thousandths, and what they predict."""
    m = _binary(spark, d)
    rows = [M.predict(model, m).withColumn("model", F.lit(name)) for name, model in _fits(m).items()]
    return rows[0].unionByName(rows[1]).groupBy("model", "split", "closed", F.expr("round(score, 3) + 0D as score"), "prediction").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("label_storm").alias("positives"))


def ablation_values(spark, d):
    """The comparison of a fit with and without the one feature that tells something, over test rows."""
    m = _binary(spark, d)
    fit = lambda train, kept: _stump(train, kept, positive_weight=2.0)
    _, compared = M.ablation(_train(m), m.where("split = 'test'"), ["closed", "flat"], ["closed"], fit)
    return compared.selectExpr("metric", *[f"round({c}, 9) + 0D as {c}" for c in ("full", "reduced", "delta")])


MEASURES = ("f1_storm", "precision", "recall", "auc_roc", "avg_prec")

QUERIES = {"fitted_scores": fitted_scores, "fitted_predictions": fitted_predictions, "ablation_values": ablation_values, "train_logistic": logistic, "train_forest": forest, "train_boosted": boosted, "ablation": ablated,
           "tree_importance": tree_importance, "tree_dependence": tree_dependence, "tree_attribution_stump": stump}

_M = """i AS (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1),
m AS (SELECT CASE WHEN year(o_orderdate) <= 1998 THEN 'train' WHEN year(o_orderdate) = 1999 THEN 'validation' ELSE 'test' END AS split,
o_totalprice AS price, CAST(date_diff('day', o_orderdate, shipped) AS DOUBLE) AS late,
CASE WHEN coalesce(date_diff('day', o_orderdate, shipped), 0) > 600 OR o_totalprice > 430000 THEN 1 ELSE 0 END AS label
FROM orders LEFT JOIN i ON l_orderkey = o_orderkey),
w AS (SELECT CAST(count(*) FILTER (label = 0) AS DOUBLE) AS n0, CAST(count(*) FILTER (label = 1) AS DOUBLE) AS n1 FROM m WHERE split = 'train')"""


def _score_sql(name: str, w0: str, w1: str) -> str:
    return (f"WITH {_M} SELECT '{name}' AS model, split, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS positives, "
            f"any_value({w0}) AS weight_0, any_value({w1}) AS weight_1, true AS better_than_chance FROM m, w GROUP BY split")


#: Rows by split and feature, scores of each fit by feature, counts by score with those above, and the measures.
_FITS = """r AS (SELECT CASE WHEN year(o_orderdate) <= 1998 THEN 'train' WHEN year(o_orderdate) = 1999 THEN 'validation' ELSE 'test' END AS split,
CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS DOUBLE) ELSE 0 END AS closed,
CASE WHEN o_totalprice > 200000 OR (o_orderstatus = 'F' AND o_orderkey % 3 = 0) THEN 1 ELSE 0 END AS label FROM orders),
n AS (SELECT CAST(sum(1 - label) AS DOUBLE) AS n0, CAST(sum(label) AS DOUBLE) AS n1 FROM r WHERE split = 'train'),
c AS (SELECT closed, CAST(sum(1 - label) AS DOUBLE) AS c0, CAST(sum(label) AS DOUBLE) AS c1 FROM r WHERE split = 'train' GROUP BY closed),
s AS (SELECT 'logistic_regression' AS model, closed, c1 / n1 / (c1 / n1 + c0 / n0) AS score FROM c, n
UNION ALL SELECT 'boosted_trees', closed, 1 / (1 + exp(-2 * (c1 * n0 / n1 - c0) / (c1 * n0 / n1 + c0))) FROM c, n
UNION ALL SELECT 'full', closed, 1 / (1 + exp(-2 * (2 * c1 - c0) / (2 * c1 + c0))) FROM c
UNION ALL SELECT 'reduced', closed, 1 / (1 + exp(-2 * (2 * n1 - n0) / (2 * n1 + n0))) FROM c, n),
g AS (SELECT model, split, score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg FROM r JOIN s USING (closed) GROUP BY ALL),
w AS (SELECT *, sum(pos) OVER h AS above, sum(neg) OVER h AS above_neg, sum(pos) OVER a AS p, sum(neg) OVER a AS q FROM g
WINDOW h AS (PARTITION BY model, split ORDER BY score DESC), a AS (PARTITION BY model, split)),
k AS (SELECT model, split, CAST(sum(pos) FILTER (score > 0.5) AS BIGINT) AS tp, CAST(sum(neg) FILTER (score > 0.5) AS BIGINT) AS fp,
CAST(sum(neg) FILTER (score <= 0.5) AS BIGINT) AS tn, CAST(sum(pos) FILTER (score <= 0.5) AS BIGINT) AS fn,
CAST(sum(neg * (2 * above - pos)) AS DOUBLE) / nullif(2 * any_value(p) * any_value(q), 0) AS auc_roc,
sum(CAST(pos AS DOUBLE) / p * above / (above + above_neg)) AS avg_prec FROM w GROUP BY model, split),
f AS (SELECT model, split, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp, coalesce(tn, 0) AS tn, coalesce(fn, 0) AS fn, auc_roc, avg_prec FROM k),
e AS (SELECT *, coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1_storm,
coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall FROM f)"""
_OF_METRIC = ("f1_storm", "precision", "recall", "auc_roc")
_HALF = ("(n0 + n1) / (2 * n0)", "(n0 + n1) / (2 * n1)")
ORACLES = {
    "fitted_scores": f"""WITH {_FITS} SELECT model, split, {", ".join(f"round({c}, 9) + 0 AS {c}" for c in MEASURES)}, tp, fp, tn, fn,
CAST(0 AS BIGINT) AS n_unscored FROM e WHERE model IN ('logistic_regression', 'boosted_trees')""",
    "fitted_predictions": f"""WITH {_FITS} SELECT model, split, closed, round(score, 3) + 0 AS score, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction,
count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS positives FROM r JOIN s USING (closed)
WHERE model IN ('logistic_regression', 'boosted_trees') GROUP BY ALL""",
    "ablation_values": f"""WITH {_FITS}, v AS ({" UNION ALL ".join(
        f"SELECT '{c}' AS metric, max({c}) FILTER (model = 'full') AS a, max({c}) FILTER (model = 'reduced') AS b FROM e WHERE split = 'test'" for c in _OF_METRIC)})
SELECT metric, round(a, 9) + 0 AS "full", round(b, 9) + 0 AS reduced, round(b - a, 9) + 0 AS delta FROM v""",
    "train_logistic": _score_sql("logistic_regression", *_HALF),
    "train_forest": _score_sql("random_forest", *_HALF),
    "train_boosted": _score_sql("boosted_trees", "CAST(1 AS DOUBLE)", "n0 / n1"),
    "ablation": f"""WITH {_M} SELECT model, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS positives, true AS compared
FROM m, (VALUES ('full'), ('reduced')) AS v(model) WHERE split = 'test' GROUP BY model""",
    "tree_importance": f"""WITH {_M} SELECT feature, true AS valued, true AS ranked, (SELECT count(*) FROM m WHERE split = 'train') AS n_rows,
true AS adds_up FROM (VALUES {", ".join(f"('{f}')" for f in FEATURES)}) AS v(feature)""",
    "tree_dependence": f"WITH {_M} SELECT count(*) AS n, count(price) AS n_colour, CAST(0 AS DOUBLE) AS mean, true AS bounded FROM m WHERE split = 'train'",
    "tree_attribution_stump": """WITH r AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS DOUBLE) ELSE 0 END AS closed,
CASE WHEN o_totalprice > 200000 OR (o_orderstatus = 'F' AND o_orderkey % 3 = 0) THEN 1 ELSE 0 END AS label FROM orders),
c AS (SELECT closed, CAST(sum(1 + label) AS DOUBLE) AS cover, sum(CASE WHEN label = 1 THEN 2 ELSE -1 END) AS hit FROM r GROUP BY closed),
b AS (SELECT sum(hit) / sum(cover) AS base FROM c)
SELECT o_orderkey, closed, round(hit / cover - base, 9) + 0 AS phi, round(base, 9) AS base FROM r JOIN c USING (closed), b""",
}
