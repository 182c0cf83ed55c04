"""Attribution of linear models, importance ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventwin.operators import attribution as A
from queries.tables import table

WEIGHTS = {"min_Bz_gsm": -0.5, "mean_V": 0.25, "price": 0.001, "tax": 3.0, "nothing": 0.0}
_COLUMNS = {"min_Bz_gsm": "l_quantity", "mean_V": "l_discount", "price": "l_extendedprice", "tax": "l_tax",
            "nothing": "cast(l_linenumber as double)"}


def _rows(spark, d):
    items = table(spark, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey",
                                                   *[f"{e} as {n}" for n, e in _COLUMNS.items()])
    return A.linear_attribution(items, WEIGHTS)


def per_row(spark, d):
    return A.dependence(_rows(spark, d), list(WEIGHTS), "price", "tax").withColumn(
        "attribution", F.expr("round(attribution, 6)"))


def _ranked(spark, d):
    return A.importance(_rows(spark, d), list(WEIGHTS))


def importance(spark, d):
    return _ranked(spark, d).withColumn("mean_abs_shap", F.expr("round(mean_abs_shap, 9)"))


def top(spark, d):
    return _ranked(spark, d).orderBy("rank").limit(3).select("feature", "rank")


def check(spark, d):
    ranked = _ranked(spark, d)
    return A.best_rank(ranked, "Bz_gsm", 1).unionByName(A.best_rank(ranked, "mean_V", 10))


QUERIES = {"linear_attribution_points": per_row, "importance_rank": importance, "importance_top": top,
           "importance_check": check}

_IMP = "i AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, avg(abs({w} * ({e.replace('cast(', 'CAST(').replace(' as ', ' AS ')} - "
    f"(SELECT avg({e}) FROM lineitem)))) AS v FROM lineitem" for (n, w), e in zip(WEIGHTS.items(), _COLUMNS.values())) + \
    "), k AS (SELECT feature, v, row_number() OVER (ORDER BY v DESC, feature) AS rank FROM i)"

ORACLES = {
    "linear_attribution_points": """SELECT l_extendedprice AS value,
round(0.001 * (l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem)), 6) AS attribution, l_tax AS colour FROM lineitem""",
    "importance_rank": f"WITH {_IMP} SELECT feature, round(v, 9) AS mean_abs_shap, CAST(rank AS INTEGER) AS rank FROM k",
    "importance_top": f"WITH {_IMP} SELECT feature, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 3",
    "importance_check": f"""WITH {_IMP} SELECT 'Bz_gsm' AS fragment, CAST(min(rank) AS INTEGER) AS best_rank, min(rank) <= 1 AS passed
FROM k WHERE feature LIKE '%Bz_gsm%' UNION ALL SELECT 'mean_V', CAST(min(rank) AS INTEGER), min(rank) <= 10 FROM k
WHERE feature LIKE '%mean_V%'""",
}
