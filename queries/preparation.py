"""Splits by year, preparation fitted on the training years, checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventwin.operators import checks
from eventwin.operators.levels import fit_levels
from eventwin.operators.prep import fit_preprocessor
from eventwin.operators.split import assign_split, excluded_rows, split_summary
from queries.tables import ranked_quantile, table

YEARS = {"train_end": 1998, "val_year": 1999, "test_start": 2000}
PATTERNS = ("price", "o_order", "key")
FEATURES = ("price", "gap", "flat", "cust")


def orders_with_split(spark, d):
    rows = table(spark, d, "orders").selectExpr(
        "o_orderkey", "year(o_orderdate) as year", "o_totalprice as price", "if(o_orderkey % 3 = 0, null, o_totalprice) as gap",
        "5D as flat", "cast(o_custkey as double) as cust", r"case o_orderpriority when '3-MEDIUM' then null when '5-LOW' then 'O\'Neil' when '2-HIGH' then 'a\\b`c' else o_orderpriority end as priority",
        "if(o_orderstatus = 'F', 1, 0) as label_storm")
    return assign_split(rows, **YEARS)


def split_rows(spark, d):
    return orders_with_split(spark, d).select("o_orderkey", "split")


def summary(spark, d):
    return split_summary(orders_with_split(spark, d), FEATURES)


def excluded(spark, d):
    rows = table(spark, d, "orders").selectExpr("year(o_orderdate) as year")
    return excluded_rows(rows, train_end=1996, val_year=1998, test_start=2000)


def _fitted(rows, features, scale):
    return fit_preprocessor(rows.where("split = 'train'"), features, scale=scale)


def impute(spark, d):
    rows = orders_with_split(spark, d)
    return _fitted(rows, FEATURES, False).transform(rows, keep=["o_orderkey", "split"])


def standardise(spark, d):
    rows = orders_with_split(spark, d)
    out = _fitted(rows, FEATURES, True).transform(rows, keep=["o_orderkey", "split"])
    return out.select("o_orderkey", "split", *[F.expr(f"round({c}, 6) + 0D as {c}") for c in FEATURES])


def one_hot(spark, d):
    rows = orders_with_split(spark, d)
    return _fitted(rows, ["priority"], True).transform(rows, keep=["o_orderkey"])


def _many_levels(spark, d):
    return orders_with_split(spark, d).selectExpr("o_orderkey", "split", "if(o_orderkey % 11 = 0, null, concat('c', cast(cust as bigint))) as customer", "priority")


def level_table(spark, d):
    """Every customer is a level."""
    rows = _many_levels(spark, d)
    return fit_levels(rows.where("split = 'train'"), ["customer", "priority"]).table.drop("place")


def level_positions(spark, d):
    rows = _many_levels(spark, d)
    return fit_levels(rows.where("split = 'train'"), ["customer", "priority"]).positions(rows)


def report(spark, d):
    """With an empty split, infinities and a label that isn't 0 or 1, which must fail."""
    rows = orders_with_split(spark, d).withColumns({
        "flat": F.expr("if(o_orderkey % 97 = 0, double('infinity'), flat)"), "label_storm": F.expr("if(o_orderkey % 101 = 0, 2, label_storm)")})
    found = checks.check_splits(rows, FEATURES, splits=("train", "validation", "test", "holdout"))
    return found.withColumn("value", F.expr("round(value, 9)"))


def leaks(spark, d):
    orders = table(spark, d, "orders")
    return checks.leaky_names(orders, orders.columns, PATTERNS)


def nulls(spark, d):
    return checks.null_counts(orders_with_split(spark, d), FEATURES)


QUERIES = {
    "time_split": split_rows, "time_split_summary": summary, "time_split_excluded": excluded, "impute_median": impute,
    "standardize": standardise, "mode_impute_onehot": one_hot, "level_table": level_table, "level_positions": level_positions,
    "checks_report": report, "null_counts": nulls, "leaky_names": leaks,
}

_O = """o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice AS price,
CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS gap, CAST(5 AS DOUBLE) AS flat, CAST(o_custkey AS DOUBLE) AS cust,
CASE o_orderpriority WHEN '3-MEDIUM' THEN NULL WHEN '5-LOW' THEN 'O''Neil' WHEN '2-HIGH' THEN 'a\\b`c' ELSE o_orderpriority END AS priority, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label_storm,
CASE WHEN year(o_orderdate) <= 1998 THEN 'train' WHEN year(o_orderdate) = 1999 THEN 'validation' ELSE 'test' END AS split
FROM orders)"""
_TRAIN = "(SELECT gap FROM o WHERE split = 'train')"
_FILLED = f"f AS (SELECT o_orderkey, split, price, coalesce(gap, {ranked_quantile(_TRAIN, 'gap', 0.5)}) AS gap, flat, cust FROM o)"
_MODE = "(SELECT priority FROM o WHERE split = 'train' AND priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


def _scaled(c: str) -> str:
    return (f"round((f.{c} - p.m_{c}) / CASE WHEN p.s_{c} = 0 THEN 1 ELSE p.s_{c} END, 6) + 0 AS {c}")


_PARAMS = "p AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURES) + " FROM f WHERE split = 'train')"
_CELLS = """c AS (SELECT o_orderkey, split, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'c' || CAST(cust AS BIGINT) END AS customer, priority FROM o),
g AS (SELECT 'customer' AS "column", customer AS level, count(*) AS n FROM c WHERE split = 'train' AND customer IS NOT NULL GROUP BY 2
UNION ALL SELECT 'priority', priority, count(*) FROM c WHERE split = 'train' AND priority IS NOT NULL GROUP BY 2),
r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY level) - 1 AS position FROM g)"""


def _level_of(c: str) -> str:
    mode = f"(SELECT level FROM r WHERE \"column\" = '{c}' ORDER BY n DESC, level LIMIT 1)"
    return f"(SELECT o_orderkey, position FROM c LEFT JOIN r ON \"column\" = '{c}' AND level = coalesce({c}, {mode}))"


_LEVELS = ("1-URGENT", "a\\b`c", "4-NOT SPECIFIED", "O'Neil")

ORACLES = {
    "time_split": f"WITH {_O} SELECT o_orderkey, split FROM o",
    "time_split_summary": f"""WITH {_O} SELECT split, count(*) AS n_rows, 4 AS n_features, CAST(sum(label_storm) AS BIGINT) AS n_storms,
round(CAST(sum(label_storm) AS DOUBLE) / count(*), 4) AS storm_rate, min(year) AS year_min, max(year) AS year_max,
round(100 * CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM o), 1) AS pct_of_rows FROM o GROUP BY split""",
    "time_split_excluded": "SELECT count(*) AS n_excluded FROM orders WHERE year(o_orderdate) IN (1997, 1999)",
    "impute_median": f"WITH {_O}, {_FILLED} SELECT * FROM f",
    "standardize": f"WITH {_O}, {_FILLED}, {_PARAMS} SELECT o_orderkey, split, {', '.join(_scaled(c) for c in FEATURES)} FROM f, p",
    "mode_impute_onehot": f"WITH {_O}, z AS (SELECT o_orderkey, coalesce(priority, {_MODE}) AS v FROM o) SELECT o_orderkey, "
                          + ", ".join("CAST(v = '" + v.replace("'", "''") + f"' AS DOUBLE) AS \"priority_{v}\"" for v in _LEVELS) + " FROM z",
    "level_table": f"WITH {_O}, {_CELLS} SELECT * FROM r",
    "level_positions": f"""WITH {_O}, {_CELLS} SELECT o_orderkey, split, a.position AS customer, b.position AS priority
FROM o JOIN {_level_of("customer")} a USING (o_orderkey) JOIN {_level_of("priority")} b USING (o_orderkey)""",
    "checks_report": f"""WITH {_O}, c AS (SELECT split, gap, flat + CASE WHEN o_orderkey % 97 = 0 THEN CAST('inf' AS DOUBLE) ELSE 0 END AS flat,
CASE WHEN o_orderkey % 101 = 0 THEN 2 ELSE label_storm END AS label FROM o),
g AS (SELECT s.split, count(c.split) AS n, count(c.split) - count(gap) AS missing, count(*) FILTER (isinf(flat)) AS endless,
count(*) FILTER (label = 2) AS odd, avg(label) AS rate
FROM (VALUES ('train'), ('validation'), ('test'), ('holdout')) AS s(split) LEFT JOIN c ON c.split = s.split GROUP BY s.split)
SELECT 'rows' AS "check", split, CAST(n AS DOUBLE) AS value, n > 0 AS passed FROM g
UNION ALL SELECT 'features', split, 4, true FROM g
UNION ALL SELECT 'missing values', split, missing, missing = 0 FROM g
UNION ALL SELECT 'infinite values', split, endless, endless = 0 FROM g
UNION ALL SELECT 'labels not 0/1', split, odd, odd = 0 FROM g
UNION ALL SELECT 'positive rate', split, round(rate, 9), CASE WHEN rate BETWEEN 0.1 AND 0.9 THEN true END FROM g""",
    "leaky_names": f"""SELECT c.column_name AS "column", p.pattern FROM information_schema.columns c
JOIN (VALUES {", ".join(f"('{p}')" for p in PATTERNS)}) AS p(pattern) ON contains(c.column_name, p.pattern) WHERE c.table_name = 'orders'""",
    "null_counts": f"""WITH {_O} SELECT split, 'gap' AS "column", count(*) - count(gap) AS n_missing FROM o GROUP BY split""",
}
