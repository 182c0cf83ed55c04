"""Rates, distributions, correlations and missing values."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventwin.functions.times import time_micros
from eventwin.operators import profile
from eventwin.operators.scan import exact_quantiles
from queries.tables import ranked_quantiles, table, typed_events

LABEL = "if(o_orderstatus = 'F', 1, 0) as label_storm"


def _orders(spark, d, *columns):
    return table(spark, d, "orders").selectExpr(*columns, LABEL)


def classes(spark, d):
    return profile.class_counts(_orders(spark, d, "o_orderkey"))


def by_year(spark, d):
    return profile.rate_by_year(_orders(spark, d, "o_orderdate"), "o_orderdate")


def by_bin(spark, d):
    return profile.rate_by_quantile_bin(_orders(spark, d, "o_totalprice"), "o_totalprice")


def by_merged_bin(spark, d):
    """Few distinct values: equal edges are merged."""
    items = table(spark, d, "lineitem").selectExpr("least(l_linenumber, 4) as n", "if(l_linestatus = 'F', 1, 0) as y")
    return profile.rate_by_quantile_bin(items, "n", "y", bins=6)


def quantiles(spark, d):
    items = table(spark, d, "lineitem").selectExpr("l_extendedprice", "if(l_linenumber = 2, null, l_quantity) as l_quantity")
    return exact_quantiles(items, ["l_extendedprice", "l_quantity"], [0.0, 0.1, 0.5, 0.99, 1.0])


def _edges(df):
    return df.withColumns({c: F.round(c, 6) for c in ("lo", "hi")})


def histogram(spark, d):
    return _edges(profile.histograms(table(spark, d, "events"), ["value"], 40))


def histogram_by_class(spark, d):
    return _edges(profile.histogram_by_class(_orders(spark, d, "o_totalprice"), "o_totalprice"))


def _values(spark, d):
    return table(spark, d, "events").selectExpr("value", "value * event_id % 101 as other",
                                                "if(event_type = 'purchase', 1, 0) as y")


def boxes(spark, d):
    return profile.box_stats(_values(spark, d), ["value", "other", "absent"], "y")


def outliers(spark, d):
    return profile.box_outliers(_values(spark, d), ["value"], "y")


def correlations(spark, d):
    items = table(spark, d, "lineitem").selectExpr(
        "l_quantity as q", "l_extendedprice as p", "nullif(l_discount, 0D) as d", "if(l_linenumber = 1, null, l_tax) as t",
        "1 as c")
    return profile.correlations(items).withColumn("r", F.expr("round(r, 9)"))


WIDE = 26


def correlations_wide(spark, d):
    items = table(spark, d, "lineitem").selectExpr(
        *[f"cast(nullif(l_orderkey * {i + 1} % 97 + l_linenumber * {i % 5}, 7) as double) as w{i:02d}" for i in range(WIDE)])
    return profile.correlations(items).withColumn("r", F.expr("round(r, 9)"))


def _gaps(spark, d):
    return table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "nullif(l_tax, 0D) as tax", "if(l_quantity > 15, null, l_quantity) as qty",
        "if(l_linenumber > 2, null, l_discount) as disc", "nullif(l_returnflag, 'R') as flag",
        "if(l_linestatus = 'F', 1, 0) as label_storm")


def missing(spark, d):
    return profile.missing_fraction(_gaps(spark, d))


def top_missing(spark, d):
    return profile.top_missing(_gaps(spark, d), 3)


def quality(spark, d):
    return profile.table_quality(_gaps(spark, d)).withColumn("missing_mean", F.expr("round(missing_mean, 9)"))


def audit(spark, d):
    return profile.imputation_audit(_gaps(spark, d))


def series_points(spark, d):
    out = profile.series_points(typed_events(spark, d, "purchase", "ts", "value"), "ts", "value")
    return out.select(time_micros(out, "time").alias("us"), "value")


def series_by_day(spark, d):
    series = typed_events(spark, d, "purchase", "cast(ts as timestamp) as ts", "cast(value as decimal(12,2)) as value")
    out = profile.series_points(series, "ts", "value", every="1 day")
    return out.select(time_micros(out, "time").alias("us"), "n", F.expr("cast(lo as double) as lo"),
                      F.expr("round(cast(mean as double), 4) as mean"), F.expr("cast(hi as double) as hi"))


QUERIES = {
    "class_counts": classes, "rate_by_year": by_year, "rate_by_quantile_bin": by_bin,
    "rate_by_merged_bin": by_merged_bin, "exact_quantiles": quantiles, "histogram": histogram,
    "histogram_by_class": histogram_by_class, "box_stats": boxes, "box_outliers": outliers, "corr_matrix": correlations,
    "corr_matrix_wide": correlations_wide, "missing_fraction": missing, "top_missing": top_missing,
    "table_quality": quality, "imputation_audit": audit, "series_points": series_points, "series_downsample": series_by_day,
}

_Y = "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"
_GAPS = """g AS (SELECT l_orderkey, nullif(l_tax, 0) AS tax, CASE WHEN l_quantity > 15 THEN NULL ELSE l_quantity END AS qty,
CASE WHEN l_linenumber > 2 THEN NULL ELSE l_discount END AS disc, nullif(l_returnflag, 'R') AS flag,
CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS label_storm FROM lineitem)"""
_GAP_COLUMNS = ("l_orderkey", "tax", "qty", "disc", "flag", "label_storm")
_MISSING = f"{_GAPS}, m AS ({' UNION ALL '.join(f'''SELECT '{c}' AS "column", CAST(count(*) - count({c}) AS BIGINT) AS k, count(*) AS n FROM g''' for c in _GAP_COLUMNS)})"


def _binned(source: str, value: str, label: str, q: int) -> str:
    edges = ranked_quantiles("r", "v", [i / q for i in range(q + 1)])
    below = " + ".join(f"CASE WHEN e[{i + 1}] < v THEN 1 ELSE 0 END" for i in range(q + 1))
    return f"""
WITH r AS (SELECT CAST({value} AS DOUBLE) AS v, {label} AS y FROM {source}),
e AS (SELECT list_sort(list_distinct(list(value))) AS e FROM {edges}),
b AS (SELECT v, y, e, greatest({below}, 1) AS bin FROM r, e)
SELECT CAST(bin AS INTEGER) AS bin, any_value(e[bin]) AS lo, any_value(e[bin + 1]) AS hi, count(*) AS n,
CAST(sum(y) AS BIGINT) AS storms, 100 * CAST(sum(y) AS DOUBLE) / count(*) AS storm_rate_pct FROM b GROUP BY 1"""


def _quantile_rows(items: dict[str, str], probs: list[float], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS \"column\", prob, value, n FROM {ranked_quantiles(source, e, probs)}"
                              for n, e in items.items())


_BOXES = f"""v AS (SELECT value, value * event_id % 101 AS other, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y FROM events),
l AS (SELECT 'value' AS feature, y AS class, value AS x FROM v UNION ALL SELECT 'other', y, other FROM v),
q AS (SELECT feature, class, max(value) FILTER (prob = 0.25) AS q1, max(value) FILTER (prob = 0.5) AS median,
 max(value) FILTER (prob = 0.75) AS q3 FROM {ranked_quantiles("l", "x", [0.25, 0.5, 0.75], ("feature", "class"))} GROUP BY feature, class),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS a, q3 + 1.5 * (q3 - q1) AS b FROM q)"""


def _pairs(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, count(CASE WHEN {a} IS NULL THEN NULL ELSE {b} END) AS n, "
        f"round(CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END, 9) AS r FROM {source}"
        for i, a in enumerate(columns) for b in columns[i + 1:])


_WIDE = [f"w{i:02d}" for i in range(WIDE)]
_WIDE_AGG = ", ".join(f"{{'a': '{a}', 'b': '{b}', 'n': regr_count({a}, {b}), 'r': round(corr({a}, {b}), 9)}}"
                      for i, a in enumerate(_WIDE) for b in _WIDE[i + 1:])

ORACLES = {
    "class_counts": f"""SELECT CAST({_Y} AS INTEGER) AS class, count(*) AS n,
CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM orders) AS share FROM orders GROUP BY 1""",
    "rate_by_year": f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS total, CAST(sum({_Y}) AS BIGINT) AS storms,
100 * CAST(sum({_Y}) AS DOUBLE) / count(*) AS storm_rate_pct FROM orders GROUP BY 1""",
    "rate_by_quantile_bin": _binned("orders", "o_totalprice", _Y, 5),
    "rate_by_merged_bin": _binned("lineitem", "least(l_linenumber, 4)", "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END", 6),
    "exact_quantiles": "WITH i AS (SELECT l_extendedprice AS p, CASE WHEN l_linenumber = 2 THEN NULL ELSE l_quantity END AS q FROM lineitem) "
                       + _quantile_rows({"l_extendedprice": "p", "l_quantity": "q"}, [0.0, 0.1, 0.5, 0.99, 1.0], "i"),
    "histogram": """WITH b AS (SELECT min(value) AS a, max(value) AS z FROM events),
c AS (SELECT CAST(least(floor((value - a) / (z - a) * 40), 39) AS INTEGER) AS bin FROM events, b)
SELECT 'value' AS "column", CAST(g AS INTEGER) AS bin, round(any_value(a + (z - a) * g / 40), 6) AS lo,
round(any_value(a + (z - a) * (g + 1) / 40), 6) AS hi, count(c.bin) AS n FROM b CROSS JOIN range(40) AS r(g) LEFT JOIN c ON c.bin = g GROUP BY g""",
    "histogram_by_class": f"""WITH o AS (SELECT CAST({_Y} AS INTEGER) AS class, o_totalprice AS v FROM orders),
b AS (SELECT class, min(v) AS a, max(v) AS z FROM o GROUP BY class),
c AS (SELECT class, CAST(least(floor((v - a) / (z - a) * 30), 29) AS INTEGER) AS bin FROM o JOIN b USING (class))
SELECT b.class, CAST(g AS INTEGER) AS bin, round(any_value(a + (z - a) * g / 30), 6) AS lo,
round(any_value(a + (z - a) * (g + 1) / 30), 6) AS hi, count(c.bin) AS n FROM b CROSS JOIN range(30) AS r(g)
LEFT JOIN c ON c.bin = g AND c.class = b.class GROUP BY b.class, g""",
    "box_stats": f"""WITH {_BOXES} SELECT feature, class, count(*) AS n, q1, median, q3,
least(min(x) FILTER (x >= a), q1) AS whisker_lo, greatest(max(x) FILTER (x <= b), q3) AS whisker_hi,
count(*) FILTER (x < a OR x > b) AS n_outliers FROM l JOIN f USING (feature, class) GROUP BY feature, class, q1, median, q3""",
    "box_outliers": f"""WITH {_BOXES} SELECT feature, class, x AS value FROM l JOIN f USING (feature, class)
WHERE feature = 'value' AND (x < a OR x > b)""",
    "corr_matrix": """WITH i AS (SELECT l_quantity AS q, l_extendedprice AS p, nullif(l_discount, 0) AS d,
CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END AS t, 1 AS c FROM lineitem) """ + _pairs(["q", "p", "d", "t", "c"], "i"),
    "corr_matrix_wide": "WITH i AS (SELECT " + ", ".join(
        f"CAST(nullif(l_orderkey * {i + 1} % 97 + l_linenumber * {i % 5}, 7) AS DOUBLE) AS w{i:02d}" for i in range(WIDE))
        + f" FROM lineitem), s AS (SELECT unnest([{_WIDE_AGG}]) AS x FROM i) "
        "SELECT x.a AS a, x.b AS b, CAST(x.n AS BIGINT) AS n, x.r AS r FROM s",
    "missing_fraction": f'WITH {_MISSING} SELECT "column", CAST(k AS DOUBLE) / n AS missing_fraction FROM m',
    "top_missing": f'WITH {_MISSING} SELECT "column", CAST(k AS DOUBLE) / n AS missing_fraction FROM m ORDER BY 2 DESC, 1 LIMIT 3',
    "table_quality": f"""WITH {_MISSING} SELECT round(avg(CAST(k AS DOUBLE) / n), 9) AS missing_mean,
count(*) FILTER (CAST(k AS DOUBLE) / n > 0.5) AS cols_over_half_missing,
(SELECT avg(label_storm) FROM g) AS storm_rate FROM m""",
    "imputation_audit": f"""WITH {_MISSING} SELECT "column", k AS n_missing, 100 * CAST(k AS DOUBLE) / n AS pct_missing FROM m
WHERE k > 0 AND "column" <> 'flag'""",
    "series_points": "SELECT epoch_us(ts) AS us, value FROM events WHERE event_type = 'purchase'",
    "series_downsample": """SELECT epoch_us(date_trunc('day', ts)) AS us, count(value) AS n, min(value) AS lo,
round(CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(value), 4) AS mean, max(value) AS hi FROM events WHERE event_type = 'purchase' GROUP BY 1""",
}
