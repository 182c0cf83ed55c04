"""Interval joins: sign-ups are the events, purchases the series; orders and line items likewise."""

from __future__ import annotations

from eventwin.operators.coverage import coverage_table, score_ranges
from eventwin.operators.interval import Interval, WindowStats, forward_max_label, interval_exists, interval_stats, window_features
from eventwin.operators.profile import rate_by
from queries.tables import table, typed_events

MONEY = "cast(value as decimal(12,2)) as value"
KEYED_DAYS = 60


def _signups(spark, d, *extra):
    return typed_events(spark, d, "signup", "event_id", "ts", *extra)


def _purchases(spark, d, *columns):
    return typed_events(spark, d, "purchase", "ts", *(columns or (MONEY,)))


def max_label(spark, d):
    return forward_max_label(_signups(spark, d), _purchases(spark, d), threshold=300, event_time="ts", series_time="ts",
                             value="value", observed="n_obs").drop("ts")


def max_label_keyed(spark, d):
    return forward_max_label(_signups(spark, d, "user_id"), _purchases(spark, d, "user_id", MONEY), threshold=100,
                             event_time="ts", series_time="ts", value="value", observed="n_obs",
                             keys=["user_id"]).drop("ts")


def label_rate_by_day(spark, d):
    labelled = forward_max_label(_signups(spark, d), _purchases(spark, d), threshold=300, event_time="ts",
                                 series_time="ts", value="value")
    return rate_by(labelled, "cast(date_trunc('DAY', ts) as date)", name="day")


def stats_24_72(spark, d):
    series = _purchases(spark, d, MONEY, "cast(get_json_object(props, '$.k') as decimal(12,2)) as k")
    spec = WindowStats(columns=("value", "k"), series="ev")
    return window_features(_signups(spark, d), series, spec, event_time="ts", series_time="ts").drop("ts")


def stats_keyed_back(spark, d):
    outputs = {"n": ("count", "value"), "mean": ("mean", "value"), "lo": ("min", "value"), "sd": ("std", "value")}
    return interval_stats(_signups(spark, d, "user_id"), _purchases(spark, d, "user_id", MONEY), Interval(-36.5, -0.25),
                          outputs, event_time="ts", series_time="ts", keys=["user_id"]).drop("ts")


def exists_forward(spark, d):
    return interval_exists(_signups(spark, d), _purchases(spark, d, MONEY), Interval(0, 72), "seen", event_time="ts", series_time="ts").drop("ts")


def exists_back(spark, d):
    return interval_exists(_signups(spark, d), _purchases(spark, d, MONEY), Interval(-24, 0), "seen", event_time="ts", series_time="ts").drop("ts")


def _coverage(spark, d):
    errors = typed_events(spark, d, "error", "ts")
    return coverage_table(_signups(spark, d), _purchases(spark, d, MONEY), errors, event_time="ts", label_time="ts", label_value="value",
                          series_time="ts", horizon_hours=72, back_hours=24, threshold=250, period="day(ts)")


def coverage_by_day(spark, d):
    return _coverage(spark, d)


RANGES = [(1, 30), (5, 20), (29, 30), (40, 50)]


def range_scores(spark, d):
    return score_ranges(_coverage(spark, d), RANGES, min_label_pct=60, min_series_pct=60)


def stats_orders_by_date(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    items = table(spark, d, "lineitem").selectExpr("l_shipdate", "cast(l_quantity as decimal(12,2)) as qty",
                                                   "cast(l_extendedprice as decimal(12,2)) as price")
    outputs = {"n": ("count", "qty"), "mean_qty": ("mean", "qty"), "max_price": ("max", "price"),
               "std_price": ("std", "price")}
    return interval_stats(orders, items, Interval(24, 72), outputs, event_time="o_orderdate",
                          series_time="l_shipdate").drop("o_orderdate")


def stats_orders_by_key(spark, d):
    orders = table(spark, d, "orders").selectExpr("o_orderkey as k", "o_orderdate")
    items = table(spark, d, "lineitem").selectExpr("l_orderkey as k", "l_shipdate",
                                                   "cast(l_extendedprice as decimal(12,2)) as price")
    outputs = {"n": ("rows", None), "lo": ("min", "price"), "mean": ("mean", "price")}
    return interval_stats(orders, items, Interval(-24 * KEYED_DAYS, 24 * KEYED_DAYS), outputs, event_time="o_orderdate",
                          series_time="l_shipdate", keys=["k"]).drop("o_orderdate")


def stats_large_decimals(spark, d):
    """Values near 1e12 in intervals that hold all purchases of a month."""
    series = _purchases(spark, d, "cast(1000000000000 + cast(value as decimal(12,2)) as decimal(18,2)) as value")
    outputs = {"n": ("count", "value"), "mean": ("mean", "value"), "sd": ("std", "value")}
    return interval_stats(_signups(spark, d), series, Interval(-744, 744), outputs, event_time="ts", series_time="ts").drop("ts")


def stats_close_doubles(spark, d):
    """DOUBLE values near 1e9 that differ in thousandths, in intervals that hold all purchases of a month."""
    series = _purchases(spark, d, "1000000000D + cast(cast(value as decimal(12,2)) * 100 as bigint) / 8388608D as value")
    outputs = {"n": ("count", "value"), "mean": ("mean", "value"), "sd": ("std", "value")}
    found = interval_stats(_signups(spark, d), series, Interval(-744, 744), outputs, event_time="ts", series_time="ts")
    return found.selectExpr("event_id", "n", "round(mean, 5) as mean", "round(sd, 14) as sd")


def stats_one_year(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    items = table(spark, d, "lineitem").selectExpr("l_shipdate", "cast(l_extendedprice as decimal(12,2)) as price")
    outputs = {"n": ("rows", None), "mean": ("mean", "price"), "lo": ("min", "price"), "hi": ("max", "price"), "sd": ("std", "price")}
    return interval_stats(orders, items, Interval(0, 8760), outputs, event_time="o_orderdate", series_time="l_shipdate").drop("o_orderdate")


QUERIES = {
    "interval_max_label": max_label,
    "interval_max_label_keyed": max_label_keyed,
    "label_rate_by_day": label_rate_by_day,
    "interval_stats_24_72": stats_24_72,
    "interval_stats_keyed_back": stats_keyed_back,
    "interval_exists_forward": exists_forward,
    "interval_exists_back": exists_back,
    "coverage_by_day": coverage_by_day,
    "range_scores": range_scores,
    "interval_stats_orders_by_date": stats_orders_by_date,
    "interval_stats_orders_by_key": stats_orders_by_key,
    "interval_stats_large_decimals": stats_large_decimals,
    "interval_stats_close_doubles": stats_close_doubles,
    "interval_stats_one_year": stats_one_year,
}

_A = "a AS (SELECT event_id, ts, user_id FROM events WHERE event_type = 'signup')"
_S = "s AS (SELECT ts, user_id, CAST(value AS DECIMAL(12,2)) AS value, CAST(json_extract_string(props, '$.k') AS DECIMAL(12,2)) AS k FROM events WHERE event_type = 'purchase')"


def _mean(c: str) -> str:
    return f"(CAST(sum({c}) AS DOUBLE) / count({c}))"


def _std(c: str) -> str:
    """From whole hundredths; read as text, as only that conversion to DOUBLE is rounded once."""
    h = f"CAST({c} * 100 AS HUGEINT)"
    spread = f"count({c}) * sum({h} * {h}) - sum({h}) * sum({h})"
    return f"CASE WHEN count({c}) > 0 THEN sqrt(CAST(CAST({spread} AS VARCHAR) AS DOUBLE)) / count({c}) / 100 END"


def _four(c: str) -> str:
    return (f"{_mean(c)} AS ev_w24_72_mean_{c}, CAST(min({c}) AS DOUBLE) AS ev_w24_72_min_{c}, "
            f"CAST(max({c}) AS DOUBLE) AS ev_w24_72_max_{c}, {_std(c)} AS ev_w24_72_std_{c}")


_LABEL = "CAST(coalesce(max(s.value) >= {thr}, false) AS INTEGER) AS label_storm"
_RARE = ("WITH {a}, {s} SELECT a.event_id, count(s.ts) > 0 AS seen FROM a LEFT JOIN s ON "
         "s.ts BETWEEN {between} GROUP BY a.event_id")
_COVERAGE = f"""
WITH {_A}, {_S},
e AS (SELECT ts FROM events WHERE event_type = 'error'),
k AS (SELECT a.event_id, any_value(a.ts) AS ts, count(s.ts) AS n, max(s.value) AS top
      FROM a LEFT JOIN s ON s.ts BETWEEN a.ts AND a.ts + INTERVAL 72 HOUR GROUP BY a.event_id),
b AS (SELECT a.event_id, count(e.ts) AS n FROM a LEFT JOIN e ON e.ts BETWEEN a.ts - INTERVAL 24 HOUR AND a.ts
      GROUP BY a.event_id),
c AS (SELECT CAST(day(k.ts) AS INTEGER) AS year, count(*) AS cme_total, count(*) FILTER (k.n > 0) AS cme_with_kp,
      count(*) FILTER (b.n > 0) AS cme_with_omni, count(*) FILTER (k.top >= 250) AS storm_count
      FROM k JOIN b USING (event_id) GROUP BY 1),
t AS (SELECT year, cme_total, cme_with_kp,
      round(100 * CAST(cme_with_kp AS DOUBLE) / cme_total, 1) AS kp_coverage_pct, cme_with_omni,
      round(100 * CAST(cme_with_omni AS DOUBLE) / cme_total, 1) AS omni_coverage_pct, storm_count,
      coalesce(round(100 * CAST(storm_count AS DOUBLE) / nullif(cme_with_kp, 0), 1), 0) AS storm_rate_pct FROM c)
"""
_RANGE_ROWS = ", ".join(f"({a}, {b})" for a, b in RANGES)

ORACLES = {
    "interval_max_label": f"""
WITH {_A}, {_S} SELECT a.event_id, CAST(max(s.value) AS DOUBLE) AS kp_max_h72, count(s.value) AS n_obs,
{_LABEL.format(thr=300)} FROM a LEFT JOIN s ON s.ts BETWEEN a.ts AND a.ts + INTERVAL 72 HOUR GROUP BY a.event_id""",
    "interval_max_label_keyed": f"""
WITH {_A}, {_S} SELECT a.event_id, any_value(a.user_id) AS user_id, CAST(max(s.value) AS DOUBLE) AS kp_max_h72,
count(s.value) AS n_obs, {_LABEL.format(thr=100)} FROM a LEFT JOIN s ON s.user_id = a.user_id AND
s.ts BETWEEN a.ts AND a.ts + INTERVAL 72 HOUR GROUP BY a.event_id""",
    "label_rate_by_day": f"""
WITH {_A}, {_S}, l AS (SELECT a.event_id, any_value(a.ts) AS ts, {_LABEL.format(thr=300)} FROM a LEFT JOIN s
ON s.ts BETWEEN a.ts AND a.ts + INTERVAL 72 HOUR GROUP BY a.event_id)
SELECT CAST(ts AS DATE) AS day, count(*) AS total, CAST(sum(label_storm) AS BIGINT) AS storms,
100 * CAST(sum(label_storm) AS DOUBLE) / count(*) AS storm_rate_pct FROM l GROUP BY 1""",
    "interval_stats_24_72": f"""
WITH {_A}, {_S} SELECT a.event_id, {_four('value')}, {_four('k')} FROM a LEFT JOIN s
ON s.ts BETWEEN a.ts + INTERVAL 24 HOUR AND a.ts + INTERVAL 72 HOUR GROUP BY a.event_id""",
    "interval_stats_keyed_back": f"""
WITH {_A}, {_S} SELECT a.event_id, any_value(a.user_id) AS user_id, count(value) AS n, {_mean('value')} AS mean,
CAST(min(value) AS DOUBLE) AS lo, {_std('value')} AS sd FROM a LEFT JOIN s ON s.user_id = a.user_id AND
s.ts BETWEEN a.ts - INTERVAL 2190 MINUTE AND a.ts - INTERVAL 15 MINUTE GROUP BY a.event_id""",
    "interval_exists_forward": _RARE.format(a=_A, s=_S, between="a.ts AND a.ts + INTERVAL 72 HOUR"),
    "interval_exists_back": _RARE.format(a=_A, s=_S, between="a.ts - INTERVAL 24 HOUR AND a.ts"),
    "coverage_by_day": f"{_COVERAGE} SELECT * FROM t",
    "range_scores": f"""{_COVERAGE},
r AS (SELECT * FROM (VALUES {_RANGE_ROWS}) AS v(start_year, end_year)),
m AS (SELECT start_year, end_year, CAST(coalesce(sum(cme_total), 0) AS BIGINT) AS total_cmes,
 CAST(coalesce(sum(storm_count), 0) AS BIGINT) AS total_storms,
 coalesce(CAST(sum(CAST(kp_coverage_pct AS DECIMAL(9,1))) AS DOUBLE) / nullif(count(year), 0), 0) AS kp,
 coalesce(CAST(sum(CAST(omni_coverage_pct AS DECIMAL(9,1))) AS DOUBLE) / nullif(count(year), 0), 0) AS om
 FROM r LEFT JOIN t ON year BETWEEN start_year AND end_year GROUP BY ALL)
SELECT start_year, end_year, total_cmes, total_storms, round(kp, 1) AS avg_kp_coverage_pct,
 round(om, 1) AS avg_omni_coverage_pct,
 total_cmes >= 300 AND total_storms >= 20 AND kp >= 60 AND om >= 60 AS passes_thresholds FROM m""",
    "interval_stats_orders_by_date": f"""
WITH s AS (SELECT l_shipdate, CAST(l_quantity AS DECIMAL(12,2)) AS qty, CAST(l_extendedprice AS DECIMAL(12,2)) AS price
 FROM lineitem),
t AS (SELECT DISTINCT o_orderdate AS t0 FROM orders),
w AS (SELECT t0, count(qty) AS n, {_mean('qty')} AS mean_qty, CAST(max(price) AS DOUBLE) AS max_price,
 {_std('price')} AS std_price FROM t LEFT JOIN s
 ON l_shipdate BETWEEN t0 + INTERVAL 24 HOUR AND t0 + INTERVAL 72 HOUR GROUP BY t0)
SELECT o_orderkey, n, mean_qty, max_price, std_price FROM orders JOIN w ON t0 = o_orderdate""",
    "interval_stats_large_decimals": f"""
WITH {_A}, s AS (SELECT ts, 1000000000000 + CAST(value AS DECIMAL(12,2)) AS value FROM events WHERE event_type = 'purchase')
SELECT a.event_id, count(value) AS n, (CAST(CAST(sum(value) AS VARCHAR) AS DOUBLE) / count(value)) AS mean, {_std('value')} AS sd
FROM a LEFT JOIN s ON s.ts BETWEEN a.ts - INTERVAL 744 HOUR AND a.ts + INTERVAL 744 HOUR GROUP BY a.event_id""",
    "interval_stats_close_doubles": f"""
WITH {_A}, s AS (SELECT ts, CAST(CAST(value AS DECIMAL(12,2)) * 100 AS HUGEINT) AS h FROM events WHERE event_type = 'purchase')
SELECT a.event_id, count(h) AS n, round(1000000000 + CAST(sum(h) AS DOUBLE) / count(h) / 8388608, 5) AS mean,
round(CASE WHEN count(h) > 0 THEN sqrt(CAST(CAST(count(h) * sum(h * h) - sum(h) * sum(h) AS VARCHAR) AS DOUBLE)) / count(h) / 8388608 END, 14) AS sd
FROM a LEFT JOIN s ON s.ts BETWEEN a.ts - INTERVAL 744 HOUR AND a.ts + INTERVAL 744 HOUR GROUP BY a.event_id""",
    "interval_stats_one_year": f"""
WITH s AS (SELECT l_shipdate, count(*) AS c, sum(p) AS p, sum(h) AS h, sum(h * h) AS hh, min(p) AS lo, max(p) AS hi
 FROM (SELECT l_shipdate, CAST(l_extendedprice AS DECIMAL(12,2)) AS p, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS HUGEINT) AS h FROM lineitem) GROUP BY 1),
t AS (SELECT DISTINCT o_orderdate AS t0 FROM orders),
w AS (SELECT t0, CAST(coalesce(sum(c), 0) AS BIGINT) AS n, CAST(sum(p) AS DOUBLE) / sum(c) AS mean, CAST(min(lo) AS DOUBLE) AS lo,
 CAST(max(hi) AS DOUBLE) AS hi, CASE WHEN sum(c) > 0 THEN sqrt(CAST(CAST(sum(c) * sum(hh) - sum(h) * sum(h) AS VARCHAR) AS DOUBLE)) / sum(c) / 100 END AS sd
 FROM t LEFT JOIN s ON l_shipdate BETWEEN t0 AND t0 + INTERVAL 8760 HOUR GROUP BY t0)
SELECT o_orderkey, n, mean, lo, hi, sd FROM orders JOIN w ON t0 = o_orderdate""",
    "interval_stats_orders_by_key": f"""
WITH s AS (SELECT l_orderkey, l_shipdate, CAST(l_extendedprice AS DECIMAL(12,2)) AS price FROM lineitem)
SELECT o_orderkey AS k, count(l_shipdate) AS n, CAST(min(price) AS DOUBLE) AS lo, {_mean('price')} AS mean
FROM orders LEFT JOIN s ON l_orderkey = o_orderkey AND l_shipdate BETWEEN o_orderdate - INTERVAL {KEYED_DAYS} DAY
AND o_orderdate + INTERVAL {KEYED_DAYS} DAY GROUP BY o_orderkey""",
}
