"""Row-wise features, derived terms and the whole engineering step."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventwin.functions.events import add_event_features, add_flare_features, add_interaction_terms
from eventwin.functions.parse import class_strength
from eventwin.functions.times import from_date_and_hours, from_year_day, time_micros
from eventwin.operators.engineer import clip_at_quantile, engineer_features
from eventwin.operators.metrics import threshold_rule
from queries.tables import ranked_quantile, table

KEY = ("l_orderkey", "l_linenumber", "l_partkey")
_CLASS = "concat(substring('ABCMXZm', 1 + cast(l_partkey % 7 as int), 1), l_quantity)"


def strength(spark, d):
    rows = table(spark, d, "lineitem").selectExpr(*KEY, f"if(l_partkey % 11 = 0, 'M', {_CLASS}) as class")
    return rows.withColumn("strength", class_strength("class"))


def event_features(spark, d):
    rows = table(spark, d, "lineitem").selectExpr(
        *KEY, "if(l_linenumber = 3, null, l_extendedprice / 50) as analysis_speed",
        "l_quantity - 25 as analysis_latitude", "l_shipdate + make_dt_interval(0, l_linenumber) as startTime")
    out = add_event_features(rows)
    return out.withColumn("log_speed", F.expr("round(log_speed, 9)")).drop("startTime")


def flare_features(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    items = table(spark, d, "lineitem").selectExpr(*KEY, "l_shipdate + make_dt_interval(0, 0, l_linenumber) as endTime")
    both = items.join(orders, items.l_orderkey == orders.o_orderkey).withColumnRenamed("o_orderdate", "beginTime")
    return add_flare_features(both).drop("o_orderkey", "beginTime", "endTime")


_WINDOWS = ("(l_quantity - 25) as omni_w24_72_min_Bz_gsm", "l_discount as omni_w24_72_std_Bz_gsm",
            "l_tax as omni_w24_72_mean_Bmag", "l_quantity * 20 as omni_w24_72_mean_V",
            "cast(l_linenumber as double) as omni_w24_72_mean_Np")


def interaction_terms(spark, d):
    rows = table(spark, d, "lineitem").selectExpr(
        *KEY, *_WINDOWS, "l_extendedprice / 50 as analysis_speed", "l_quantity as analysis_halfAngle")
    return add_interaction_terms(rows).select(*KEY, "feat_bz_south_depth", "feat_sw_ram_proxy",
                                              "feat_bz_variability_ratio", "feat_coupling", "feat_cme_energy")


def clip_p99(spark, d):
    rows = table(spark, d, "lineitem").selectExpr(*KEY, "if(l_linenumber = 2, null, l_extendedprice) as speed")
    return clip_at_quantile(rows, "speed")


def build_time(spark, d):
    rows = table(spark, d, "events").selectExpr(
        "event_id", "year(ts) as y", "dayofyear(ts) as doy", "month(ts) as m", "day(ts) as dd", "hour(ts) as h",
        "minute(ts) as mi")
    built = rows.withColumns({
        "a": from_year_day(F.col("y"), F.col("doy"), F.col("h"), F.col("mi")),
        "b": from_date_and_hours(F.col("y"), F.col("m"), F.col("dd"), F.expr("h + 0.5D")),
    })
    return built.select("event_id", time_micros(built, "a").alias("from_doy"), time_micros(built, "b").alias("from_hours"))


def engineered(spark, d):
    rows = table(spark, d, "lineitem").selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as activityID", "l_shipdate as startTime",
        "'text' as note", "nullif(l_linenumber, 1) as activeRegionNum",
        "case l_returnflag when 'A' then null when 'N' then 'C' else if(l_linenumber = 2, 'R', 'S') end as analysis_type",
        "l_extendedprice / 50 as analysis_speed", "l_quantity as analysis_halfAngle", "6D as kp_max_h72",
        "if(l_linestatus = 'F', 1, 0) as label_storm", "1D as omni_w24_72_mean_Efield",
        "if(l_suppkey % 5 = 0, null, l_quantity - 25) as omni_w24_72_min_Bz_gsm",
        "if(l_suppkey % 5 = 0, null, l_quantity * 20) as omni_w24_72_mean_V")
    return engineer_features(rows, keep=["activityID"]).drop("startTime")


def rule(spark, d):
    rows = table(spark, d, "lineitem").selectExpr(*KEY, "if(l_linenumber = 1, null, l_quantity) as q", "l_extendedprice as p")
    return threshold_rule(rows, {"q": 12.0}, {"p": 20000.0})


QUERIES = {
    "class_strength": strength, "event_features": event_features, "flare_features": flare_features,
    "interaction_terms": interaction_terms, "clip_p99": clip_p99, "build_time": build_time,
    "engineer_features": engineered, "threshold_rule": rule,
}

_K = "l_orderkey, l_linenumber, l_partkey"
_P99 = ranked_quantile("c", "s", 0.99)
_DEPTH = "CASE WHEN {bz} IS NOT NULL THEN greatest(-({bz}), CAST(0 AS DOUBLE)) END"

ORACLES = {
    "class_strength": f"""WITH c AS (SELECT {_K}, l_quantity, CASE WHEN l_partkey % 11 = 0 THEN 'M' ELSE
substr('ABCMXZm', CAST(1 + l_partkey % 7 AS INTEGER), 1) || CAST(l_quantity AS VARCHAR) END AS class FROM lineitem)
SELECT {_K}, class, CASE WHEN length(class) < 2 THEN NULL ELSE
CASE upper(substr(class, 1, 1)) WHEN 'A' THEN CAST(1e-4 AS DOUBLE) WHEN 'B' THEN 1e-3 WHEN 'C' THEN 1e-2 WHEN 'M' THEN 1e-1
WHEN 'X' THEN 1.0 END * l_quantity END AS strength FROM c""",
    "event_features": f"""WITH c AS (SELECT {_K}, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice / 50 END AS s,
l_quantity - 25 AS lat, l_shipdate + to_hours(l_linenumber) AS t FROM lineitem)
SELECT {_K}, s AS analysis_speed, lat AS analysis_latitude, round(ln(1 + s), 9) AS log_speed,
CAST(coalesce(s > 1000, false) AS TINYINT) AS is_fast_cme, abs(lat) AS abs_latitude,
CAST(hour(t) AS INTEGER) AS start_hour, CAST(isodow(t) - 1 AS INTEGER) AS start_dow FROM c""",
    "flare_features": f"""SELECT {_K}, CAST(epoch_us(l_shipdate + to_minutes(l_linenumber)) - epoch_us(o_orderdate) AS DOUBLE)
/ 60000000 AS flare_duration_min, CAST(hour(o_orderdate) AS INTEGER) AS start_hour,
CAST(isodow(o_orderdate) - 1 AS INTEGER) AS start_dow FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "interaction_terms": f"""SELECT {_K}, greatest(-(l_quantity - 25), CAST(0 AS DOUBLE)) AS feat_bz_south_depth,
(l_quantity * 20) * (l_quantity * 20) * CAST(l_linenumber AS DOUBLE) / CAST(1e6 AS DOUBLE) AS feat_sw_ram_proxy,
l_discount / nullif(l_tax, 0) AS feat_bz_variability_ratio,
(l_quantity * 20) * greatest(-(l_quantity - 25), CAST(0 AS DOUBLE)) / CAST(1e4 AS DOUBLE) AS feat_coupling,
(l_extendedprice / 50) * l_quantity / CAST(1e4 AS DOUBLE) AS feat_cme_energy FROM lineitem""",
    "clip_p99": f"""WITH c AS (SELECT {_K}, CASE WHEN l_linenumber = 2 THEN NULL ELSE l_extendedprice END AS s FROM lineitem)
SELECT {_K}, CASE WHEN s > {_P99} THEN {_P99} ELSE s END
AS speed FROM c""",
    "build_time": """SELECT event_id, epoch_us(date_trunc('minute', ts)) AS from_doy,
epoch_us(date_trunc('hour', ts)) + 1800000000 AS from_hours FROM events""",
    "engineer_features": f"""WITH c AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS activityID,
CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_linenumber <> 1 AS INTEGER) AS has_active_region,
CASE l_returnflag WHEN 'A' THEN 'S' WHEN 'N' THEN 'C' ELSE CASE WHEN l_linenumber = 2 THEN 'O' ELSE 'S' END END AS kind,
l_extendedprice / 50 AS s, l_quantity AS w, CAST(l_linestatus = 'F' AS INTEGER) AS label_storm,
l_quantity - 25 AS bz, l_quantity * 20 AS v FROM lineitem WHERE l_suppkey % 5 <> 0)
SELECT activityID, year, has_active_region, CAST(kind = 'O' AS INTEGER) AS "cme_type_O", CAST(kind = 'S' AS INTEGER) AS "cme_type_S",
least(s, {_P99}) AS analysis_speed, w AS "analysis_halfAngle", label_storm,
bz AS "omni_w24_72_min_Bz_gsm", v AS "omni_w24_72_mean_V", {_DEPTH.format(bz='bz')} AS feat_bz_south_depth,
v * ({_DEPTH.format(bz='bz')}) / CAST(1e4 AS DOUBLE) AS feat_coupling, s * w / CAST(1e4 AS DOUBLE) AS feat_cme_energy
FROM c""",
    "threshold_rule": f"""SELECT {_K}, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS q, l_extendedprice AS p,
CAST(coalesce(CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END < 12 AND l_extendedprice > 20000, false) AS INTEGER)
AS prediction FROM lineitem""",
}
