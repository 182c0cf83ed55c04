"""Text layouts written from the given tables by Spark and read back by the parsers."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from eventwin.functions.times import time_micros
from eventwin.session import shared_dir
from eventwin.sources.catalogues import parse_events, parse_flares
from eventwin.sources.schemas import EVENT_JSON, FLARE_JSON, SOLAR_WIND_COLUMNS
from eventwin.sources.series import (
    combine_series, judge_solar_wind_lines, line_report, parse_kp, parse_kp_lines, parse_solar_wind_lines, parse_wide_series, trim_series, write_judged)
from queries.tables import table, typed_events


def fixed_width(spark, d):
    lines = table(spark, d, "orders").selectExpr(
        "o_orderkey", "if(o_orderkey % 17 = 0, '# comment', if(o_orderkey % 19 = 0, date_format(o_orderdate, 'yyyy MM dd'), "
        "rpad(concat(date_format(o_orderdate, 'yyyy MM dd'), lpad(format_string('%.1f', cast(o_orderkey % 8 * 3 as double)), "
        "5, ' ')), 46, ' ') || lpad(format_string('%.3f', cast(o_orderkey % 28 as double) / 3), 6, ' '))) as value")
    garbage = "case when o_orderkey % 23 = 0 then overlay(value placing '9e99' from 1) when o_orderkey % 29 = 0 then overlay(value placing '9e99' from 12) else value end"
    parsed = parse_kp_lines(lines.selectExpr(f"{garbage} as value"), "1996-01-01", "1999-12-31")
    return parsed.select(time_micros(parsed, "time").alias("us"), "kp")


_MEASURES = SOLAR_WIND_COLUMNS[4:]
# positions (after year, day, hour and minute) with an own source; all others hold eighths that differ from place to place
_CELLS = {13: "l_quantity", 21: "l_extendedprice", 25: "l_discount", 37: "l_linenumber", 41: "l_tax"}
#: Positions on a line that ends early.
_SHORT = 38


def _eighths(i: int, divide: str) -> str:
    return f"(l_orderkey * {i} + l_linenumber) % 797 {divide}"


def _line_text():
    """Function of (ends early, l_orderkey, l_linenumber, first four words, words of _CELLS): a line's words as `concat_ws` joins them.

    Spark takes longer to turn a line's 45 eighths into text than to parse them.
    """
    eighths = [str(n / 8) for n in range(-796, 797)]

    @F.arrow_udf("string")
    def text(early: pa.Array, key: pa.Array, line: pa.Array, *words: pa.Array) -> pa.Array:
        late, line, table = pc.if_else(early, None, key), line.cast(pa.int64()), pa.array(eighths)
        own = dict(zip(_CELLS, words[4:], strict=True))

        def cell(i):
            if i in own:
                return own[i] if i < _SHORT else pc.if_else(early, None, own[i])
            n = pc.add_checked(pc.multiply_checked(key if i < _SHORT else late, i), line)
            return table.take(pa.array(np.fmod(n.fill_null(0).to_numpy(), 797) + 796, mask=n.is_null().to_numpy(zero_copy_only=False)))

        return pc.binary_join_element_wise(*words[:4], *map(cell, range(4, 54)), pc.if_else(early, "  ", " "), null_handling="skip")

    return text


def _lines(items):
    """`value`: full, short and header lines of line items, some with fill values."""
    words = ["year(l_shipdate)", "dayofyear(l_shipdate)", "l_linenumber", "cast(l_quantity as int)", "if(l_partkey % 3 = 0, '99.99', cast(l_quantity as string))",
             "if(l_partkey % 5 = 0, '99999.9', cast(l_extendedprice as string))", "l_discount", "l_linenumber", "l_tax"]
    given = ["coalesce(l_suppkey % 7 = 0, false)", "if(l_suppkey % 13 = 0, null, l_orderkey)", "l_linenumber", *(f"cast({w} as string)" for w in words)]
    return items.withColumn("_text", _line_text()(*map(F.expr, given))).selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "if(l_suppkey % 13 = 0, 'YEAR DAY HR MN', if(l_suppkey % 7 = 0, _text, concat(' ', _text))) as value")


def whitespace(spark, d):
    """All 50 measures of full, short and header lines, some with fill values."""
    parsed = parse_solar_wind_lines(_lines(table(spark, d, "lineitem")))
    return parsed.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", time_micros(parsed, "time").alias("us"), *_MEASURES)


def line_reasons(spark, d):
    """Lines of all kinds, parted in one pass; what was accepted and why others were not, counted from the written parts."""
    lines = table(spark, d, "lineitem").selectExpr("case when l_suppkey % 13 = 0 then 'YEAR DAY HR MN' when l_suppkey % 29 = 0 then '  ' else concat_ws(' ', "
        "if(l_partkey % 11 = 0, 3000, year(l_shipdate)), if(l_partkey % 17 = 0, 367, dayofyear(l_shipdate)), if(l_linenumber = 7, 'x', cast(l_linenumber as string)), "
        "cast(l_quantity as int) + if(l_partkey % 19 = 0, 60, 0), l_extendedprice) end as value")
    accepted, rejected = write_judged(judge_solar_wind_lines(lines), f"{shared_dir(spark)}/judged-{uuid.uuid4().hex}")
    return line_report(accepted.selectExpr("cast(null as string) as reason")).unionByName(line_report(rejected))


def _measure_sql(i: int, name: str) -> str:
    given = {13: "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_quantity END", 21: "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_extendedprice END"}
    source = f"CAST({given.get(i) or _CELLS.get(i) or _eighths(i, '/ CAST(8 AS DOUBLE)')} AS DOUBLE)"
    return f'CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE {source} END AS "{name}"' if i >= _SHORT else f'{source} AS "{name}"'


def first_analysis(spark, d):
    docs = table(spark, d, "orders").selectExpr(
        "to_json(struct(cast(o_orderkey as string) as activityID, "
        "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm'Z'\") as startTime, o_orderpriority as note, "
        "if(o_orderkey % 4 = 0, null, o_custkey) as activeRegionNum, "
        "case o_orderkey % 3 when 0 then array() when 1 then null else array("
        "struct(if(o_orderkey % 7 = 0, 'fast', cast(o_totalprice as string)) as speed, o_orderstatus as type, "
        "cast(o_custkey as double) as latitude, -1.5D as longitude, o_custkey / 2 as halfAngle, false as isMostAccurate, o_orderpriority as note), "
        "struct('1.5' as speed, 'C' as type, 2D as latitude, 3D as longitude, 4D as halfAngle, true as isMostAccurate, 'b' as note)) end as cmeAnalyses, "
        "concat('N', o_custkey) as sourceLocation, concat('x://', o_custkey) as link)) as doc")
    raw = docs.select(F.from_json("doc", EVENT_JSON).alias("r")).select("r.*")
    first, flagged = parse_events(raw), parse_events(raw, pick="flagged").selectExpr("activityID", "analysis_speed as flagged_speed")
    return first.select("activityID", time_micros(first, "startTime").alias("us"), "activeRegionNum", "note",
                        "sourceLocation", "link", "analysis_speed", "analysis_type", "analysis_latitude", "analysis_longitude",
                        "analysis_halfAngle", "analysis_note", "analysis_isMostAccurate").join(
        flagged, "activityID")


def flares(spark, d):
    docs = table(spark, d, "orders").selectExpr(
        "to_json(struct(cast(o_orderkey as string) as flrID, date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm'Z'\") as beginTime, "
        "date_format(o_orderdate + interval 7 minutes, 'yyyy-MM-dd HH:mm:ss') as peakTime, "
        "if(o_orderkey % 5 = 0, null, date_format(o_orderdate + interval 1 hour, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")) as endTime, "
        "o_orderpriority as sourceLocation, concat('x://', o_custkey) as link, "
        "concat(substring('CMX', 1 + cast(o_orderkey % 3 as int), 1), o_custkey % 10) as classType, "
        "o_custkey as activeRegionNum)) as doc")
    parsed = parse_flares(docs.select(F.from_json("doc", FLARE_JSON).alias("r")).select("r.*"))
    return parsed.select("flrID", time_micros(parsed, "beginTime").alias("us"), time_micros(parsed, "peakTime").alias("peak_us"),
                         time_micros(parsed, "endTime").alias("end_us"), "classType", "sourceLocation", "activeRegionNum", "link",
                         "flare_strength")


def kp_table(spark, d):
    raw = table(spark, d, "events").selectExpr(
        "cast(ts as string) as DateTime", "if(event_id % 9 = 0, '', cast(value / 10 as string)) as Kp_Index")
    parsed = parse_kp(raw)
    return parsed.select(time_micros(parsed, "time").alias("us"), "kp")


def wide_table(spark, d):
    raw = table(spark, d, "events").selectExpr(
        "if(event_id % 10 = 0, 'never', cast(ts as string)) as UTC_TIME", "cast(value as string) as V",
        "get_json_object(props, '$.k') as Np", "event_type as T")
    parsed = parse_wide_series(raw)
    return parsed.select(time_micros(parsed, "time").alias("us"), "V", "Np", "T")


KINDS = ("click", "error", "purchase", "signup", "view")


def combined(spark, d):
    parts = [typed_events(spark, d, kind, "date_trunc('HOUR', ts) as time", "value as V") for kind in KINDS]
    out = combine_series(*parts)
    return out.select(time_micros(out, "time").alias("us"), "V")


def trimmed(spark, d):
    raw = table(spark, d, "events").selectExpr("unix_micros(cast(ts as timestamp)) as time", "cast(value as decimal(12,2)) as V",
                                               "event_type as other", "event_id as Np")
    return trim_series(raw)


QUERIES = {
    "line_reasons": line_reasons,
    "fixed_width_parse": fixed_width, "whitespace_parse": whitespace, "json_first_element": first_analysis,
    "flare_json": flares, "kp_table_parse": kp_table, "wide_table_parse": wide_table, "combine_series": combined,
    "trim_series": trimmed,
}

ORACLES = {
    "fixed_width_parse": """SELECT epoch_us(o_orderdate + to_hours(CAST(o_orderkey % 8 * 3 AS INTEGER))) AS us,
min(CAST(format('{:.3f}', CAST(o_orderkey % 28 AS DOUBLE) / 3) AS DOUBLE)) AS kp FROM orders
WHERE o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0 AND o_orderkey % 23 <> 0 AND o_orderkey % 29 <> 0 AND o_orderdate >= DATE '1996-01-01'
AND o_orderdate + to_hours(CAST(o_orderkey % 8 * 3 AS INTEGER)) < DATE '2000-01-01' GROUP BY 1""",
    "whitespace_parse": f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
epoch_us(l_shipdate + to_hours(l_linenumber) + to_minutes(CAST(l_quantity AS INTEGER))) AS us,
{", ".join(_measure_sql(i, name) for i, name in enumerate(_MEASURES, 4))}
FROM lineitem WHERE l_suppkey % 13 <> 0 AND year(l_shipdate) BETWEEN 1995 AND 2030""",
    "line_reasons": """SELECT CASE WHEN l_suppkey % 13 = 0 THEN 'no year' WHEN l_suppkey % 29 = 0 THEN 'blank' WHEN l_linenumber = 7 THEN 'no hour'
WHEN l_partkey % 11 = 0 OR year(l_shipdate) NOT BETWEEN 1995 AND 2030 THEN 'year out of range' WHEN l_partkey % 17 = 0 THEN 'day out of range'
WHEN l_partkey % 19 = 0 THEN 'minute out of range' ELSE 'accepted' END AS reason, count(*) AS n FROM lineitem GROUP BY 1""",
    "json_first_element": """WITH c AS (SELECT *, o_orderkey % 3 = 2 AS has FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS "activityID", epoch_us(o_orderdate) AS us,
CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS "activeRegionNum", o_orderpriority AS note,
CASE WHEN has AND o_orderkey % 7 <> 0 THEN o_totalprice END AS analysis_speed,
CASE WHEN has THEN o_orderstatus END AS analysis_type, CASE WHEN has THEN CAST(o_custkey AS DOUBLE) END AS analysis_latitude,
CASE WHEN has THEN CAST(-1.5 AS DOUBLE) END AS analysis_longitude, CASE WHEN has THEN CAST(o_custkey AS DOUBLE) / 2 END AS "analysis_halfAngle",
CASE WHEN has THEN o_orderpriority END AS analysis_note, 'N' || CAST(o_custkey AS VARCHAR) AS "sourceLocation", 'x://' || CAST(o_custkey AS VARCHAR) AS link,
CASE WHEN has THEN false END AS "analysis_isMostAccurate", CASE WHEN has THEN CAST(1.5 AS DOUBLE) END AS flagged_speed FROM c""",
    "flare_json": """SELECT CAST(o_orderkey AS VARCHAR) AS "flrID", epoch_us(o_orderdate) AS us, epoch_us(o_orderdate + INTERVAL 7 MINUTE) AS peak_us,
CASE WHEN o_orderkey % 5 <> 0 THEN epoch_us(o_orderdate + INTERVAL 1 HOUR) END AS end_us, o_orderpriority AS "sourceLocation",
'x://' || CAST(o_custkey AS VARCHAR) AS link, substr('CMX', CAST(1 + o_orderkey % 3 AS INTEGER), 1) || CAST(o_custkey % 10 AS VARCHAR) AS "classType",
CAST(o_custkey AS DOUBLE) AS "activeRegionNum",
CASE o_orderkey % 3 WHEN 0 THEN CAST(1e-2 AS DOUBLE) WHEN 1 THEN 1e-1 ELSE 1.0 END * (o_custkey % 10) AS flare_strength
FROM orders""",
    "kp_table_parse": """SELECT epoch_us(ts) AS us, value / 10 AS kp FROM events
WHERE event_id % 9 <> 0 AND value / 10 BETWEEN 0 AND 9""",
    "wide_table_parse": """SELECT epoch_us(ts) AS us, value AS "V", CAST(json_extract_string(props, '$.k') AS DOUBLE) AS "Np",
CAST(NULL AS DOUBLE) AS "T" FROM events WHERE event_id % 10 <> 0""",
    "combine_series": """SELECT epoch_us(t) AS us, v AS "V" FROM (SELECT date_trunc('hour', ts) AS t, value AS v, row_number() OVER
(PARTITION BY date_trunc('hour', ts) ORDER BY event_type, value) AS rn FROM events WHERE event_type IN ('click', 'error', 'purchase', 'signup', 'view'))
WHERE rn = 1""",
    "trim_series": """SELECT epoch_us(ts) AS "time", value AS "V", CAST(event_id AS DOUBLE) AS "Np" FROM events""",
}
