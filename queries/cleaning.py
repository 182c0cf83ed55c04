"""Lenient casts, fill values, ranges, copies, flags and categories."""

from __future__ import annotations

from eventwin.functions.parse import fills_to_null, to_numbers, utc_time
from eventwin.functions.times import time_micros
from eventwin.operators import clean
from queries.tables import table

ITEM_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus")


def fills(spark, d):
    items = table(spark, d, "lineitem").select(*ITEM_KEY)
    return fills_to_null(items, ["l_tax", "l_discount", "l_quantity"],
                         {"l_tax": [0.0, 0.08], "l_discount": [0.05], "l_quantity": [50.0, 999.9]})


def ranges(spark, d):
    items = table(spark, d, "lineitem").selectExpr("l_orderkey", "l_partkey", "nullif(l_tax, 0D) as tax", "l_quantity")
    return clean.keep_between(items, {"tax": (0.02, 0.05), "l_quantity": (10, 20)})


def numbers(spark, d):
    text = table(spark, d, "orders").selectExpr(
        "o_orderkey", "case o_orderkey % 5 when 0 then 'n/a' when 1 then concat(' ', o_totalprice, ' ') "
        "when 2 then concat(o_totalprice, 'd') when 3 then 'NaN' else cast(o_totalprice as string) end as price")
    return to_numbers(text, exclude=["o_orderkey"])


def times(spark, d):
    text = table(spark, d, "orders").selectExpr(
        "o_orderkey", "case o_orderkey % 5 when 0 then date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm'Z'\") "
        "when 1 then date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') when 2 then 'unknown' "
        "when 3 then date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") "
        "else date_format(o_orderdate, 'MM/dd/yyyy') end as t")
    parsed = text.withColumn("t", utc_time("t"))
    return parsed.select("o_orderkey", time_micros(parsed, "t").alias("us"))


def first_per_time(spark, d):
    first = clean.keep_first(table(spark, d, "lineitem"), ["l_shipdate"], ITEM_KEY)
    return first.select(*ITEM_KEY, time_micros(first, "l_shipdate").alias("us"))


def _measures(spark, d):
    return table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "nullif(l_tax, 0D) as w_tax",
        "if(l_discount > 0.03D, null, l_discount) as w_discount", "if(l_quantity > 15D, null, l_quantity) as w_qty")


def all_missing(spark, d):
    rows = _measures(spark, d)
    return clean.drop_all_missing(rows, [c for c in rows.columns if c.startswith("w_")])


def any_of(spark, d):
    return clean.any_present(_measures(spark, d), ["w_discount", "w_qty", "w_absent"], "covered")


def flag(spark, d):
    return clean.presence_flag(_measures(spark, d), "w_qty", "has_qty")


def categories(spark, d):
    orders = table(spark, d, "orders").selectExpr("o_orderkey", "nullif(left(o_orderpriority, 1), '5') as kind")
    merged = clean.merge_categories(orders, "kind", missing="3", merge={"4": "2"})
    return clean.one_hot(merged, "kind", "kind")


def renamed(spark, d):
    raw = table(spark, d, "events").selectExpr("event_id", "unix_micros(cast(ts as timestamp)) as UTC_Time",
                                               "value as Kp_Index")
    return clean.rename_aliases(raw, {"time": ("utc_time", "time"), "kp": ("kp", "kp_index")})


def matrix(spark, d):
    orders = table(spark, d, "orders").selectExpr(
        "o_orderkey", "year(o_orderdate) as year", "o_totalprice as feat_price", "o_custkey as feat_cust",
        "o_orderstatus = 'F' as label_storm")
    return clean.features_and_label(orders, keys=["o_orderkey"])


QUERIES = {
    "sentinel_to_null": fills, "range_clean": ranges, "lenient_numbers": numbers, "lenient_times": times,
    "dedupe_first": first_per_time, "all_null_group_drop": all_missing, "any_of_flag": any_of, "presence_flag": flag,
    "category_merge_onehot": categories, "alias_rename": renamed, "features_and_label": matrix,
}

_KEYS = ", ".join(ITEM_KEY)
_MEASURES = """m AS (SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_tax, 0) AS w_tax,
CASE WHEN l_discount > 0.03 THEN NULL ELSE l_discount END AS w_discount,
CASE WHEN l_quantity > 15 THEN NULL ELSE l_quantity END AS w_qty FROM lineitem)"""

ORACLES = {
    "sentinel_to_null": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_quantity, 50) AS l_quantity,
l_extendedprice, nullif(l_discount, 0.05) AS l_discount, nullif(nullif(l_tax, 0), 0.08) AS l_tax, l_returnflag,
l_linestatus FROM lineitem""",
    "range_clean": """SELECT l_orderkey, l_partkey, l_tax AS tax, l_quantity FROM lineitem
WHERE l_tax BETWEEN 0.02 AND 0.05 AND l_quantity BETWEEN 10 AND 20""",
    "lenient_numbers": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (1, 4) THEN o_totalprice END AS price
FROM orders""",
    "lenient_times": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (0, 1, 3) THEN epoch_us(o_orderdate) END AS us
FROM orders""",
    "dedupe_first": f"""SELECT {_KEYS}, epoch_us(l_shipdate) AS us FROM (SELECT *, row_number() OVER (PARTITION BY l_shipdate ORDER BY {_KEYS}) AS rn
FROM lineitem) WHERE rn = 1""",
    "all_null_group_drop": f"WITH {_MEASURES} SELECT * FROM m WHERE coalesce(w_tax, w_discount, w_qty) IS NOT NULL",
    "any_of_flag": f"WITH {_MEASURES} SELECT *, w_discount IS NOT NULL OR w_qty IS NOT NULL AS covered FROM m",
    "presence_flag": f"""WITH {_MEASURES} SELECT l_orderkey, l_linenumber, l_partkey, w_tax, w_discount,
CAST(w_qty IS NOT NULL AS INTEGER) AS has_qty FROM m""",
    "category_merge_onehot": """SELECT o_orderkey,
CAST(substr(o_orderpriority, 1, 1) IN ('2', '4') AS INTEGER) AS kind_2,
CAST(substr(o_orderpriority, 1, 1) IN ('3', '5') AS INTEGER) AS kind_3 FROM orders""",
    "alias_rename": 'SELECT event_id, epoch_us(ts) AS "time", value AS kp FROM events',
    "features_and_label": """SELECT o_orderkey, o_totalprice AS feat_price, o_custkey AS feat_cust,
CAST(o_orderstatus = 'F' AS INTEGER) AS label_storm FROM orders""",
}
