"""Reading the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def typed_events(spark: SparkSession, folder: str, kind: str, *columns: str) -> DataFrame:
    return table(spark, folder, "events").where(f"event_type = '{kind}'").selectExpr(*columns)


def ranked_quantiles(source: str, value: str, probs: list[float], by: tuple[str, ...] = ()) -> str:
    """DuckDB subquery (by…, prob, value, n): quantiles interpolated between two sorted rows."""
    groups = "".join(f"{c}, " for c in by)
    over = f"PARTITION BY {', '.join(by)} " if by else ""
    wanted = ", ".join(f"CAST({p} AS DOUBLE)" for p in probs)
    return f"""(SELECT {groups}prob, max(a) + (max(b) - max(a)) * max(d) AS value, max(n) AS n FROM (
SELECT {groups}prob, n, CASE WHEN rn = floor((n - 1) * prob) THEN x END AS a, CASE WHEN rn = ceil((n - 1) * prob) THEN x END AS b,
(n - 1) * prob - floor((n - 1) * prob) AS d FROM (
SELECT {groups}CAST({value} AS DOUBLE) AS x, row_number() OVER ({over}ORDER BY {value}) - 1 AS rn, count(*) OVER ({over}) AS n
FROM {source} WHERE {value} IS NOT NULL) CROSS JOIN (SELECT unnest([{wanted}]) AS prob)) GROUP BY {groups}prob)"""


def ranked_quantile(source: str, value: str, prob: float) -> str:
    return f"(SELECT value FROM {ranked_quantiles(source, value, [prob])})"
