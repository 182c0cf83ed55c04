"""Event and flare catalogues from JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventwin.functions.parse import class_strength, number, utc_time
from eventwin.sources.json_arrays import read_json_array
from eventwin.sources.schemas import ANALYSIS_FIELDS, EVENT_JSON, FLARE_JSON


def parse_events(raw: DataFrame, *, pick: str = "first") -> DataFrame:
    """One row per event with its first analysis as `analysis_*` columns.

    `raw` has the EVENT_JSON layout. `pick="flagged"` prefers the first analysis marked most
    accurate over the first of all.
    """
    if pick not in ("first", "flagged"):
        raise ValueError("pick must be 'first' or 'flagged'")
    chosen = "get(cmeAnalyses, 0)"
    if pick == "flagged":
        chosen = f"coalesce(get(filter(cmeAnalyses, a -> lower(a.isMostAccurate) = 'true'), 0), {chosen})"
    casts = {"type": "{}", "note": "{}", "isMostAccurate": "try_cast({} as boolean)"}
    analysis = []
    for f in ANALYSIS_FIELDS:
        source = f"_a.{f}"
        analysis.append(f"{casts[f].format(source) if f in casts else number(source)} as analysis_{f}")
    return raw.withColumn("_a", F.expr(chosen)).withColumn("startTime", utc_time("startTime")).selectExpr(
        "activityID", "startTime", "sourceLocation", f"{number('activeRegionNum')} as activeRegionNum", "note", "link",
        *analysis)


def _objects(spark: SparkSession, path: str, schema: str, multi_line: bool) -> DataFrame:
    return read_json_array(spark, path, schema) if multi_line else spark.read.schema(schema).json(path)


def read_events(spark: SparkSession, path: str, *, pick: str = "first", multi_line: bool = True) -> DataFrame:
    """Event catalogue: JSON arrays, read in byte ranges, or one object per line with `multi_line=False`."""
    return parse_events(_objects(spark, path, EVENT_JSON, multi_line), pick=pick)


def parse_flares(raw: DataFrame) -> DataFrame:
    """Times parsed, `flare_strength` added; `raw` has the FLARE_JSON layout."""
    times = raw.withColumns({c: utc_time(c) for c in ("beginTime", "peakTime", "endTime")})
    return times.withColumn("activeRegionNum", F.expr(number("activeRegionNum"))).withColumn(
        "flare_strength", class_strength("classType"))


def read_flares(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    return parse_flares(_objects(spark, path, FLARE_JSON, multi_line))
