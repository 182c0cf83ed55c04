"""Row-wise features of events, and terms derived from window statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventwin.functions.times import minutes_between

FAST_SPEED = 1000.0  # km/s


def _clock(df: DataFrame, time: str) -> DataFrame:
    return df.withColumns({"start_hour": F.hour(time), "start_dow": F.weekday(time)})  # Monday = 0


def add_event_features(df: DataFrame, *, speed: str = "analysis_speed", latitude: str = "analysis_latitude",
                       time: str = "startTime") -> DataFrame:
    """log_speed, is_fast_cme, abs_latitude, start_hour, start_dow: each only if its source column exists."""
    if speed in df.columns:
        df = df.withColumns({
            "log_speed": F.expr(f"log1p(`{speed}`)"),
            "is_fast_cme": F.expr(f"cast(coalesce(`{speed}` > {FAST_SPEED}D, false) as tinyint)"),
        })
    if latitude in df.columns:
        df = df.withColumn("abs_latitude", F.abs(latitude))
    return _clock(df, time) if time in df.columns else df


def add_flare_features(df: DataFrame, *, begin: str = "beginTime", end: str = "endTime") -> DataFrame:
    """flare_duration_min, start_hour, start_dow: each only if its source columns exist."""
    if begin in df.columns and end in df.columns:
        df = df.withColumn("flare_duration_min", minutes_between(df, begin, end))
    return _clock(df, begin) if begin in df.columns else df


def add_interaction_terms(df: DataFrame, *, prefix: str = "omni_w24_72", speed: str = "analysis_speed",
                          width: str = "analysis_halfAngle") -> DataFrame:
    """Southward depth, ram proxy, variability ratio, coupling and energy footprint.

    A term is added when all its inputs exist; missing values stay missing.
    """
    low_bz, sd_bz, b = f"{prefix}_min_Bz_gsm", f"{prefix}_std_Bz_gsm", f"{prefix}_mean_Bmag"
    v, density = f"{prefix}_mean_V", f"{prefix}_mean_Np"
    depth = f"if(`{low_bz}` is null, null, greatest(-`{low_bz}`, 0D))"  # greatest alone would skip the null
    terms = {
        "feat_bz_south_depth": ([low_bz], depth),
        "feat_sw_ram_proxy": ([v, density], f"`{v}` * `{v}` * `{density}` / 1e6D"),
        "feat_bz_variability_ratio": ([sd_bz, b], f"`{sd_bz}` / nullif(`{b}`, 0)"),
        "feat_coupling": ([low_bz, v], f"`{v}` * {depth} / 1e4D"),
        "feat_cme_energy": ([speed, width], f"`{speed}` * `{width}` / 1e4D"),
    }
    return df.withColumns({n: F.expr(e) for n, (needs, e) in terms.items() if set(needs) <= set(df.columns)})
