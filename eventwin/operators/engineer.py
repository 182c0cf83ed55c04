"""From the labelled event table to model features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from eventwin.functions.events import add_interaction_terms
from eventwin.operators import clean
from eventwin.operators.scan import quantile

# Columns that never become features.
NO_SIGNAL = ("analysis_note", "activityID", "link", "note", "sourceLocation", "analysis_isMostAccurate")
REDUNDANT = tuple(f"omni_w24_72_{s}_Efield" for s in ("mean", "min", "max", "std"))
LEAKS_LABEL = ("kp_max_h72",)


def clip_at_quantile(df: DataFrame, column: str, prob: float = 0.99, fit_on: DataFrame | None = None) -> DataFrame:
    """Cap `column` at an exact quantile of `fit_on` (default: of the table itself); missing stays missing."""
    cap = quantile(fit_on if fit_on is not None else df, column, prob)
    return df.withColumn("_cap", cap).withColumn(
        column, F.expr(f"if(`{column}` > _cap, _cap, `{column}`)")).drop("_cap")


def engineer_features(
    df: DataFrame,
    *,
    time: str = "startTime",
    window_prefix: str = "omni_",
    speed: str = "analysis_speed",
    keep: Sequence[str] = (),
    type_levels: Sequence[str] | None = None,
    clip_fit_on: str | None = None,
) -> DataFrame:
    """Year, dropped columns, region flag, type one-hot, rows without any window value dropped,
    interaction terms, speed capped at its 99th percentile: in this order.

    `keep` names id columns to carry along although they are no features. `type_levels` fixes the
    one-hot levels instead of reading them from the data. The cap is taken over all remaining rows,
    or over those matching the SQL condition `clip_fit_on` (for example `year <= 2020`).
    """
    out = df.withColumn("year", F.year(time))
    out = out.drop(*[c for c in (*NO_SIGNAL, *REDUNDANT, *LEAKS_LABEL) if c not in keep])
    if "activeRegionNum" in out.columns:
        out = clean.presence_flag(out, "activeRegionNum", "has_active_region")
    if "analysis_type" in out.columns:
        out = clean.merge_categories(out, "analysis_type", missing="S", merge={"R": "O"})
        out = clean.one_hot(out, "analysis_type", "cme_type", type_levels)
    out = clean.drop_all_missing(out, [c for c in out.columns if c.startswith(window_prefix)])
    out = add_interaction_terms(out)
    if speed in out.columns:
        base = out.where(clip_fit_on) if clip_fit_on else out
        out = clip_at_quantile(out, speed, 0.99, base)
    return out
