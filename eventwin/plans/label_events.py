"""Raw catalogues and series to the labelled feature table and its profile."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventwin.functions.events import add_event_features
from eventwin.operators import profile
from eventwin.operators.coverage import coverage_table, score_ranges
from eventwin.operators.interval import WindowStats, forward_max_label, window_features
from eventwin.sources.sinks import land


def labelled_events(events: DataFrame, kp: DataFrame, series: DataFrame, *, spec: WindowStats = WindowStats(),
                    hours: float = 72, threshold: float = 5.0) -> DataFrame:
    """Label, event features and window statistics for every event, lazily."""
    labelled = forward_max_label(events, kp, hours=hours, threshold=threshold)
    return window_features(add_event_features(labelled), series, spec)


def build_labelled_table(events: DataFrame, kp: DataFrame, series: DataFrame, path: str, **options) -> DataFrame:
    """The labelled table, written to `path` once and read back."""
    return land(labelled_events(events, kp, series, **options), path)


def profile_labelled_table(table: DataFrame, kp: DataFrame, *, corr_columns: list[str] | None = None
                           ) -> dict[str, DataFrame]:
    """Every profile of a labelled table, by name."""
    boxes = [f"omni_w24_72_{c}" for c in ("mean_Bz_gsm", "min_Bz_gsm", "mean_V", "mean_Pdyn", "mean_Np", "mean_SYM_H")]
    return {
        "quality": profile.table_quality(table),
        "missing": profile.missing_fraction(table),
        "speed_histogram": profile.histograms(table, ["analysis_speed"], 40),
        "correlations": profile.correlations(table, corr_columns),
        "outcome_by_label": profile.histogram_by_class(table, "kp_max_h72"),
        "series_by_day": profile.series_points(kp, every="1 day"),
        "classes": profile.class_counts(table),
        "rate_by_speed": profile.rate_by_quantile_bin(table),
        "boxes": profile.box_stats(table, boxes),
        "rate_by_year": profile.rate_by_year(table),
    }


def explore_ranges(events: DataFrame, kp: DataFrame, series: DataFrame,
                   ranges: tuple[tuple[int, int], ...] = ((2015, 2023), (2017, 2023))) -> tuple[DataFrame, DataFrame]:
    """(coverage per year, sufficiency of each range of years)"""
    coverage = coverage_table(events, kp, series)
    return coverage, score_ranges(coverage, list(ranges))
