"""How well two series cover the events, per period, and whether a range of periods suffices."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventwin.operators.interval import Interval, interval_stats


def coverage_table(
    events: DataFrame,
    labels: DataFrame,
    series: DataFrame,
    *,
    event_time: str = "startTime",
    label_time: str = "time",
    label_value: str = "kp",
    series_time: str = "time",
    horizon_hours: float = 72,
    back_hours: float = 24,
    threshold: float = 5.0,
    period: str | None = None,
) -> DataFrame:
    """Per period: events, those with label rows ahead, those with series rows just before, and positives.

    `period` is an SQL expression over the event time, by default its year. Percentages have one
    decimal; the storm rate refers to events with label rows.
    """
    grain = period or f"year(`{event_time}`)"
    # events of one instant share their answer: look each instant up once and weight it
    instants = events.where(F.col(event_time).isNotNull()).groupBy(event_time).agg(F.expr("count(1) as _n"))
    ahead = interval_stats(instants, labels, Interval(0, horizon_hours),
                           {"_rows_ahead": ("rows", None), "_max_ahead": ("max", label_value)},
                           event_time=event_time, series_time=label_time)
    both = interval_stats(ahead, series, Interval(-back_hours, 0), {"_rows_back": ("rows", None)},
                          event_time=event_time, series_time=series_time)
    totals = both.groupBy(F.expr(f"{grain} as year")).agg(
        F.expr("sum(_n) as cme_total"),
        F.expr("sum(if(_rows_ahead > 0, _n, 0L)) as cme_with_kp"),
        F.expr("sum(if(_rows_back > 0, _n, 0L)) as cme_with_omni"),
        F.expr(f"sum(if(_max_ahead >= {float(threshold)!r}D, _n, 0L)) as storm_count"),
    )

    def pct(top: str, bottom: str) -> str:
        return f"coalesce(round(100D * {top} / nullif({bottom}, 0), 1), 0D)"

    return totals.selectExpr(
        "year", "cme_total", "cme_with_kp", f"{pct('cme_with_kp', 'cme_total')} as kp_coverage_pct",
        "cme_with_omni", f"{pct('cme_with_omni', 'cme_total')} as omni_coverage_pct",
        "storm_count", f"{pct('storm_count', 'cme_with_kp')} as storm_rate_pct")


def score_ranges(
    coverage: DataFrame,
    ranges: list[tuple],
    *,
    min_events: int = 300,
    min_storms: int = 20,
    min_label_pct: float = 85.0,
    min_series_pct: float = 85.0,
) -> DataFrame:
    """Totals, plain means of the yearly percentages and a pass flag for each (start, end) range."""
    parts = ", ".join(f"struct({i} as _i, if(year between {_lit(a)} and {_lit(b)}, true, false) as _in)"
                      for i, (a, b) in enumerate(ranges))
    bounds = {"start_year": " ".join(f"when {i} then {_lit(a)}" for i, (a, _) in enumerate(ranges)),
              "end_year": " ".join(f"when {i} then {_lit(b)}" for i, (_, b) in enumerate(ranges))}
    scored = coverage.selectExpr("*", f"inline(array({parts}))").groupBy("_i").agg(
        F.expr("coalesce(sum(if(_in, cme_total, 0L)), 0L) as total_cmes"),
        F.expr("coalesce(sum(if(_in, storm_count, 0L)), 0L) as total_storms"),
        # one-decimal percentages summed as DECIMAL, so the mean does not depend on row order
        F.expr("coalesce(cast(sum(if(_in, cast(kp_coverage_pct as decimal(9,1)), null)) as double) / "
               "nullif(count_if(_in), 0), 0D) as kp"),
        F.expr("coalesce(cast(sum(if(_in, cast(omni_coverage_pct as decimal(9,1)), null)) as double) / "
               "nullif(count_if(_in), 0), 0D) as om"),
    )
    return scored.selectExpr(
        *[f"case _i {whens} end as {name}" for name, whens in bounds.items()], "total_cmes", "total_storms",
        "round(kp, 1) as avg_kp_coverage_pct", "round(om, 1) as avg_omni_coverage_pct",
        f"total_cmes >= {min_events} and total_storms >= {min_storms} and kp >= {min_label_pct}D "
        f"and om >= {min_series_pct}D as passes_thresholds")


def _lit(value) -> str:
    return str(value) if isinstance(value, int) else f"'{value}'"
