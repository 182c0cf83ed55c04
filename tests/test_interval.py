"""Interval aggregates against a brute-force reading of the definition."""

import math
import random
from datetime import datetime, timedelta
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventwin.operators import interval as I
from eventwin.operators.coverage import coverage_table

T0 = datetime(2020, 1, 1)
OUT = {"rows": ("rows", None), "n": ("count", "x"), "mean": ("mean", "x"), "lo": ("min", "x"), "hi": ("max", "x"),
       "sd": ("std", "x")}


def brute(events, series, span, keyed):
    """id -> (rows, n, mean, min, max, population std)"""
    out = {}
    for i, k, t in events:
        a, b = (t + timedelta(microseconds=span.start), t + timedelta(microseconds=span.end)) if t else (None, None)
        hit = [x for kk, tt, x in series
               if t is not None and tt is not None and (not keyed or (k is not None and kk == k)) and a <= tt <= b]
        v = [x for x in hit if x is not None and not math.isnan(x)]
        out[i] = (len(hit), len(v), *((np.mean(v), min(v), max(v), np.std(v)) if v else (None,) * 4))
    return out


def run(spark, events, series, span, keyed=False, tile=None, kind="double", parts=3):
    e = spark.createDataFrame(events, "id int, k string, t timestamp").repartition(parts)
    s = spark.createDataFrame(series, "k string, t timestamp, x double").repartition(parts + 1)
    s = s.withColumn("x", F.col("x").cast(kind)) if kind != "double" else s
    got = I.interval_stats(e, s, span, OUT, event_time="t", series_time="t", keys=["k"] if keyed else [], tile=tile)
    return {r["id"]: tuple(r[c] for c in OUT) for r in got.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for i in want:
        assert got[i][:2] == want[i][:2], i
        for g, w in zip(got[i][2:], want[i][2:]):
            assert (g is None) == (w is None) and (g is None or math.isclose(g, w, rel_tol=1e-9, abs_tol=1e-9)), (i, got[i], want[i])


def edges():
    us, h = timedelta(microseconds=1), timedelta(hours=1)
    t = datetime(2020, 3, 1, 7, 11, 13, 17)
    events = [(1, "a", t), (2, "a", t), (3, "a", None), (4, "a", datetime(1999, 1, 1)), (5, "a", datetime(2030, 1, 1)),
              (6, "a", t + 400 * h), (7, None, t), (8, "b", t)]
    spots = [t, t + 24 * h, t + 72 * h, t - 24 * h]
    series = [("a", s + d, float(i * 10 + j)) for i, s in enumerate(spots) for j, d in enumerate((-us, 0 * us, us))]
    series += [("a", t + 48 * h, 5.0), ("a", t + 48 * h, 7.0)]  # one instant twice
    series += [("a", t + 430 * h, None), ("a", t + 440 * h, float("nan")), ("a", None, 1.0), ("b", t + 30 * h, 99.0)]
    series += [("a", datetime(2020, 3, 1) + i * 24 * h, float(i)) for i in range(5)]  # on tile and chunk borders
    return events, series


@pytest.mark.parametrize("hours", [(0, 72), (24, 72), (-24, 0), (0, 0), (24, 24), (-1.5, 0.25)])
@pytest.mark.parametrize("keyed", [False, True])
def test_edges(spark, hours, keyed):
    events, series = edges()
    span = I.Interval(*hours)
    same(run(spark, events, series, span, keyed), brute(events, series, span, keyed))


@pytest.mark.parametrize("seed", range(6))
def test_random_tiles_offsets_and_partitions(spark, seed):
    rnd = random.Random(seed)
    start = rnd.randint(-50, 50)
    span = I.Interval(start / 10, (start + rnd.randint(1, 60)) / 10)
    divisors = [d for d in (1, 2, 3, 5, 10, 60, 360) if span.length % (span.length // d) == 0]
    tile = span.length // rnd.choice(divisors)  # from a single tile to hundreds
    moment = lambda: T0 + timedelta(seconds=rnd.choice([rnd.randint(-40_000, 40_000), 360 * rnd.randint(-100, 100)]))
    events = [(i, rnd.choice("ab"), moment()) for i in range(60)]
    series = [(rnd.choice("abc"), moment(), rnd.choice([None, round(rnd.uniform(-9, 9), 2)])) for _ in range(150)]
    keyed = seed % 2 == 0
    want = brute(events, series, span, keyed)
    same(run(spark, events, series, span, keyed, tile, parts=rnd.randint(1, 9)), want)
    same(run(spark, events, series, span, keyed, kind="decimal(12,2)"), want)


def test_before_1970(spark):
    t = datetime(1965, 5, 5, 5)
    events, series = [(1, "a", t)], [("a", t + timedelta(hours=i), float(i)) for i in range(-30, 90)]
    same(run(spark, events, series, I.Interval(24, 72)), brute(events, series, I.Interval(24, 72), False))


def test_spread_far_from_zero_keeps_precision(spark):
    series = [("a", T0 + timedelta(minutes=i), 1e9 + i % 3) for i in range(300)]
    got = run(spark, [(1, "a", T0)], series, I.Interval(0, 4))
    assert got[1][5] == pytest.approx(np.std([i % 3 for i in range(241)]), rel=1e-6)


def test_hot_instants_and_hot_key(spark):
    """A third of the events and of the series share one key and instant."""
    rnd = random.Random(1)
    any_time = lambda: T0 + timedelta(seconds=rnd.randint(0, 500_000))
    events = [(i, "hot" if i % 3 == 0 else rnd.choice("ab"), T0 if i % 3 == 0 else any_time()) for i in range(300)]
    series = [("hot" if i % 3 == 0 else rnd.choice("ab"), T0 if i % 3 == 0 else any_time(), float(i % 50)) for i in range(900)]
    for keyed in (False, True):
        same(run(spark, events, series, I.Interval(0, 24), keyed), brute(events, series, I.Interval(0, 24), keyed))


def test_levels_bound_window_partitions():
    """For any length a group of tiles, and the tiles of the top level in an interval, stay below a fixed number."""
    for length in [I.Interval(0, h).length for h in (1, 6, 24, 48, 72, 0.25, 4380, 8760, 87_600)] + [1, 2, 59_999_999, 1_000_000_007]:
        widths = I.tile_widths(length)
        assert widths[0] <= I.TILE and widths[-1] <= length and length // widths[-1] < I.FAN or length // widths[-1] == 1
        assert all(b == a * I.FAN for a, b in zip(widths, widths[1:]))


@pytest.mark.parametrize("fan", [2, 3, 5])
def test_many_levels(spark, fan, monkeypatch):
    """Narrow groups: short tiles, and intervals whose length no tile divides, go through several levels."""
    monkeypatch.setattr(I, "FAN", fan)
    rnd = random.Random(fan)
    moment = lambda: T0 + timedelta(microseconds=rnd.randint(-3000, 3000))
    events = [(i, rnd.choice("ab"), moment()) for i in range(80)]
    series = [(rnd.choice("abc"), moment(), rnd.choice([None, round(rnd.uniform(-9, 9), 2)])) for _ in range(300)]
    for length, tile in ((1009, 7), (997, 1), (64, 8), (63, 8), (5, 100)):
        start = rnd.randint(-500, 500)
        span = I.Interval(start / I.HOUR, (start + length) / I.HOUR)
        assert span.length == length
        same(run(spark, events, series, span, True, tile), brute(events, series, span, True))


def test_decimal_spread_of_large_values(spark):
    series = [("a", T0 + timedelta(seconds=i), float(10**12 + i % 2)) for i in range(1000)]
    assert run(spark, [(1, "a", T0)], series, I.Interval(0, 1), kind="decimal(18,2)")[1][5] == 0.5
    wide = [("a", T0 + timedelta(seconds=i), v) for i, v in enumerate((-9e17, 9e17))]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|38 digits"):
        run(spark, [(1, "a", T0)], wide * 3, I.Interval(0, 1), kind="decimal(22,2)")


def test_label(spark):
    e = spark.createDataFrame([(1, T0), (2, T0 + timedelta(days=30)), (3, None)], "id int, startTime timestamp")
    s = spark.createDataFrame([(T0 + timedelta(hours=72), 5.0), (T0 + timedelta(hours=3), float("nan"))], "time timestamp, kp double")
    got = {r["id"]: r for r in I.forward_max_label(e, s, observed="n").collect()}
    assert (got[1]["kp_max_h72"], got[1]["label_storm"], got[1]["n"]) == (5.0, 1, 1)
    assert (got[2]["kp_max_h72"], got[2]["label_storm"], got[2]["n"]) == (None, 0, 0)
    assert (got[3]["kp_max_h72"], got[3]["label_storm"], got[3]["n"]) == (None, 0, 0)


def test_window_features_names_and_absent_columns(spark):
    e = spark.createDataFrame([(1, T0)], "id int, startTime timestamp")
    s = spark.createDataFrame([(T0 + timedelta(hours=30), 2.0)], "time timestamp, V double")
    assert I.window_features(e, s).columns == ["id", "startTime", *[f"omni_w24_72_{k}_V" for k in ("mean", "min", "max", "std")]]
    with pytest.raises(ValueError):
        I.window_features(e, s.withColumnRenamed("V", "other"))
    with pytest.raises(ValueError):
        I.interval_stats(e, s, I.Interval(0, 1), {"m": ("max", "absent")}, event_time="startTime", series_time="time")
    with pytest.raises(ValueError):
        I.interval_stats(e, s, I.Interval(2, 1), {"m": ("max", "V")}, event_time="startTime", series_time="time")
    with pytest.raises(ValueError):
        I.interval_stats(e, s, I.Interval(0, 1), {"m": ("median", "V")}, event_time="startTime", series_time="time")


def test_coverage_weights_repeated_instants(spark):
    e = spark.createDataFrame([(T0,), (T0,), (T0 + timedelta(days=400),), (None,)], "startTime timestamp")
    kp = spark.createDataFrame([(T0 + timedelta(hours=1), 6.0)], "time timestamp, kp double")
    om = spark.createDataFrame([(T0 - timedelta(hours=24),)], "time timestamp")
    got = {r["year"]: r for r in coverage_table(e, kp, om).collect()}
    assert tuple(got[2020])[1:] == (2, 2, 100.0, 2, 100.0, 2, 100.0)
    assert tuple(got[2021])[1:] == (1, 0, 0.0, 0, 0.0, 0, 0.0)


def test_no_pairs_and_no_nested_loops(spark):
    e = spark.createDataFrame([(1, "a", T0)], "id int, k string, t timestamp")
    s = spark.createDataFrame([("a", T0, 1.0)], "k string, t timestamp, x double")
    plan = I.interval_stats(e, s, I.Interval(0, 72), OUT, event_time="t", series_time="t")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_events_of_one_hot_instant_are_split(spark):
    """A third of the events share an instant: their part of the last join must not be one task."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    e = spark.range(0, 60_000, 1, 12).selectExpr(
        "id", "repeat(cast(xxhash64(id) as string), 3) as text",
        "if(id % 3 = 0, timestamp'2020-01-01', timestamp_seconds(1577836800 + id * 50)) as t")
    s = spark.range(1000).selectExpr("timestamp_seconds(1577836800 + id * 3000) as t", "cast(id as double) as x")
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = I.interval_stats(e, s, I.Interval(0, 24), {"hi": ("max", "x")}, event_time="t", series_time="t")
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert len(rows) == 60_000 and {r["hi"] for r in rows if r["id"] % 3 == 0} == {28.0}
    assert "skew=true" in plan


def exact_stats(values):
    """(mean, population std) from fractions."""
    v = [Fraction(x) for x in values]
    n = len(v)
    spread = n * sum(x * x for x in v) - sum(v) ** 2
    root = math.isqrt(int(spread * 4**1_200))  # 1,200 bits after the point
    return float(sum(v) / n), float(Fraction(root, n * 2**1_200))


DOUBLES = {
    "far from zero": [1e9 + k * 1e-3 / 7 for k in range(40)],
    "both signs": [(-1) ** k * (1e6 + k / 3) for k in range(40)],
    "cancelling": [1e15, 0.1, -1e15, 0.2, 1e-9, -1e-9, 0.1],
    "one outlier": [1e18, *[0.001 + k * 1e-9 for k in range(30)]],
    "negative mean": [-0.1 * k for k in range(1, 30)],
    "whole": [float(k * k * 12_345) for k in range(30)],
    "whole and huge": [3e300, 1e300, -2e300],
    "tiny": [1e-280, 3e-281, -5e-282],
    "equal": [0.1] * 17,
    "zeros": [0.0, -0.0],
    "one": [-7.25],
}


@pytest.mark.parametrize("name", DOUBLES)
def test_doubles_are_summed_exactly(spark, name):
    """Every prefix of the values as a window of its own, to twelve digits of mean and deviation."""
    values = DOUBLES[name]
    hour = timedelta(hours=1)
    series = [("a", T0 + i * hour, x) for i, x in enumerate(values)]
    events = [(i, "a", T0 + (i - len(values)) * hour) for i in range(len(values))]
    span = I.Interval(0, len(values))  # the window of event i ends at value i
    got = run(spark, events, series, span)
    for i in range(len(values)):
        mean, sd = exact_stats(values[: i + 1])
        assert math.isclose(got[i][2], mean, rel_tol=1e-14) and math.isclose(got[i][5], sd, rel_tol=1e-12), (i, got[i], mean, sd)
    if name in ("equal", "zeros", "one"):
        assert {row[5] for row in got.values()} == {0.0}


def test_double_results_do_not_depend_on_partitions(spark):
    random_ = random.Random(3)
    series = [("a", T0 + timedelta(minutes=random_.randrange(5_000)), random_.lognormvariate(0, 9)) for _ in range(800)]
    events = [(i, "a", T0 + timedelta(minutes=random_.randrange(-100, 5_000))) for i in range(60)]
    results = [run(spark, events, rows, I.Interval(-10, 20), tile=tile, parts=parts)
               for rows, tile, parts in ((series, None, 1), (series[::-1], 7_000_000, 5), (series, 3_600_000_000, 3))]
    assert results[0] == results[1] == results[2]


def test_infinite_doubles(spark):
    up, hour = float("inf"), timedelta(hours=1)
    series = [("a", T0, 1.0), ("a", T0 + hour, up), ("a", T0 + 2 * hour, 2.0), ("a", T0 + 3 * hour, -up), ("a", T0 + 9 * hour, 5.0)]
    events = [(0, "a", T0), (1, "a", T0 + hour), (2, "a", T0 + 2 * hour), (3, "a", T0 + 9 * hour)]
    got = run(spark, events, series, I.Interval(0, 1))
    assert got[0][2] == got[1][2] == up and got[2][2] == -up and got[3][2:] == (5.0, 5.0, 5.0, 0.0)
    assert all(math.isnan(got[i][5]) for i in range(3))
    both = run(spark, events, series, I.Interval(0, 2))
    assert math.isnan(both[1][2])


def test_units_of_a_column():
    assert I._Units.spanning(None, None, None) == I._Units(0, 1)
    assert I._Units.spanning(1.0, 1000.0, True) == I._Units(0, 1)
    assert I._Units.spanning(1.0, 1000.0, False) == I._Units(-52, 3)
    assert I._Units.spanning(5e-324, 1e308, False).limbs == I.MOST_LIMBS
    assert I._Units.spanning(5e-324, 1e-300, False).unit == I.LEAST_UNIT
