import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventwin.operators import metrics as M
from eventwin.operators.engineer import clip_at_quantile
from eventwin.operators import scan
from eventwin.operators.scan import exact_quantiles, running_totals

PROBS = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]


@pytest.mark.parametrize("name,values", [
    ("one", [3.5]), ("two", [1.0, 2.0]), ("ties", [2.0] * 7 + [5.0]), ("constant", [4.0] * 9),
    ("outlier", [*range(100), 1e300]), ("negative", [-x ** 3 / 7 for x in range(50)]),
    ("narrow", [1 + i * 2.0 ** -50 for i in range(40)]), ("infinite", [float("-inf"), 1.0, 2.0, 3.0, float("inf")]),
])
def test_quantiles(spark, name, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double").repartition(3)
    got = {r["prob"]: r for r in exact_quantiles(df, ["x"], PROBS).collect()}
    for p in PROBS:
        assert got[p]["n"] == len(values)
        want = np.quantile(np.array(values, dtype=float), p)
        if np.isfinite(want):
            assert got[p]["value"] == pytest.approx(want, rel=1e-12)


def test_quantiles_many_columns(spark):
    rnd = random.Random(3)
    rows = [(rnd.gauss(0, 1), rnd.choice([None, 1.0, 2.0]), rnd.expovariate(1e-6)) for _ in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, ["a", "b", "c"], PROBS).collect()}
    for i, c in enumerate("abc"):
        for p in PROBS:
            assert got[c, p] == pytest.approx(np.quantile([r[i] for r in rows if r[i] is not None], p), rel=1e-12)
    only_null = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(only_null, ["x"], [0.5]).count() == 0


def test_quantile_ranges_are_narrow_and_misses_are_mended(spark, monkeypatch):
    """Only values around the wanted ranks are kept, and a sketch that errs changes no result."""
    rnd = np.random.default_rng(4)
    values = np.concatenate([rnd.normal(size=60_000), np.full(30_000, 0.25), rnd.normal(size=10_000).round(1)])
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(6)
    ranges = []
    placed = scan._placed
    monkeypatch.setattr(scan, "_placed", lambda v, r: ranges.append(r) or placed(v, r))
    probs = [0.001, 0.2, 0.5, 0.97]
    check = lambda: all(r["value"] == pytest.approx(np.quantile(values, r["prob"]), rel=1e-12) for r in exact_quantiles(df, ["x"], probs).collect())
    assert check() and len(ranges) == 1
    inside = [((values >= lo) & (values <= hi)).sum() for lo, hi in ranges[0][0]]
    assert len(inside) == 4 and sum(inside) - 30_000 * any(lo <= 0.25 <= hi for lo, hi in ranges[0][0]) < 2_000
    monkeypatch.setattr(scan, "_ranges", lambda *_: [(5.0, 5.1)])
    monkeypatch.setattr(scan, "RANGE_VALUES", 40)  # cut twice
    assert check() and len(ranges) == 3 and ranges[2][0] == [(values.min(), values.max())]


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "x double")
    got = [r["x"] for r in clip_at_quantile(df, "x").collect()]
    assert max(x for x in got if x is not None) == 99.0 and got.count(None) == 1


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("spread", [3, 300, 1e-9])
def test_running_totals(spark, descending, spread):
    rnd = random.Random(7)
    keys = {(g, rnd.choice([-1, 1]) * 10 ** rnd.uniform(-spread, spread)) for g in "ab" for _ in range(80)}
    rows = [(g, v, rnd.randint(1, 9)) for g, v in keys]
    df = spark.createDataFrame(rows, "g string, v double, m int")
    got = {(r["g"], r["v"]): r["m_before"] for r in running_totals(df, "v", ["m"], by=["g"], descending=descending).collect()}
    for g, v, _ in rows:
        assert got[g, v] == sum(m for gg, vv, m in rows if gg == g and (vv > v if descending else vv < v))


def test_sort_keys(spark):
    """Keys are in the order of the values, whatever their size, and each digit's window stays small."""
    rnd = random.Random(8)
    values = [0.0, float("inf"), 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308]
    values += [np.nextafter(2.0 ** k, d) for k in range(-60, 60, 7) for d in (0, 9e99)] + [2.0 ** k for k in range(-1074, 1024, 13)]
    values += [10 ** rnd.uniform(-12, 30) for _ in range(3000)] + [1 - rnd.random() * 1e-12 for _ in range(500)]
    values = sorted({float(s * v) for v in values for s in (-1, 1)})
    rows = spark.createDataFrame([(v,) for v in values], "v double").selectExpr("v", f"{scan.sort_key('v')} as k").collect()
    keys = [r["k"] for r in sorted(rows, key=lambda r: r["v"])]
    assert all(a < b for a, b in zip(keys, keys[1:]))
    assert spark.sql(f"select {scan.sort_key('-0D')} as a, {scan.sort_key('0D')} as b").first() == (0, 0)
    wide = spark.range(100_000).selectExpr("pow(10D, id / 100000D * 42 - 12) as v", "1L as m")
    cells = wide.selectExpr(f"shiftright({scan.sort_key('v')}, 32) as cell").groupBy("cell").count().agg(F.max("count")).first()[0]
    assert cells < 100
    assert scan.running_totals(wide, "v", ["m"]).agg(F.max("m_before")).first()[0] == 99_999


# published confusion counts with their precision, recall and F1
GOLDEN = [(0, 0, 453, 57, 0.0, 0.0, 0.0), (47, 43, 410, 10, 0.5222, 0.8246, 0.6395), (43, 30, 423, 14, 0.589, 0.7544, 0.6615),
          (43, 18, 435, 14, 0.7049, 0.7544, 0.7288), (407, 245, 1471, 129, 0.6242, 0.7593, 0.6852),
          (409, 317, 1399, 127, 0.5634, 0.7631, 0.6482)]


def test_published_scores(spark):
    df = spark.createDataFrame([(i, *g[:4]) for i, g in enumerate(GOLDEN)], "i int, tp long, fp long, tn long, fn long")
    for r in M.precision_recall_f1(df).collect():
        assert tuple(round(r[c], 4) for c in ("precision", "recall", "f1")) == GOLDEN[r["i"]][4:]


def scores(spark, rows):
    return spark.createDataFrame([("m", "s", *r) for r in rows], "model string, split string, label int, score double, prediction int")


def test_areas_by_definition(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 1), rnd.choice([rnd.random(), 0.25, 0.5, 3.0, -2.0]), 1) for _ in range(300)]
    got = M.ranking_areas(scores(spark, rows)).first()
    pos, neg = [s for y, s, _ in rows if y], [s for y, s, _ in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, seen = 0.0, 0.0
    for t in sorted({s for _, s, _ in rows}, reverse=True):
        tp, k = sum(p >= t for p in pos), sum(s >= t for _, s, _ in rows)
        ap, seen = ap + (tp / len(pos) - seen) * tp / k, tp / len(pos)
    assert got["auc_roc"] == pytest.approx(auc, rel=1e-12) and got["avg_prec"] == pytest.approx(ap, rel=1e-12)


def test_average_precision_is_a_step_sum(spark):
    rows = [(1, 0.9, 1), (0, 0.8, 1), (1, 0.5, 0), (1, 0.5, 0), (0, 0.5, 0), (0, 0.1, 0)]
    assert M.ranking_areas(scores(spark, rows)).first()["avg_prec"] == pytest.approx(1 / 3 + 2 / 3 * 0.6)


def test_single_class_and_binary_scores(spark):
    alone = M.evaluate(scores(spark, [(0, 0.2, 0), (0, 0.7, 1)])).first()
    assert alone["auc_roc"] is None and alone["precision"] == 0.0 and alone["recall"] == 0.0
    flat = M.evaluate(scores(spark, [(0, 0.0, 0), (1, 0.0, 0), (0, 0.0, 0)])).first()
    assert flat["auc_roc"] == 0.5 and flat["f1_storm"] == 0.0 and (flat["tn"], flat["fn"]) == (2, 1)


def test_rule_needs_its_columns(spark):
    with pytest.raises(KeyError):
        M.threshold_rule(spark.createDataFrame([(1.0,)], "a double"), {"a": 1.0}, {"b": 2.0})


def test_union_fills_absent_columns(spark):
    a = spark.createDataFrame([("x", 0.5)], "model string, f1_storm double")
    b = spark.createDataFrame([("y", 0.5, 0.7)], "model string, f1_storm double, avg_prec double")
    rows = {r["model"]: r["avg_prec"] for r in M.union_scores(a, b).collect()}
    assert rows == {"x": None, "y": 0.7}
    assert M.best_model(M.union_scores(b, a)).first()["model"] == "x"


def test_same_result_for_any_partitioning(spark):
    df = spark.range(2000).selectExpr("'m' as model", "'s' as split", "int(id % 7 < 3) as label",
                                      "(id * 37 % 101) / 101D as score", "int(id % 2) as prediction")
    one, many = (M.evaluate(df.repartition(n)).withColumn("avg_prec", F.expr("round(avg_prec, 12)")).collect() for n in (1, 13))
    assert one == many
