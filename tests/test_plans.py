"""Raw files to trained, compared and explained models."""

import json
import math
from datetime import datetime, timedelta

import pytest

from eventwin.operators.interval import WindowStats
from eventwin.plans import label_events as L, model_matrix as X, train_score as R
from eventwin.sources import catalogues, series, sinks


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Events every 9 days over 2019-2023, Kp every 12 h, solar wind every 6 h."""
    folder = tmp_path_factory.mktemp("raw")
    start, days = datetime(2019, 1, 1), 5 * 365
    stormy = lambda t: math.sin(t.timetuple().tm_yday / 6) > 0.6
    events = []
    for i in range(0, days, 9):
        t = start + timedelta(days=i, hours=i % 24)
        events.append({"activityID": f"e{i:04d}", "startTime": t.strftime("%Y-%m-%dT%H:%MZ"), "note": "n", "link": "l",
                       "activeRegionNum": 12000 if i % 4 == 0 else None, "sourceLocation": "",
                       "cmeAnalyses": [{"speed": 300 + 37 * i % 1500, "type": "SCORS"[i % 5], "latitude": i % 90 - 45,
                                        "longitude": i % 180 - 90, "halfAngle": i % 60, "isMostAccurate": True, "note": ""}]})
    (folder / "events.json").write_text(json.dumps(events))
    moments = [start + timedelta(hours=12 * k) for k in range(2 * days)]
    (folder / "kp.csv").write_text("time,kp\n" + "\n".join(f"{t},{6 if stormy(t) else 2}" for t in moments))
    names = WindowStats().columns
    lines = ["time," + ",".join(names)]
    for k in range(4 * days - 80):  # the last events have no window values
        t = start + timedelta(hours=6 * k)
        base = -12 if stormy(t) else 3
        lines.append(f"{t}," + ",".join(str(500 + base if c == "V" else base + (k * (j + 3)) % 7 / 10) for j, c in enumerate(names)))
    (folder / "omni.csv").write_text("\n".join(lines))
    return (catalogues.read_events(spark, f"{folder}/events.json"), series.read_kp_csv(spark, f"{folder}/kp.csv"),
            series.read_wide_csv(spark, f"{folder}/omni.csv"), folder)


@pytest.fixture(scope="module")
def labelled(raw):
    return L.build_labelled_table(*raw[:3], f"{raw[3]}/labelled")


@pytest.fixture(scope="module")
def model_matrix(labelled):
    return X.build_features(labelled)


def test_labelled_table(raw, labelled):
    assert len(labelled.columns) == 6 + 7 + 2 + 5 + 48
    assert labelled.count() == raw[0].count()
    assert 0 < labelled.where("label_storm = 1").count() < labelled.count()


def test_profiles(raw, labelled):
    numeric = ["analysis_speed", "kp_max_h72", "omni_w24_72_mean_V"]
    for name, table in L.profile_labelled_table(labelled, raw[1], corr_columns=numeric).items():
        assert table.count() > 0, name
    coverage, ranges = L.explore_ranges(*raw[:3], ranges=((2019, 2023), (2021, 2022)))
    assert [r["year"] for r in coverage.orderBy("year").collect()] == [2019, 2020, 2021, 2022, 2023]
    assert ranges.count() == 2


def test_model_matrix(spark, labelled, model_matrix, tmp_path):
    m = model_matrix
    assert len(m.features) == 61 and m.leaks.count() == 0
    assert m.report.where("passed = false").count() == 0
    assert set(m.matrix.columns) == {"activityID", "split", "year", "label_storm", *m.features}
    # How the 61 features divide.
    kinds = {"omni_": 44, "feat_": 5, "analysis_": 4, "cme_type_": 2}
    assert {k: sum(f.startswith(k) for f in m.features) for k in kinds} == kinds
    assert m.matrix.count() < labelled.count()  # events without window values are gone
    sinks.write_splits(m.matrix, str(tmp_path), m.features)
    assert spark.read.parquet(f"{tmp_path}/matrix").where("split = 'train'").count() == m.matrix.where("split = 'train'").count()
    assert [r["feature"] for r in spark.read.parquet(f"{tmp_path}/features").orderBy("position").collect()] == m.features
    assert spark.read.csv(f"{tmp_path}/summary", header=True).count() == 3


def test_train_compare_explain(model_matrix):
    m = model_matrix
    small = {"rounds": 5, "depth": 3}
    fitted = R.train_all(m.matrix, m.features, forest={"trees": 5, "depth": 4}, boosted=small)
    scores = R.compare_on_validation(fitted, m.matrix, baseline=R.threshold_baseline(m.raw)).collect()
    assert [r["model"] for r in scores][0] == "physics_baseline" and len(scores) == 4
    assert scores[0]["avg_prec"] is None and scores[0]["tp"] + scores[0]["fn"] > 0
    tests, compared = R.evaluate_on_test(fitted["boosted_trees"], m.matrix, m.features, boosted=small)
    assert tests.count() == 2 and compared.count() == 4
    rows, ranked, checks = R.explain(fitted["boosted_trees"], m.matrix, m.features, keep=["activityID"])
    assert rows.count() == m.matrix.where("split = 'train'").count()
    assert ranked.count() == 61 and {r["fragment"] for r in checks.collect()} == {"Bz_gsm", "mean_V"}
