
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventwin.operators import attribution as A, checks, clean, models as M
from eventwin.operators.engineer import engineer_features
from eventwin.operators.prep import Preprocessor, fit_preprocessor
from eventwin.operators.split import assign_split, excluded_rows, split_summary


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, "train", 1.0, 5.0, "b", None), (2, "train", 3.0, 5.0, "a", None), (3, "train", None, 5.0, "b", None),
            (4, "train", 10.0, 5.0, "a", None), (5, "test", None, None, "z", 1.0), (6, "test", float("nan"), 6.0, None, 2.0)]
    return spark.createDataFrame(rows, "id int, split string, x double, flat double, kind string, empty double")


FEATURES = ["x", "flat", "kind", "empty"]


def test_preprocessor(spark, people, tmp_path):
    fitted = fit_preprocessor(people.where("split = 'train'"), FEATURES)
    assert fitted.feature_names == ["x", "flat", "kind_a", "kind_b"]  # a column without training values is left out
    values = np.array([1, 3, 3, 10.0])
    got = {r["id"]: r for r in fitted.transform(people, keep=["id"]).collect()}
    for i, v in ((1, 1.0), (3, 3.0), (4, 10.0), (5, 3.0), (6, 3.0)):
        assert got[i]["x"] == pytest.approx((v - values.mean()) / values.std())
    assert [got[i]["flat"] for i in (1, 5, 6)] == [0.0, 0.0, 1.0]  # constant column divided by 1
    assert (got[5]["kind_a"], got[5]["kind_b"]) == (0.0, 0.0)  # unseen
    assert (got[6]["kind_a"], got[6]["kind_b"]) == (1.0, 0.0)  # mode, smallest of equals
    fitted.save(spark, str(tmp_path / "p"))
    assert Preprocessor.load(spark, str(tmp_path / "p")) == fitted
    plain = fit_preprocessor(people.where("split = 'train'"), ["x"], scale=False).transform(people, keep=["id"])
    assert {r["id"]: r["x"] for r in plain.collect()}[5] == 3.0


def test_fit_ignores_other_splits(people):
    changed = people.withColumn("x", F.expr("if(split = 'test', 1e9D, x)"))
    assert fit_preprocessor(people.where("split = 'train'"), FEATURES) == fit_preprocessor(changed.where("split = 'train'"), FEATURES)


def test_split(spark):
    df = spark.createDataFrame([(y, y % 2) for y in range(2015, 2025)], "year int, label_storm int")
    out = assign_split(df)
    assert {r["split"]: r["n_rows"] for r in split_summary(out, ["a", "b"]).collect()} == {"train": 6, "validation": 1, "test": 3}
    assert excluded_rows(df, train_end=2016, val_year=2018, test_start=2020).first()[0] == 2
    with pytest.raises(ValueError):
        assign_split(df, train_end=2022)
    with pytest.raises(ValueError):
        assign_split(df.drop("year"))


def test_checks(spark):
    rows = [("train", 1.0, 0), ("train", None, 1), ("test", float("inf"), 2), ("test", float("nan"), 0)]
    df = spark.createDataFrame(rows, "split string, x double, label_storm int")
    got = {(r["check"], r["split"]): (r["value"], r["passed"]) for r in checks.check_splits(df, ["x"]).collect()}
    assert got["missing values", "train"] == (1.0, False) and got["infinite values", "test"] == (1.0, False)
    assert got["labels not 0/1", "test"] == (1.0, False) and got["labels not 0/1", "train"] == (0.0, True)
    assert got["positive rate", "train"] == (0.5, True)
    with pytest.raises(checks.CheckFailed):
        checks.enforce(checks.check_splits(df, ["x"]))
    assert checks.enforce(checks.check_splits(df.where("x = 1").withColumn("x", F.lit(1.0)), ["x"], splits=["train"]))
    with pytest.raises(checks.CheckFailed, match="rows in test"):
        checks.enforce(checks.check_splits(df.where("x = 1"), ["x"]))
    with pytest.raises(checks.CheckFailed, match="features"):
        checks.enforce(checks.check_splits(df.where("x = 1"), ["x", "y"], splits=["train"]))
    leaks = checks.leaky_names(df, ["x", "kp_max_h72", "my_kp_", "label_storm_2"]).collect()
    assert len(leaks) == 4  # kp_max_h72 matches two patterns
    assert {(r["split"], r["n_missing"]) for r in checks.null_counts(df, ["x"]).collect()} == {("train", 1), ("test", 1)}


def test_cleaning_guards(spark):
    df = spark.createDataFrame([(1, "a", True)], "n int, s string, b boolean")
    assert clean.column_kinds(df) == (["n"], ["s", "b"])
    with pytest.raises(ValueError):
        clean.drop_all_missing(df, [])
    with pytest.raises(ValueError):
        clean.features_and_label(df)
    with pytest.raises(ValueError):
        clean.levels_of(spark.range(20).selectExpr("cast(id as string) as s"), "s", limit=10)
    assert clean.any_present(df, ["x"], "f").first()["f"] is False
    groups = clean.feature_groups()
    assert [len(groups[g]) for g in groups] == [14, 14, 26, 8]
    assert clean.group_columns(df.withColumn("start_dow", F.lit(1)), "cme_properties") == ["start_dow"]


def test_engineering_uses_the_requested_rows_for_the_cap(spark):
    df = spark.createDataFrame([(f"2020-01-{i + 1:02d}", float(i), 1.0) for i in range(20)] + [("2023-01-01", 1000.0, 1.0)],
                               "d string, analysis_speed double, omni_w24_72_mean_V double").selectExpr(
        "cast(d as timestamp) as startTime", "analysis_speed", "omni_w24_72_mean_V")
    top = lambda out: max(r["analysis_speed"] for r in out.collect())
    assert top(engineer_features(df)) == pytest.approx(np.quantile([*range(20), 1000], 0.99))
    assert top(engineer_features(df, clip_fit_on="year <= 2020")) == pytest.approx(np.quantile(range(20), 0.99))


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 2] + rng.normal(scale=0.5, size=400) > 0.8).astype(int)
    rows = [(i, "train" if i < 300 else "test", *map(float, x[i]), int(y[i])) for i in range(400)]
    return spark.createDataFrame(rows, "id int, split string, a double, b double, c double, d double, label_storm int").cache()


COLUMNS = ["a", "b", "c", "d"]


def test_logistic_minimises_its_objective(matrix):
    train = matrix.where("split = 'train'")
    model = M.fit_logistic(train, COLUMNS)
    rows = train.collect()
    x, y = np.array([[r[c] for c in COLUMNS] for r in rows]), np.array([r["label_storm"] for r in rows])
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    stage = model.stages[-1]
    w, b = stage.coefficients.toArray(), stage.intercept
    residual = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
    # gradient of |w|² / 2 + 0.1 · weighted loss
    assert np.abs(w + 0.1 * x.T @ residual).max() < 1e-3 and abs(residual.sum()) < 1e-2


def test_models_score_and_survive_saving(matrix, tmp_path):
    from eventwin.plans.train_score import load_models, save_models, train_all
    fitted = train_all(matrix, COLUMNS, forest={"trees": 8, "depth": 4}, boosted={"rounds": 5, "depth": 3})
    scores = M.compare_models(fitted, matrix.where("split = 'test'")).collect()
    assert len(scores) == 3 and all(r["auc_roc"] > 0.75 for r in scores)
    save_models(fitted, str(tmp_path))
    again = load_models(str(tmp_path))
    for name in fitted:
        a, b = (sorted((r["id"], r["score"]) for r in M.predict(m, matrix).collect()) for m in (fitted[name], again[name]))
        assert a == b
    with pytest.raises(ValueError):
        M.class_sizes(matrix.where("label_storm = 0"))


def test_ablation(matrix):
    fit = lambda train, kept: M.fit_logistic(train, kept)
    scores, compared = M.ablation(matrix.where("split = 'train'"), matrix.where("split = 'test'"), COLUMNS, ["a"], fit)
    delta = {r["metric"]: r["delta"] for r in compared.collect()}
    assert scores.count() == 2 and set(delta) == {"f1_storm", "precision", "recall", "auc_roc"} and delta["auc_roc"] < 0


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_tree_attribution_adds_up(spark, matrix, kind):
    train = matrix.where("split = 'train'")
    model = M.fit_boosted(train, COLUMNS, rounds=6, depth=3) if kind == "boosted" else M.fit_forest(train, COLUMNS, trees=5, depth=5, min_leaf=5)
    rows = {r["id"]: r for r in A.tree_attribution(train, model, COLUMNS, ["id"]).collect()}
    for r in M.predict(model, train).collect():
        got = rows[r["id"]]["base"] + sum(rows[r["id"]]["phi"])
        want = 0.5 * np.log(r["score"] / (1 - r["score"])) if kind == "boosted" else r["score"]
        assert got == pytest.approx(want, abs=1e-9)
    trees, _ = A.trees_of(model, spark)
    x = np.array([[rows[i][c] for c in COLUMNS] for i in sorted(rows)])
    assert np.allclose(A.shapley_values(x, trees), np.vstack([A.shapley_values(x[i:i + 1], trees) for i in range(len(x))]))
    # values that take part in no comparison go where the model sends them
    odd = spark.createDataFrame([(i, *[v if j == i % 4 else 0.5 for j in range(4)]) for i, v in enumerate([float("nan"), float("-inf"), float("inf")] * 4)],
                                "id int, " + ", ".join(f"{c} double" for c in COLUMNS)).withColumn("label_storm", F.lit(0))
    from pyspark.ml.feature import VectorAssembler
    keeping = type(model)([VectorAssembler(inputCols=COLUMNS, outputCol="features", handleInvalid="keep"), model.stages[-1]])
    phi = {r["id"]: r["base"] + sum(r["phi"]) for r in A.tree_attribution(odd, model, COLUMNS, ["id"]).collect()}
    for r in M.predict(keeping, odd).collect():
        want = 0.5 * np.log(r["score"] / (1 - r["score"])) if kind == "boosted" else r["score"]
        assert phi[r["id"]] == pytest.approx(want, abs=1e-9)
    ranked = A.importance(A.tree_attribution(train, model, COLUMNS), COLUMNS).collect()
    assert [r["rank"] for r in sorted(ranked, key=lambda r: -r["mean_abs_shap"])] == [1, 2, 3, 4] and ranked[0]["feature"]


def test_linear_attribution(matrix):
    model = M.fit_logistic(matrix, COLUMNS)
    weights = A.logistic_weights(model, COLUMNS)
    rows = A.linear_attribution(matrix, weights)
    assert rows.selectExpr("avg(phi[0]) as m").first()["m"] == pytest.approx(0, abs=1e-9)
    assert A.dependence(rows, COLUMNS, "b", "a").columns == ["value", "attribution", "colour"]


def test_ranks_with_ties(spark):
    table = spark.createDataFrame([("z_Bz_gsm", 0.0), ("y", 0.0), ("mean_V", 2.0), ("a", 3.0)], "feature string, mean_abs_shap double")
    ranked = A.rank_importance(table)
    assert {r["feature"]: r["rank"] for r in ranked.collect()} == {"a": 1, "mean_V": 2, "y": 3, "z_Bz_gsm": 4}
    assert tuple(A.best_rank(ranked, "Bz_gsm", 3).first()) == ("Bz_gsm", 4, False)
