"""Levels as a table, against sorted Python lists."""

import random

import pytest
from pyspark.sql import functions as F

from eventwin.operators import levels as L
from eventwin.operators.models import fit_logistic, predict

ODD = ["a\\b`c", "O'Neil", "", " ", "é", "Z", "z", "10", "9", "𝄞", "￮"]


def test_positions_modes_and_unseen(spark):
    draw = random.Random(5)
    rows = [(i, draw.choice([*ODD, None, None]), None, i % 3 == 0) for i in range(300)]
    train = spark.createDataFrame(rows, "id int, a string, empty string, `flag it` boolean").repartition(7)
    fitted = L.fit_levels(train, ["a", "empty", "flag it"])
    seen = [r[1] for r in rows if r[1] is not None]
    order = sorted(set(seen), key=lambda v: v.encode())
    assert fitted.columns == ("a", "flag it") and fitted.sizes == {"a": len(order), "flag it": 2} and fitted.width == len(order) + 2
    assert {(r["level"], r["n"], r["position"]) for r in fitted.table.where("column = 'a'").collect()} == {
        (v, seen.count(v), i) for i, v in enumerate(order)}
    mode = min(order, key=lambda v: (-seen.count(v), v.encode()))
    assert fitted.modes == {"a": mode, "flag it": "false"}
    new = spark.createDataFrame([(1, "unseen", True, "kept"), (2, None, None, "kept"), (3, order[0], False, None)], "id int, a string, `flag it` boolean, level string")
    got = {r["id"]: r for r in fitted.positions(new).collect()}
    assert fitted.positions(new).columns == new.columns
    assert [(got[i]["a"], got[i]["flag it"], got[i]["level"]) for i in (1, 2, 3)] == [(None, 1, "kept"), (order.index(mode), 0, "kept"), (0, 0, None)]
    vectors = {r["id"]: r["levels"] for r in fitted.vectors(new).collect()}
    k = len(order)
    assert {i: sorted(int(x) for x in v.toArray().nonzero()[0]) for i, v in vectors.items()} == {1: [k + 1], 2: [order.index(mode), k], 3: [0, k]}
    assert {v.size for v in vectors.values()} == {k + 2}


def test_save_and_load(spark, tmp_path):
    train = spark.createDataFrame([("b", "x"), ("a", "x"), ("b", None)], "z string, y string")
    fitted = L.fit_levels(train, ["z", "y"])
    fitted.save(str(tmp_path / "levels"))
    back = L.Levels.load(spark, str(tmp_path / "levels"))
    assert (back.columns, back.sizes, back.modes) == (("z", "y"), {"z": 2, "y": 1}, {"z": "b", "y": "x"})


def test_empty_and_absent(spark):
    empty = spark.createDataFrame([], "a string")
    fitted = L.fit_levels(empty, ["a"])
    assert fitted.columns == () and fitted.positions(empty).count() == 0
    with pytest.raises(ValueError, match="no column"):
        fitted.vectors(empty)
    with pytest.raises(ValueError, match="training table"):
        L.fit_levels(empty, ["b"])


def test_a_million_levels_and_a_hot_one(spark):
    """A third of all rows hold one level."""
    n = 1_000_000
    rows = spark.range(n + n // 2).selectExpr(f"if(id < {n}, concat('v', id), 'v77') as v", "id")
    fitted = L.fit_levels(rows, ["v"])
    assert fitted.sizes == {"v": n} and fitted.modes == {"v": "v77"}
    table = fitted.table.select("level", "position").toPandas().sort_values("position")
    assert (table["position"].to_numpy() == range(n)).all() and table["level"].is_monotonic_increasing
    coded = fitted.positions(rows)
    assert coded.agg(F.count("v"), F.count_distinct("v")).first()[:] == (n + n // 2, n)
    some = fitted.vectors(rows.where("id % 300000 = 7")).collect()
    spots = {level: position for level, position in zip(table["level"], table["position"])}
    assert {r["id"]: (r["levels"].size, list(r["levels"].indices)) for r in some} == {
        i: (n, [spots[f"v{i}" if i < n else "v77"]]) for i in range(7, n + n // 2, 300_000)}


def test_vectors_feed_a_classifier(spark):
    rows = spark.range(400).selectExpr("concat('k', id % 20) as k", "cast(id % 7 as double) as x", "cast(id % 20 < 6 as int) as label_storm", "id")
    made = L.fit_levels(rows, ["k"]).vectors(rows)
    scored = predict(fit_logistic(made, ["levels", "x"], c=10), made)
    assert scored.where("prediction <> label_storm").count() == 0
