"""Second-order boosting against a plain split search, tree attribution against enumeration of feature subsets."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventwin.operators import attribution as A, boosting as B, models as M
from eventwin.operators.trees import BLOCK, Tree, outputs, shapley_values

NAMES = ["a", "b", "c", "d"]


def table(spark, n=600, seed=3, missing=0.1):
    draw = np.random.default_rng(seed)
    x = np.column_stack([draw.normal(size=n), draw.integers(0, 4, n), draw.normal(size=n).round(1), np.full(n, 2.0)])
    y = (x[:, 0] + 0.7 * (x[:, 1] == 2) * x[:, 2] + draw.normal(scale=0.6, size=n) > 0.5).astype(int)
    x[:, :3][draw.random((n, 3)) < missing] = np.nan
    rows = [(i, *[None if np.isnan(v) and i % 2 else float(v) for v in x[i]], int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, d double, label_storm int"), x, y


def plain_fit(x, y, cuts, rounds, depth, step, weight, penalty=1.0, least_child=1.0):
    """Every split of every node tried in turn."""
    margin, trees = np.zeros(len(y)), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        w = np.where(y == 1, weight, 1.0)
        g, h, nodes = w * (p - y), w * p * (1 - p), []

        def grow(rows, deep):
            here = len(nodes)
            nodes.append(None)
            G, H = g[rows].sum(), h[rows].sum()
            best = (1e-6, None)
            for f in range(x.shape[1]) if deep < depth else ():
                for cut in cuts[f]:
                    for missing_left in (False, True):
                        with np.errstate(invalid="ignore"):
                            goes = np.where(np.isnan(x[rows, f]), missing_left, x[rows, f] < cut)
                        left, right = rows[goes], rows[~goes]
                        hl, hr = h[left].sum(), h[right].sum()
                        if min(hl, hr) >= least_child:
                            gain = (g[left].sum() ** 2 / (hl + penalty) + g[right].sum() ** 2 / (hr + penalty) - G * G / (H + penalty)) / 2
                            if gain > best[0] + 1e-9:
                                best = gain, (f, cut, left, right)
            if best[1] is None:
                nodes[here] = -step * G / (H + penalty)
                margin[rows] += nodes[here]
            else:
                f, cut, left, right = best[1]
                nodes[here] = (f, float(cut), round(best[0], 6))
                grow(left, deep + 1)
                grow(right, deep + 1)

        grow(np.arange(len(y)), 0)
        trees.append(nodes)
    return trees, margin


def in_depth_order(model, number):
    """A fitted tree's nodes as `plain_fit` lists them."""
    tree, gains, out = model.trees[number], {n: g for t, n, g in model.gains if t == number}, []

    def visit(n):
        if tree.left[n] < 0:
            out.append(tree.value[n])
        else:
            out.append((int(tree.feature[n]), float(tree.limit[n]), round(gains[n], 6)))
            visit(tree.left[n])
            visit(tree.right[n])

    visit(0)
    return out


@pytest.mark.parametrize("missing, bins", [(0.1, 20), (0.0, 254)])
def test_trees_are_those_of_a_plain_search(spark, missing, bins):
    df, x, y = table(spark, missing=missing)
    model = B.fit_trees(df.repartition(5), NAMES, rounds=3, depth=3, step=0.3, rows=1.0, columns=1.0, bins=bins, key="id")
    weight = (y == 0).sum() / (y == 1).sum()
    trees, margin = plain_fit(x, y, model.cuts, 3, 3, 0.3, weight)
    for number, want in enumerate(trees):
        got = in_depth_order(model, number)
        assert len(got) == len(want)
        for one, other in zip(got, want):
            if isinstance(other, tuple):
                assert one[:2] == other[:2] and one[2] == pytest.approx(other[2], abs=2e-6)
            else:
                assert one == pytest.approx(other, abs=1e-8)
    got = {r["id"]: r["margin"] for r in model.margins(df).collect()}
    assert np.allclose([got[i] for i in range(len(y))], margin, atol=1e-8)


def test_a_fit_is_the_same_however_rows_lie(spark):
    df, _, _ = table(spark)
    settings = {"rounds": 4, "depth": 3, "rows": 0.7, "columns": 0.5, "key": "id"}
    one, other = (B.fit_trees(d, NAMES, **settings) for d in (df.repartition(7), df.orderBy(F.desc("a")).coalesce(1)))
    assert [in_depth_order(one, t) for t in range(4)] == [in_depth_order(other, t) for t in range(4)]
    used = {tuple(sorted({int(f) for f, left in zip(t.feature, t.left) if left >= 0})) for t in one.trees}
    assert all(len(u) <= 2 for u in used) and len(used) > 1  # half of four features for each tree


def test_margins_are_stored_between_trees(spark, monkeypatch):
    df, _, _ = table(spark)
    settings = {"rounds": 5, "depth": 2, "key": "id"}
    want = B.fit_trees(df, NAMES, **settings)
    monkeypatch.setattr(B, "STORE_EVERY", 2)
    monkeypatch.setattr(B, "BLOCK_ROWS", 50)
    got = B.fit_trees(df, NAMES, **settings)
    assert [in_depth_order(got, t) for t in range(5)] == [in_depth_order(want, t) for t in range(5)]


def test_penalty_least_child_and_gamma_hold_back(spark):
    df, x, y = table(spark)
    fit = lambda **k: B.fit_trees(df, NAMES, rounds=1, depth=3, rows=1.0, columns=1.0, key="id", **k)
    free, strict = fit(), fit(least_child=30.0)
    assert (strict.trees[0].cover[strict.trees[0].left < 0] >= 30).all() and len(strict.trees[0].left) < len(free.trees[0].left)
    assert len(fit(gamma=1e9).trees[0].left) == 1
    assert np.abs(fit(penalty=1e6).trees[0].value).max() < np.abs(free.trees[0].value).max() / 100
    with pytest.raises(ValueError):
        B.fit_trees(df.where("label_storm = 0"), NAMES)


def test_odd_rows(spark):
    """Features without values, infinities, unknown labels and a key that a third of the rows share."""
    rows = [(i % 3 and i, float(i), None, float("nan"), [float("inf"), float("-inf")][i % 2], [0, 1, None, 7][i % 4]) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, label_storm int")
    model = B.fit_trees(df, NAMES, rounds=2, depth=2, rows=0.9, columns=1.0, key="id")
    assert {int(f) for t in model.trees for f, left in zip(t.feature, t.left) if left >= 0} <= {0, 3}
    scored = model.predict(df).collect()
    assert len(scored) == 400 and all(0 < r["score"] < 1 for r in scored)
    assert model.predict(df.limit(0)).count() == 0
    assert B.fit_trees(df, NAMES, rounds=1, depth=1, rows=0.9).trees  # without a key


def test_scores_ablation_and_saving(spark, tmp_path):
    df, _, _ = table(spark)
    split = df.withColumn("split", F.expr("if(id % 3 = 0, 'test', 'train')"))
    train = split.where("split = 'train'")
    fit = lambda rows, kept: B.fit_trees(rows, kept, rounds=8, depth=3, step=0.3, key="id")
    model = fit(train, NAMES)
    row = M.score_model(model, split.where("split = 'test'"), "second_order").first()
    assert row["auc_roc"] > 0.75 and row["tp"] + row["fn"] + row["fp"] + row["tn"] == 200
    scores, compared = M.ablation(train, split.where("split = 'test'"), NAMES, ["a"], fit, full_model=model)
    assert {r["metric"]: r["delta"] for r in compared.collect()}["auc_roc"] < 0
    model.save(spark, str(tmp_path))
    again = B.BoostedTrees.load(spark, str(tmp_path))
    assert again.gains == model.gains and sorted(map(str, again.margins(df).collect())) == sorted(map(str, model.margins(df).collect()))
    names = set(df.columns)
    assert set(model.margins(df).columns) == names | {"margin"}


# --- attribution

def random_tree(draw, depth, features):
    rows = []

    def grow(deep, cover):
        here = len(rows)
        rows.append(None)
        if deep == depth or (deep > 1 and draw.random() < 0.2):
            rows[here] = (-1, 0.0, False, -1, -1, draw.normal(), cover)
        else:
            f, limit, missing, part = int(draw.integers(features)), draw.normal(), draw.random() < 0.5, draw.uniform(0.1, 0.9)
            left, right = grow(deep + 1, cover * part), grow(deep + 1, cover * (1 - part))
            rows[here] = (f, limit, missing, left, right, 0.0, cover)
        return here

    grow(0, 50.0)
    return Tree.of(rows)


def by_subsets(tree, x):
    """Shapley values from the definition: the expected output for every set of known features."""
    def known(s, n=0):
        left, right = int(tree.left[n]), int(tree.right[n])
        if left < 0:
            return tree.value[n]
        if tree.feature[n] in s:
            return known(s, left if tree.goes_left(n, x[tree.feature[n]]) else right)
        return (tree.cover[left] * known(s, left) + tree.cover[right] * known(s, right)) / tree.cover[n]

    n = len(x)
    return [sum(factorial(k) * factorial(n - k - 1) / factorial(n) * (known({*s, i}) - known(set(s)))
                for k in range(n) for s in combinations([j for j in range(n) if j != i], k)) for i in range(n)], known(set())


@pytest.mark.parametrize("depth", [0, 1, 3, 6])
def test_attribution_is_the_definition(depth):
    draw = np.random.default_rng(depth)
    for _ in range(4):
        tree, x = random_tree(draw, depth, 4), draw.normal(size=(5, 4))
        x[draw.random(x.shape) < 0.2] = np.nan
        got = shapley_values(x, [tree])
        for row, one in zip(x, got):
            want, base = by_subsets(tree, row)
            assert np.allclose(one, want) and tree.expected() == pytest.approx(base)
        assert np.allclose(got.sum(1) + tree.expected(), outputs(x, [tree]))


def test_attribution_in_blocks_and_without_cover():
    draw = np.random.default_rng(1)
    tree, x = random_tree(draw, 5, 3), draw.normal(size=(BLOCK + 7, 3))
    assert np.allclose(shapley_values(x, [tree]), np.vstack([shapley_values(x[:100], [tree]), shapley_values(x[100:], [tree])]))
    bare = Tree.of([(0, 0.0, False, 1, 2, 0.0, 4.0), (-1, 0.0, False, -1, -1, 1.0, 4.0), (-1, 0.0, False, -1, -1, 5.0, 0.0)])
    assert np.isfinite(shapley_values(np.array([[-1.0], [1.0]]), [bare])).all()
    assert shapley_values(np.empty((0, 3)), [tree]).shape == (0, 3)


def test_attribution_of_a_fitted_model(spark):
    df, _, _ = table(spark)
    model = B.fit_trees(df, NAMES, rounds=5, depth=3, step=0.3, key="id")
    got = {r["id"]: r for r in A.tree_attribution(df, model, NAMES, ["id"]).collect()}
    for r in model.margins(df).collect():
        assert got[r["id"]]["base"] + sum(got[r["id"]]["phi"]) == pytest.approx(r["margin"], abs=1e-9)
    with pytest.raises(ValueError):
        A.tree_attribution(df, model, NAMES[::-1])


def test_fits_without_a_group_equal_fits_of_their_own(spark):
    """Hidden features change nothing else: the same trees as from a table without them, over stored margins too."""
    df, _, _ = table(spark)
    rows = df.withColumn("split", F.expr("if(id % 4 = 0, 'test', 'validation')"))
    groups = {"first": ["a"], "rest": ["b", "c", "d"], "none of these": ["z"]}
    options = dict(rounds=18, depth=3, rows=0.7, columns=0.6, step=0.3)
    scores, compared, models = M.group_ablation(rows, rows, NAMES, groups, key="id", at_once=3, **options)
    nodes = lambda model: [tuple(r) for r in model.nodes(spark).orderBy("tree", "node").collect()]
    for name, kept in {"full": NAMES, "without first": NAMES[1:], "without rest": ["a"]}.items():
        assert nodes(models[name]) == nodes(B.fit_trees(rows, kept, key="id", **options)), name
    assert nodes(models["without none of these"]) == nodes(models["full"])
    assert scores.count() == 8 and {r["model"] for r in scores.collect()} == set(models)
    got = {(r["feature_group"], r["metric"]): r for r in compared.collect()}
    assert len(got) == 12 and all(got["none of these", m]["delta"] == 0 for m in ("f1_storm", "precision", "recall", "auc_roc"))
    assert all(r["delta"] == r["reduced"] - r["full"] for r in got.values()) and got["first", "auc_roc"]["delta"] < 0
    with pytest.raises(ValueError, match="without all"):
        M.group_ablation(rows, rows, NAMES, {"all": NAMES}, rounds=1)
