"""Trees and their attributions against definitions, and the grouped ensembles built on them."""

import itertools
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from equitrace.operators import drivers, forests, trees
from equitrace.spec import BOOSTED, FOREST, ModelSpec, RefreshSpec, TreeGrid


def slow_tree(x, w, y, depth, shrink):
    """(feature, threshold, left, right) or a leaf's (value, cover), by trying every cut."""
    h, g = w.sum(), (w * y).sum()
    best = None
    if depth:
        for f in range(x.shape[1]):
            seen = sorted(set(x[w > 0, f]))
            for a, b in itertools.pairwise(seen):
                left = x[:, f] <= a
                parts = [((w * y)[m].sum(), w[m].sum()) for m in (left, ~left)]
                gain = sum(q * q / (k + shrink) for q, k in parts) - g * g / (h + shrink)
                if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-9)):
                    best = (gain, f, (a + b) / 2)
    if best is None:
        return (g / (h + shrink), h)
    _, f, cut = best
    left = x[:, f] <= cut
    return (f, cut, *[slow_tree(x, np.where(m, w, 0), y, depth - 1, shrink) for m in (left, ~left)], h)


def answer(tree, row):
    while len(tree) > 2:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def expected_value(tree, row, known):
    """The tree's value where only some features are known; at others the cover decides."""
    if len(tree) == 2:
        return tree[0]
    f, cut, left, right, h = tree
    if f in known:
        return expected_value(left if row[f] <= cut else right, row, known)
    return sum(t[-1] / h * expected_value(t, row, known) for t in (left, right))


def slow_effects(tree, row, p):
    out = []
    for j in range(p):
        others, total = [k for k in range(p) if k != j], 0.0
        for size in range(p):
            for s in itertools.combinations(others, size):
                weight = math.factorial(size) * math.factorial(p - size - 1) / math.factorial(p)
                total += weight * (expected_value(tree, row, {*s, j}) - expected_value(tree, row, set(s)))
        out.append(total)
    return out


def data(seed, n, p, ties):
    draw = np.random.default_rng(seed)
    x = draw.integers(0, 5, (n, p)).astype(float) if ties else draw.normal(size=(n, p))
    return x, x[:, 0] * 2 - x[:, -1] ** 2 + draw.normal(size=n)


@pytest.mark.parametrize("seed, n, p, ties, depth, shrink", [(1, 30, 3, False, 3, 0), (2, 40, 4, True, 3, 1), (3, 25, 2, False, 4, 0), (4, 12, 6, True, 6, 1), (5, 1, 2, False, 2, 0)])
def test_tree_and_effects_by_definition(seed, n, p, ties, depth, shrink):
    x, y = data(seed, n, p, ties)
    draw = np.random.default_rng(seed)
    weights = np.stack([np.ones(n), draw.integers(0, 3, n).astype(float)])
    weights[1, 0] = 1
    grown = trees.grow(x[None], trees.codes(x[None]), weights, np.broadcast_to(y, weights.shape), depth, shrink)
    effects = trees.attributions(x[None], grown, depth)
    for c, w in enumerate(weights):
        slow = slow_tree(x, w, y, depth, shrink)
        assert np.allclose(grown.predict(depth)[c], [answer(slow, r) for r in x])
        assert np.allclose(effects[c].T, [slow_effects(slow, r, p) for r in x])
        mean = expected_value(slow, x[0], set())
        assert np.allclose(effects[c].sum(axis=0), grown.predict(depth)[c] - mean)


def test_a_tree_cut_at_a_level_is_the_shallower_tree():
    x, y = data(6, 50, 3, False)
    w = np.ones((1, 50))
    deep = trees.grow(x[None], trees.codes(x[None]), w, y[None], 4)
    for depth in (1, 2, 3):
        flat = trees.grow(x[None], trees.codes(x[None]), w, y[None], depth)
        assert np.array_equal(flat.predict(depth), deep.predict(depth))
        assert np.allclose(trees.attributions(x[None], flat, depth), trees.attributions(x[None], deep, depth))


def test_two_boosted_rounds_by_hand():
    """Four rows, one feature, rate 0.5, leaves of residual sum / (rows + 1)."""
    s = forests.Series({"k": "a", "dates": list("abcde"), "x": [[0.0], [1.0], [2.0], [3.0], [9.0]], "dv": [0.0, 0.0, 8.0, 8.0, 99.0],
                        "fold": [1, 1, 2, 2, 0], "split": ["train"] * 4 + ["holdout"]}, ["k"])
    base, steps = forests.boosted_chains([s], [0], 1, np.array([0.5]), 2, lambda no, t: None)
    got = [p[0].tolist() for _, p in steps]
    # base 4; residuals -4 -4 4 4; leaves -8/3 and 8/3; then residuals -8/3 and 8/3 give leaves -16/9 and 16/9
    assert base.tolist() == [4.0]
    assert np.allclose(got[0], [8 / 3, 8 / 3, 16 / 3, 16 / 3, 16 / 3])
    assert np.allclose(got[1], [16 / 9, 16 / 9, 56 / 9, 56 / 9, 56 / 9])


def learning(spark, n, keys=2):
    """Keys of different sizes; the share follows x1 strongly, x2 weakly; one key has no x3."""
    rows = spark.range(n * keys).select(
        (F.col("id") % keys).cast("string").alias("brand"), F.lit("X").alias("category"), F.lit("awareness").alias("pillar"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") / keys).cast("int")).alias("date"),
        F.randn(1).alias("x1"), F.randn(2).alias("x2"), F.randn(3).alias("x3"),
    )
    rows = rows.withColumn("dv", 20 + 4 * F.col("x1") + F.col("x2") + 0.1 * F.randn(4))
    return rows.unpivot(["brand", "category", "pillar", "date", "dv"], ["x1", "x2", "x3"], "var", "value").where("brand <> '1' or var <> 'x3'")


@pytest.mark.parametrize("kind", [FOREST, BOOSTED])
def test_every_key_gets_its_model(spark, kind):
    model = ModelSpec(folds=3, forest=TreeGrid((1, 3), (15, 60), (1, 2, 10)), boosted=TreeGrid((1, 2), (20, 60), (), (0.05, 0.1)))
    samples = drivers.learning_rows(learning(spark, 70), drivers.MODEL_KEY, model, RefreshSpec())
    results, predictions = forests.tree_model(samples, kind, model, drivers.MODEL_KEY)
    got = defaultdict(dict)
    for r in results.collect():
        got[r["brand"]][r["var"]] = r
    assert {b: set(v) for b, v in got.items()} == {"0": {"x1", "x2", "x3"}, "1": {"x1", "x2"}}
    for v in got.values():
        assert v["x1"]["attribution"] > v["x2"]["attribution"] > (v["x3"]["attribution"] if "x3" in v else 0)
        assert abs(sum(r["importance"] for r in v.values()) - 1) < 1e-9
        assert v["x1"]["r2_train"] > 0.8 and v["x1"]["r2_fold"] > 0.5
        assert v["x1"]["best_params"].startswith("max_depth=3" if kind == FOREST else "max_depth=2")
    assert predictions.count() == 140 and predictions.where("predicted is null").count() == 0


@pytest.mark.parametrize("kind", [FOREST, BOOSTED])
def test_fold_scores_cover_the_grid_and_equal_single_fits(spark, kind):
    """Every setting and fold is scored; a grid of one setting gives what the large grid gives for it."""
    model = ModelSpec(folds=2, forest=TreeGrid((1, 2), (15, 60), (1, 2, 10)), boosted=TreeGrid((1, 2), (5, 9), (), (0.05, 0.1)))
    samples = drivers.learning_rows(learning(spark, 30), drivers.MODEL_KEY, model, RefreshSpec())
    series = forests.series_rows(samples, drivers.MODEL_KEY)
    scores = forests.forest_fold_scores if kind == FOREST else forests.boosted_fold_scores
    grid = model.forest if kind == FOREST else model.boosted
    rows = defaultdict(list)
    for r in scores(series, drivers.MODEL_KEY, grid, 2).collect():
        rows[r["grid_no"]].append((r["brand"], r["fold"], round(r["dv"], 9), round(r["predicted"], 9)))
    settings = forests.grid_settings(grid)
    assert set(rows) == set(range(len(settings))) and {len(v) for v in rows.values()} == {48}
    for no in (0, len(settings) - 1):
        one = TreeGrid(**{k: (settings[no][k],) for k in settings[no]})
        if kind == FOREST:
            one = TreeGrid(grid.max_depth, grid.n_trees, one.max_features)
            same = [k for k, s in enumerate(forests.grid_settings(one)) if all(s[x] == settings[no][x] for x in s)][0]
        else:
            same = 0
        alone = [r for r in scores(series, drivers.MODEL_KEY, one, 2).collect() if r["grid_no"] == same]
        assert sorted((r["brand"], r["fold"], round(r["dv"], 9), round(r["predicted"], 9)) for r in alone) == sorted(rows[no])


def test_no_rows(spark):
    empty = learning(spark, 3).limit(0).withColumns({"split": F.lit("train"), "fold": F.lit(1)})
    for kind in (FOREST, BOOSTED):
        results, predictions = forests.tree_model(empty, kind, ModelSpec(), drivers.MODEL_KEY)
        assert results.count() == 0 and predictions.count() == 0
