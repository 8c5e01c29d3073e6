import datetime as dt
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from equitrace.functions.grouping import PANEL_KEY, seeded_sample, with_group_stats
from equitrace.operators import drivers, factor, forests, importance, stats
from equitrace.spec import FOREST, RIDGE, ModelSpec, RefreshSpec, TreeGrid

LOADINGS = {"m1": 0.9, "m2": 0.8, "m3": 0.6, "m4": 0.4, "m5": -0.7}


def simulated(spark, n=4000):
    """x = loading * f + noise, with a known loading per metric."""
    base = spark.range(n).select(
        F.concat(F.lit("B"), (F.col("id") % 20).cast("string")).alias("brand"),
        F.lit("X").alias("category"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") / 20).cast("int")).alias("date"),
        F.randn(7).alias("f"),
        *[F.randn(10 + k).alias(f"e{k}") for k in range(len(LOADINGS))],
    )
    cols = [
        (lam * F.col("f") + np.sqrt(1 - lam**2) * F.col(f"e{k}")).alias(v)
        for k, (v, lam) in enumerate(LOADINGS.items())
    ]
    wide = base.select(*PANEL_KEY, *cols)
    long = wide.unpivot(list(PANEL_KEY), list(LOADINGS), "var", "value")
    return long.withColumn("pillar", F.lit("loyalty"))


def test_loadings_are_recovered(spark):
    spec = RefreshSpec(pooled_pillars=("loyalty",), sample_seeds=(2, 3))
    fits = factor.pooled_factors(simulated(spark), spec).collect()
    assert len(fits) == 2 * len(LOADINGS)
    for r in fits:
        assert r["status"] == "ok" and r["n_rows"] == 3800
        assert abs(r["est_std"] - LOADINGS[r["var"]]) < 0.05
        assert r["cfi"] > 0.98 and r["rmsea"] < 0.05


def test_moments_equal_those_of_the_sample(spark):
    rows = simulated(spark, 600)
    spec = RefreshSpec(sample_seeds=(2, 5))
    got = factor.sample_moments(rows, ["pillar"], spec).toPandas()
    wide = rows.toPandas().pivot(index=list(PANEL_KEY), columns="var", values="value")
    wide = wide - wide.mean()
    sample = seeded_sample(rows, PANEL_KEY, 95, (2, 5)).where("taken").toPandas()
    for seed, part in sample.groupby("seed"):
        x = wide.loc[pd.MultiIndex.from_frame(part[list(PANEL_KEY)])]
        assert len(x) == 570
        for r in got[got["seed"] == seed].itertuples():
            want = x[r.var1].sum() if r.var2 == "" else (x[r.var1] * x[r.var2]).sum()
            assert abs(r.s - want) < 1e-8


def test_three_metrics_have_a_closed_form():
    r = np.array([[1, 0.48, 0.36], [0.48, 1, 0.3], [0.36, 0.3, 1.0]])
    load, unique, converged = factor.one_factor(r)
    assert converged
    assert np.allclose(load**2, [0.48 * 0.36 / 0.3, 0.48 * 0.3 / 0.36, 0.36 * 0.3 / 0.48], atol=1e-6)
    assert np.allclose(load**2 + unique, 1.0, atol=1e-6)
    assert factor.fit_indices(r, load, unique, 100) == (1.0, 1.0, 0.0)


def test_two_metrics_are_not_identified():
    pdf = pd.DataFrame(
        {"var1": ["a", "a", "b", "a", "b"], "var2": ["a", "b", "b", "", ""], "s": [50.0, 10.0, 50.0, 0.0, 0.0], "n_rows": 50}
    )
    out = factor.fit_moments(pdf)
    assert list(out["status"]) == ["not identified"] * 2 and out["est_std"].isna().all()


def test_ridge_solvers():
    rng = np.random.default_rng(1)
    for _ in range(300):
        p = int(rng.integers(1, 8))
        x = rng.normal(size=(60, p)) + 2 * rng.normal(size=(60, 1))
        y = rng.normal(size=60) + 0.3 * x[:, 0]
        alpha = float(rng.choice([0.001, 1.0, 10.0]))
        gram, cross = x.T @ x, x.T @ y
        free = drivers.solve_ridge(gram, cross, alpha, False)
        assert np.allclose(x.T @ (y - x @ free), alpha * free, atol=1e-8)
        b = drivers.solve_ridge(gram, cross, alpha, True)
        slope = gram @ b + alpha * b - cross
        assert b.min() >= 0 and slope.min() > -1e-8 and abs(slope @ b) < 1e-7


def learning_frame(spark, n=60):
    base = spark.range(n).select(
        F.lit("A").alias("brand"), F.lit("X").alias("category"), F.lit("loyalty").alias("pillar"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int") * 7).alias("date"),
        F.rand(1).alias("x1"), F.rand(2).alias("x2"), F.rand(3).alias("x3"),
    )
    wide = base.withColumn("dv", 2 * F.col("x1") - F.col("x2") + 5)
    ids = ["brand", "category", "pillar", "date", "dv"]
    return wide.unpivot(ids, ["x1", "x2", "x3"], "var", "value")


def test_ridge_finds_a_linear_signal(spark):
    rows = learning_frame(spark)
    results, predictions = drivers.ridge_model(rows, drivers.MODEL_KEY, ModelSpec(), RefreshSpec())
    got = {r["var"]: r for r in results.collect()}
    assert set(got) == {"x1", "x2", "x3"}
    assert abs(got["x1"]["importance"] - 2) < 0.01 and abs(got["x2"]["importance"] + 1) < 0.01
    assert got["x1"]["attribution"] > got["x2"]["attribution"] > got["x3"]["attribution"]
    assert got["x1"]["r2_holdout"] > 0.999 and got["x1"]["best_params"] == "alpha=0.001"
    assert predictions.count() == 60 and predictions.where("split = 'holdout'").count() == 6


def test_positive_ridge_drops_the_negative_effect(spark):
    spec = RefreshSpec()
    results, _ = drivers.ridge_model(learning_frame(spark), drivers.MODEL_KEY, ModelSpec(positive=True), spec)
    got = {r["var"]: r["importance"] for r in results.collect()}
    assert got["x2"] == 0.0 and got["x1"] > 1.5


def test_forest_ranks_the_signal_first(spark):
    model = ModelSpec(folds=2, forest=TreeGrid((3,), (10,), (3,)))
    samples = drivers.learning_rows(learning_frame(spark, 200), drivers.MODEL_KEY, model, RefreshSpec())
    found, predictions = forests.tree_model(samples, FOREST, model, ["brand", "category"])
    got = {r["var"]: r["attribution"] for r in found.collect()}
    assert got["x1"] > got["x2"] > got["x3"]
    assert predictions.count() == 200


def test_pillar_importance_by_every_configured_model(spark):
    """Ridge and the forest attribute the share to the pillar that drives it."""
    spec = RefreshSpec()
    names = spec.pillars[:3]
    wide = spark.range(240).select(
        F.concat(F.lit("B"), (F.col("id") % 2).cast("string")).alias("brand"), F.lit("X").alias("category"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") / 2).cast("int")).alias("date"),
        *[F.randn(3 + k).alias(f"{p}_trend_past") for k, p in enumerate(names)],
    )
    sales = wide.select(*PANEL_KEY, (5 + 2 * F.col(f"{names[0]}_trend_past") + 0.2 * F.col(f"{names[1]}_trend_past")).alias(spec.dv))
    features = wide.unpivot(list(PANEL_KEY), [f"{p}_trend_past" for p in names], "var", "value")
    parents = spark.createDataFrame([], "category_new string, category string")
    small = replace(spec.importance_model, folds=2, run=(RIDGE, FOREST), forest=TreeGrid((3,), (10,), (3,)))
    results = importance.pillar_importance(features, sales, parents, replace(spec, importance_model=small))
    for kind in (RIDGE, FOREST):
        shares = importance.relative_importance(results, kind).collect()
        assert {r["brand"] for r in shares} == {"B0", "B1"}, kind
        for brand in ("B0", "B1"):
            best = max((r for r in shares if r["brand"] == brand), key=lambda r: r["relative_importance"])
            assert best["var"] == f"{names[0]}_trend_past", kind


def test_features_of_unequal_dates_share_the_draw(spark):
    """A model row is drawn once: a date's features are all training rows of one fold, or all held out."""
    rows = learning_frame(spark, 60).where("var <> 'x2' or day(date) % 3 = 0")
    got = drivers.learning_rows(rows, drivers.MODEL_KEY, ModelSpec(folds=4), RefreshSpec())
    per_date = got.groupBy("date").agg(F.countDistinct("split", F.coalesce("fold", F.lit(0))).alias("n"), F.first("split").alias("s"))
    assert {r["n"] for r in per_date.collect()} == {1}
    assert per_date.where("s = 'holdout'").count() == 6


def test_grid_order():
    grid = forests.grid_settings(TreeGrid((2, 3), (5, 9)))
    assert grid[0] == {"max_depth": 2, "n_trees": 5} and grid[-1] == {"max_depth": 3, "n_trees": 9}


def test_seeded_sample_equals_a_full_rank(spark):
    rows = spark.range(5000).select(
        F.concat(F.lit("B"), F.col("id").cast("string")).alias("brand"),
        F.when(F.col("id") % 3 == 0, "X").otherwise("Y").alias("category"),
        F.lit("2000-01-01").cast("date").alias("date"),
    )
    got = seeded_sample(rows, PANEL_KEY, 95, (2, 3), ["category"]).where("taken").toPandas()
    import hashlib

    for seed in (2, 3):
        for cat in "XY":
            names = [f"B{k}" for k in range(5000) if (cat == "X") == (k % 3 == 0)]
            ranked = sorted(names, key=lambda b: hashlib.md5(f"{b}~{cat}~2000-01-01~{seed}".encode()).hexdigest())
            want = set(ranked[: len(names) * 95 // 100])
            assert set(got[(got["seed"] == seed) & (got["category"] == cat)]["brand"]) == want


def test_hot_group_statistics(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    got = with_group_stats(rows, ["k"], F.count("*").alias("n"))
    assert got.count() == 3000 and got.where("k = 'hot'").first()["n"] == 2000


def test_feature_selection_keeps_the_best(spark, inputs):
    from dataclasses import replace

    from equitrace.plans import refresh

    model = ModelSpec(selection="forest", folds=2, forest=TreeGrid((2,), (5,), (2,)))
    spec = replace(inputs.spec, weights_model=model, top_features=2)
    rows = refresh.weight_rows(inputs.modelling(), inputs.maps(), spec).where("pillar = 'loyalty'")
    kept = refresh.select_features(rows, inputs.maps(), spec)
    per_key = kept.select("brand", "category", "pillar", "var").distinct().groupBy("brand", "category").count()
    assert per_key.where("count > 2").count() == 0 and per_key.count() > 0


def test_components_of_keys_against_svd(spark):
    draw = np.random.default_rng(3)
    rows, data = [], {}
    for brand, p in (("a", 5), ("b", 3), ("flat", 2), ("c", 1)):
        x = draw.normal(size=(40, p)) @ draw.normal(size=(p, p)) * (brand != "flat")
        data[brand] = x
        for d in range(40):
            split = "train" if d < 34 else "holdout"
            rows += [(brand, "X", dt.date(2000, 1, 1) + dt.timedelta(days=d), f"m{j}", float(x[d, j]), 1.0, split) for j in range(p)]
    frame = spark.createDataFrame(rows, "brand string, category string, date date, var string, value double, dv double, split string")
    got = stats.component_rows(frame, ("brand", "category"))
    assert got.columns == frame.columns
    got = got.toPandas()
    assert set(got["brand"]) == {"a", "b", "c"}
    loads = stats.component_loadings(frame, ("brand", "category")).toPandas()
    for brand in ("a", "b", "c"):
        x, train = data[brand], data[brand][:34]
        _, sv, axes = np.linalg.svd(train - train.mean(axis=0), full_matrices=False)
        part = sv**2 / (sv**2).sum()
        n = int(np.searchsorted(np.cumsum(part), 0.95, side="right")) + 1
        mine = loads[loads["brand"] == brand]
        assert np.allclose(mine.drop_duplicates("component").sort_values("component")["explained"], part[:n])
        assert all(g.loc[g["loading"].abs().idxmax(), "loading"] > 0 for _, g in mine.groupby("component"))
        wide = got[got["brand"] == brand].pivot(index="date", columns="var", values="value")
        assert list(wide.columns) == [f"pca{k}" for k in range(n)] and len(wide) == 40
        assert np.allclose(np.abs(wide.to_numpy()), np.abs((x - train.mean(axis=0)) @ axes[:n].T))


def test_settings_of_equal_error_rank_in_their_order(frame):
    """What differs only by the order of a sum is a tie, which the first setting wins."""
    error = 0.12238091740363462
    mapes = {0: error, 1: error - 1.4e-17, 2: error - 2.8e-17, 3: error - 1e-9, 4: None, 5: error + 1.4e-17}
    rows = frame([("A", g, 0.5, m) for g, m in mapes.items()], "brand string, grid_no int, r2 double, mape double")
    table = drivers.selection_table(rows, ["brand"], ["grid_no"])
    assert table.columns == ["brand", "grid_no", "r2_fold", "mape_fold", "rank"]
    assert {r["grid_no"]: r["rank"] for r in table.collect()} == {3: 1, 0: 2, 1: 3, 2: 4, 5: 5, 4: 6}
