"""Linear driver models of the dependent variable: fit, select, attribute, report."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from equitrace.functions.exprs import ratio
from equitrace.functions.grouping import PANEL_KEY, with_group_stats
from equitrace.operators import stats
from equitrace.sources.workspace import stage
from equitrace.spec import RIDGE, ModelSpec, RefreshSpec

MODEL_KEY = ("brand", "category", "pillar")
#: errors of settings that differ by no more than this are a tie: sums taken in another order differ by less
SAME_ERROR = 1e-12


def learning_rows(rows: DataFrame, keys: Sequence[str], model: ModelSpec, spec: RefreshSpec) -> DataFrame:
    """Split and fold the rows of every model key.

    What is drawn is a model row, a date of a key: all its features go the same way, whichever dates a
    feature has.
    """
    if model.log_dv:
        rows = stats.log_dv(rows)
    on = list(dict.fromkeys([*keys, *PANEL_KEY]))
    dates = rows.select(*on).distinct()
    if model.time_split:
        split = stats.split_by_time(dates, keys, holdout_rows=spec.holdout_rows)
    else:
        split = stats.split_at_random(dates, keys, spec.holdout_rows, spec.holdout_seed)
    folded = stats.folds(split, keys, model.folds, spec.holdout_seed, model.time_split)
    return rows.join(folded, on)


def solve_ridge(gram: np.ndarray, cross: np.ndarray, alpha: float, positive: bool) -> np.ndarray:
    """Minimise |y - Xb|^2 + alpha |b|^2 on centred moments; optionally with b >= 0.

    The bounded case frees one coefficient at a time and steps back where one turns negative.
    """
    a = gram + alpha * np.eye(len(cross))
    if not positive:
        return np.linalg.solve(a, cross)
    b, free = np.zeros(len(cross)), np.zeros(len(cross), dtype=bool)
    for _ in range(10 * len(cross)):
        gain = np.where(free, -np.inf, cross - a @ b)
        if gain.max() <= 1e-12:
            break
        free[gain.argmax()] = True
        while True:
            trial = np.zeros(len(cross))
            trial[free] = np.linalg.solve(a[np.ix_(free, free)], cross[free])
            if trial[free].min(initial=0.0) >= 0.0:
                b = trial
                break
            out = free & (trial < 0.0)
            b = b + (b[out] / (b[out] - trial[out])).min() * (trial - b)
            free &= b > 1e-15
    return b


def _ridge_of_key(pdf: pd.DataFrame, keys: Sequence[str], alphas: Sequence[float], positive: bool):
    x = pdf.pivot(index="date", columns="var", values="value").dropna().sort_index()
    rows = pdf.drop_duplicates("date").set_index("date").loc[x.index]
    y, fold = rows["dv"].to_numpy(float), rows["fold"].to_numpy(int)
    xs, names = x.to_numpy(float), list(x.columns)
    out = []
    for f in [0, *sorted(set(fold))]:
        use = fold != f
        mx, my = xs[use].mean(axis=0), y[use].mean()
        xc, yc = xs[use] - mx, y[use] - my
        gram, cross = xc.T @ xc, xc.T @ yc
        for i, alpha in enumerate(alphas):
            b = solve_ridge(gram, cross, alpha, positive)
            out += [(i, float(alpha), int(f), v, c, my - mx @ b) for v, c in zip(names, b, strict=True)]
    res = pd.DataFrame(out, columns=["grid_no", "alpha", "fold", "var", "coef", "intercept"])
    for k in reversed(keys):
        res.insert(0, k, pdf[k].iloc[0])
    return res


def ridge_coefficients(
    rows: DataFrame, keys: Sequence[str], alphas: Sequence[float], positive: bool = False
) -> DataFrame:
    """Coefficients per key, alpha and left-out fold; fold 0 is the fit on all training rows.

    All keys run in one job. A group is one series by the metrics of its pillar, so its size is
    set by the calendar and the dictionary, not by the volume of facts.
    """
    key_list, alpha_list = list(keys), list(alphas)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        return _ridge_of_key(pdf, key_list, alpha_list, positive)

    schema = ", ".join(f"{k} string" for k in keys) + (
        ", grid_no int, alpha double, fold int, var string, coef double, intercept double"
    )
    train = rows.where(
        (F.col("split") == "train") & F.col("dv").isNotNull() & F.col("value").isNotNull()
    ).select(*keys, "date", "var", "value", "dv", "fold")
    return train.groupBy(*keys).applyInPandas(solve, schema)


def linear_predictions(rows: DataFrame, coefs: DataFrame, keys: Sequence[str], by_fold: bool) -> DataFrame:
    """Predictions per key, alpha and date: on the fold left out, or on every row."""
    if by_fold:
        on = [*keys, "var", "fold"]
        joined = rows.join(coefs.where(F.col("fold") > 0), on)
    else:
        on = [*keys, "var"]
        joined = rows.join(coefs.where(F.col("fold") == 0).drop("fold"), on)
    return joined.groupBy(*keys, "grid_no", "alpha", "date", "split", "fold").agg(
        (F.sum(F.col("value") * F.col("coef")) + F.max("intercept")).alias("predicted"),
        F.max("dv").alias("dv"),
    )


def selection_table(fold_metrics: DataFrame, keys: Sequence[str], setting: Sequence[str]) -> DataFrame:
    """Mean fold metrics per setting and the rank by error; the first setting wins a tie.

    Settings that predict the same have the same error but for the order in which sums were taken, so a
    new place begins only where the error grows by more than SAME_ERROR.
    """
    means = fold_metrics.groupBy(*keys, *setting).agg(
        F.avg("r2").alias("r2_fold"), F.avg("mape").alias("mape_fold")
    )
    of_key = Window.partitionBy(*keys)
    by_error = of_key.orderBy(F.col("mape_fold").asc_nulls_last(), "grid_no")
    before = F.lag("mape_fold").over(by_error)
    grows = (F.col("mape_fold") - before > SAME_ERROR) | (F.col("mape_fold").isNull() & before.isNotNull())
    placed = means.withColumn("_grows", F.coalesce(grows, F.lit(False)).cast("int"))
    placed = placed.withColumn("_place", F.sum("_grows").over(by_error))
    return placed.withColumn("rank", F.row_number().over(of_key.orderBy("_place", "grid_no"))).drop("_grows", "_place")


def linear_attribution(rows: DataFrame, coefs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean absolute contribution of a feature in a linear model: |coef| * mean|x - mean x|."""
    series = [*keys, "var"]
    spread = (
        with_group_stats(rows, series, F.avg("value").alias("_mean"))
        .groupBy(*series)
        .agg(F.avg(F.abs(F.col("value") - F.col("_mean"))).alias("_spread"))
    )
    return coefs.join(spread, series).select(
        *series, "coef", (F.abs("coef") * F.col("_spread")).alias("attribution")
    )


def fit_report(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Train, hold-out and overall fit of every key in one row."""
    parts = stats.regression_metrics(
        predictions.withColumn("part", F.explode(F.array("split", F.lit("all")))), [*keys, "part"]
    )
    aggs = [
        F.max(F.when(F.col("part") == p, F.col(m))).alias(f"{m}_{p}")
        for p in ("train", "holdout", "all")
        for m in ("r2", "mape")
    ]
    return parts.groupBy(*keys).agg(*aggs)


def result_rows(
    attribution: DataFrame,
    report: DataFrame,
    selected: DataFrame,
    latest: DataFrame,
    keys: Sequence[str],
    model: str,
) -> DataFrame:
    """One row per feature: importance, attribution, fit, latest value, chosen setting."""
    return (
        attribution.withColumnRenamed("coef", "importance")
        .join(report, list(keys), "left")
        .join(selected, list(keys), "left")
        .join(latest, list(keys), "left")
        .withColumn("model", F.lit(model))
    )


def ridge_model(
    rows: DataFrame, keys: Sequence[str], model: ModelSpec, spec: RefreshSpec
) -> tuple[DataFrame, DataFrame]:
    """Grid search, refit and report of the ridge model of every key: results and predictions.

    Samples and coefficients are read by several steps, so each is written once.
    """
    samples = stage(learning_rows(rows, keys, model, spec), "samples")
    coefs = stage(ridge_coefficients(samples, keys, model.alphas, model.positive), "coefficients")
    fold_metrics = stats.regression_metrics(
        linear_predictions(samples, coefs, keys, by_fold=True), [*keys, "grid_no", "alpha", "fold"]
    )
    best = (
        selection_table(fold_metrics, keys, ["grid_no", "alpha"])
        .where(F.col("rank") == 1)
        .select(
            *keys,
            "grid_no",
            "r2_fold",
            "mape_fold",
            F.concat(F.lit("alpha="), F.col("alpha").cast("string")).alias("best_params"),
        )
    )
    chosen = coefs.join(best.select(*keys, "grid_no"), [*keys, "grid_no"], "left_semi")
    predictions = linear_predictions(samples, chosen, keys, by_fold=False)
    train = samples.where(F.col("split") == "train")
    results = result_rows(
        linear_attribution(train, chosen.where(F.col("fold") == 0), keys),
        fit_report(predictions, keys),
        best.drop("grid_no"),
        stats.latest_dv(samples, keys),
        keys,
        RIDGE,
    )
    return results, predictions


def relative_share(rows: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """A value as a share of its key's sum."""
    return with_group_stats(rows, keys, F.sum(value).alias("_sum")).withColumn(
        out, ratio(value, "_sum")
    ).drop("_sum")
