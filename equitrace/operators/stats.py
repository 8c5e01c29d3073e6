"""Learning data sets: metric lists, eligibility, splits, folds, correlations, fit metrics."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equitrace.functions.exprs import clean_name, draw_key, ratio
from equitrace.functions.grouping import PANEL_KEY, SERIES, by_date, one_per_key, with_group_stats
from equitrace.spec import RefreshSpec

MIN_SPREAD = 1e-12
EPS = 2.220446049250313e-16  # fixed value: smallest denominator of a percentage error


def correlation(x: str, y: str) -> Column:
    """Pearson correlation over complete pairs; null where either side is constant."""
    a, b = F.col(x), F.col(y)
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.when(spread > MIN_SPREAD, F.covar_pop(a, b) / spread)


def without_pattern(rows: DataFrame, *patterns: str) -> DataFrame:
    """Leave out metrics whose name holds one of the patterns."""
    for p in patterns:
        rows = rows.where(~F.col("var").contains(p))
    return rows


def normalise_names(rows: DataFrame) -> DataFrame:
    return rows.withColumn("var", clean_name("var"))


def pillar_metrics(dictionary: DataFrame, forced: Sequence[str] = ()) -> DataFrame:
    """Distinct (category, pillar, var) to model; a forced list replaces the selection."""
    rows = normalise_names(dictionary.where(F.col("pillar").isNotNull()))
    rows = rows.where(F.col("var").isin(*forced) if forced else F.col("select_flag") == "Y")
    return rows.select("category", "pillar", "var").distinct()


def by_pillar(rows: DataFrame, dictionary: DataFrame, forced: Sequence[str] = ()) -> DataFrame:
    """Metric rows with the pillar they belong to."""
    return normalise_names(rows).join(pillar_metrics(dictionary, forced), ["category", "var"])


def present_in_pool(rows: DataFrame) -> DataFrame:
    """Brand-level rows of the metrics that have at least one value in their category's pool."""
    pool = (
        rows.where(F.col("scope") == "category")
        .groupBy("category", "var")
        .agg(F.count("value").alias("n"))
        .where(F.col("n") > 0)
    )
    return rows.where(F.col("scope") == "brand").join(pool.drop("n"), ["category", "var"], "left_semi")


def eligibility(rows: DataFrame, spec: RefreshSpec, keys: Sequence[str] = SERIES) -> DataFrame:
    """Size and status of every model key; one row per key, also for those that cannot run."""
    dates = rows.groupBy(*keys, "date").agg(
        F.count("*").alias("n_metrics"), F.max("dv").alias("dv")
    )
    sizes = dates.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.max("n_metrics").alias("n_metrics"),
        F.sum("dv").alias("dv_sum"),
    )
    status = (
        F.when(F.col("category").isin(*spec.excluded_categories), "excluded category")
        .when(F.coalesce("dv_sum", F.lit(0.0)) <= 0, "no sales")
        .when(F.col("n_rows") <= spec.min_rows, "too few rows")
        .when(F.col("n_metrics") < 2, "too few metrics")
        .otherwise("ok")
    )
    return sizes.withColumn("status", status)


def eligible(rows: DataFrame, spec: RefreshSpec, keys: Sequence[str] = SERIES) -> DataFrame:
    ok = eligibility(rows, spec, keys).where(F.col("status") == "ok")
    return rows.join(ok.select(*keys), list(keys), "left_semi")


def run_log(rows: DataFrame, spec: RefreshSpec, keys: Sequence[str] = SERIES) -> DataFrame:
    """Row count and success flag per key."""
    return eligibility(rows, spec, keys).select(
        *keys, "n_rows", (F.col("status") == "ok").alias("success"), "status"
    )


def fill_dv(rows: DataFrame, keys: Sequence[str] = (*SERIES, "var")) -> DataFrame:
    """Missing dependent values become their mean in the series."""
    filled = with_group_stats(rows, keys, F.avg("dv").alias("_dv"))
    return filled.withColumn("dv", F.coalesce("dv", "_dv")).select(*rows.columns)


def drop_and_fill(rows: DataFrame) -> DataFrame:
    """Drop metrics of a series with half their values missing, fill the rest with their mean."""
    counted = with_group_stats(
        rows,
        [*SERIES, "var"],
        F.count("*").alias("n"),
        F.count_if(F.col("value").isNull()).alias("nulls"),
        F.avg("value").alias("mean"),
    )
    return (
        counted.where(F.col("nulls") < F.col("n") * 0.5)
        .withColumn("value", F.coalesce("value", "mean"))
        .select(*rows.columns)
    )


def drop_log(
    rows: DataFrame, drop_means: bool = False, drop_ranks: bool = False
) -> DataFrame:
    """First reason why a metric of a series is left out; null where it stays."""
    none = F.lit(None).cast("string")
    reason = F.coalesce(
        F.when(F.lit(drop_means) & F.col("var").contains("_mean"), "mean column"),
        F.when(F.lit(drop_ranks) & F.col("var").contains("_rank_1st"), "Rank column"),
        F.when(F.col("nulls") >= F.col("n") * 0.5, "> 50 % null"),
        none,
    )
    sizes = rows.groupBy(*SERIES, "var").agg(
        F.count("*").alias("n"), F.count_if(F.col("value").isNull()).alias("nulls")
    )
    return sizes.withColumn("reason", reason)


def log_dv(rows: DataFrame) -> DataFrame:
    return rows.withColumn("dv", F.log1p("dv"))


def trim_start(rows: DataFrame, n: int = 3, keys: Sequence[str] = (*SERIES, "var")) -> DataFrame:
    """Drop the first rows of each series."""
    return (
        rows.withColumn("_rn", F.row_number().over(by_date(*keys)))
        .where(F.col("_rn") > n)
        .drop("_rn")
    )


def split_by_time(
    rows: DataFrame, keys: Sequence[str], train_rows: int | None = None, holdout_rows: int = 6
) -> DataFrame:
    """The first rows train, or all but the last ones."""
    if train_rows is not None:
        train = F.row_number().over(by_date(*keys)) <= train_rows
    else:
        newest = Window.partitionBy(*keys).orderBy(F.col("date").desc())
        train = F.row_number().over(newest) > holdout_rows
    return rows.withColumn("split", F.when(train, "train").otherwise("holdout"))


def _drawn(keys: Sequence[str], seed: int) -> Window:
    return Window.partitionBy(*keys).orderBy(draw_key(PANEL_KEY, seed))


def split_at_random(rows: DataFrame, keys: Sequence[str], holdout_rows: int = 6, seed: int = 2) -> DataFrame:
    """A seeded hold-out of exactly so many rows per key."""
    held = F.row_number().over(_drawn(keys, seed)) <= holdout_rows
    return rows.withColumn("split", F.when(held, "holdout").otherwise("train"))


def folds(rows: DataFrame, keys: Sequence[str], k: int, seed: int = 2, by_time: bool = False) -> DataFrame:
    """k contiguous folds of the training rows, larger ones first; hold-out rows have none."""
    grouped = [*keys, "split"]
    window = by_date(*grouped) if by_time else _drawn(grouped, seed)
    return rows.withColumn("fold", F.when(F.col("split") == "train", F.ntile(k).over(window)))


def dv_correlation(rows: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Correlation of every metric with the dependent variable, per key."""
    return (
        rows.groupBy(*keys, "var")
        .agg(correlation("value", "dv").alias("corr"))
        .withColumn("corr_abs", F.abs("corr"))
    )


def correlation_pairs(rows: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Correlation of every two metrics per key, both directions, without self pairs.

    The metrics of one panel row, a list bounded by the dictionary, are paired in place; each
    unordered pair is aggregated once, on the map side first, and mirrored at the end.
    """
    cell = [*keys, *[c for c in PANEL_KEY if c not in keys]]
    cells = rows.groupBy(*cell).agg(
        F.array_sort(F.collect_list(F.struct("var", "value"))).alias("m")
    )
    pairs = F.expr(
        "flatten(transform(m, (a, i) -> transform(slice(m, i + 2, size(m)), b -> "
        "struct(a.var as var1, b.var as var2, a.value as x, b.value as y))))"
    )
    once = (
        cells.select(*keys, F.explode(pairs).alias("p"))
        .select(*keys, "p.*")
        .groupBy(*keys, "var1", "var2")
        .agg(correlation("x", "y").alias("corr"))
    )
    both = F.array(
        F.struct(F.col("var1").alias("variable_1"), F.col("var2").alias("variable_2")),
        F.struct(F.col("var2").alias("variable_1"), F.col("var1").alias("variable_2")),
    )
    return once.select(*keys, F.explode(both).alias("p"), "corr").select(*keys, "p.*", "corr")


def drop_counter_intuitive(
    correlations: DataFrame, dictionary: DataFrame, cutoff: float = 0.30
) -> DataFrame:
    """Leave out metrics that move against their expected sign beyond the cut-off."""
    signs = one_per_key(
        dictionary.select("category", "var", "expected_sign"), ["category", "var"]
    )
    against = ((F.col("expected_sign") == "P") & (F.col("corr") < -cutoff)) | (
        (F.col("expected_sign") == "N") & (F.col("corr") > cutoff)
    )
    return correlations.join(signs, ["category", "var"]).where(~F.coalesce(against, F.lit(False)))


def select_by_correlation(correlations: DataFrame, cutoff: float = 0.4) -> DataFrame:
    return correlations.where(F.col("corr_abs") > cutoff)


def top_features(
    importance: DataFrame, keys: Sequence[str], k: int = 20, by: str = "importance"
) -> DataFrame:
    """The k most important features per key; a key has one row per metric of its pillar."""
    order = Window.partitionBy(*keys).orderBy(F.col(by).desc_nulls_last(), "var")
    return (
        importance.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    )


def principal_components(
    wide: DataFrame, features: Sequence[str], share: float = 0.95, out: str = "components"
) -> DataFrame:
    """Project centred features on as many components as explain `share` of the variance."""
    assembled = VectorAssembler(inputCols=list(features), outputCol="_raw").transform(wide)
    centred = (
        StandardScaler(inputCol="_raw", outputCol="_centred", withMean=True, withStd=False)
        .fit(assembled)
        .transform(assembled)
    )
    model = PCA(k=len(features), inputCol="_centred", outputCol="_all").fit(centred)
    reached, n = 0.0, 0
    for part in model.explainedVariance:
        if reached >= share:
            break
        reached, n = reached + float(part), n + 1
    slicer = VectorSlicer(inputCol="_all", outputCol=out, indices=list(range(n)))
    return slicer.transform(model.transform(centred)).drop("_raw", "_centred", "_all")


def _components_of(pdf: pd.DataFrame, keys: Sequence[str], share: float) -> pd.DataFrame:
    """Loadings of one key from its sums of products, largest variance first.

    Components are taken until they explain more than `share`; a key without variance has none. A
    component's largest loading is positive.
    """
    names = sorted(set(pdf["var1"]))
    at = {v: j for j, v in enumerate(names)}
    gram = np.zeros((len(names), len(names)))
    for a, b, s in zip(pdf["var1"], pdf["var2"], pdf["s"], strict=True):
        gram[at[a], at[b]] = gram[at[b], at[a]] = s
    values, vectors = np.linalg.eigh(gram)
    values, vectors = np.clip(values[::-1], 0.0, None), vectors[:, ::-1]
    out = []
    if values.sum() > MIN_SPREAD:
        part = values / values.sum()
        for k in range(int((np.cumsum(part) - part <= share).sum())):
            load = vectors[:, k] * np.sign(vectors[np.abs(vectors[:, k]).argmax(), k])
            out += [(k, float(part[k]), v, float(c)) for v, c in zip(names, load, strict=True)]
    res = pd.DataFrame(out, columns=["component", "explained", "var", "loading"])
    for k in reversed(keys):
        res.insert(0, k, pdf[k].iloc[0])
    return res


def component_loadings(rows: DataFrame, keys: Sequence[str], share: float = 0.95) -> DataFrame:
    """Principal components of every key's metrics over its training rows: component, explained, var, loading.

    Sums of products come from one aggregate over all keys; Python sees one small matrix a key. A missing
    value stands at the metric's mean and adds nothing.
    """
    train = with_group_stats(rows.where(F.col("split") == "train"), [*keys, "var"], F.avg("value").alias("mean"))
    cell = F.struct("var", F.coalesce(F.col("value") - F.col("mean"), F.lit(0.0)).alias("x"))
    cells = train.groupBy(*keys, "date").agg(F.array_sort(F.collect_list(cell)).alias("m"))
    pairs = F.expr(
        "flatten(transform(m, (a, i) -> transform(slice(m, i + 1, size(m)), "
        "b -> struct(a.var as var1, b.var as var2, a.x * b.x as s))))"
    )
    sums = cells.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.*")
    sums = sums.groupBy(*keys, "var1", "var2").agg(F.sum("s").alias("s"))
    key_list = list(keys)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        return _components_of(pdf, key_list, share)

    schema = ", ".join(f"{k} string" for k in keys) + ", component int, explained double, var string, loading double"
    return sums.groupBy(*keys).applyInPandas(solve, schema)


def component_rows(rows: DataFrame, keys: Sequence[str], share: float = 0.95) -> DataFrame:
    """Learning rows whose features are the components of the key's metrics, named pca0, pca1, ...

    The components are fitted on the training rows; all rows are projected. A key without variance has no rows.
    """
    train = rows.where(F.col("split") == "train").groupBy(*keys, "var").agg(F.avg("value").alias("mean"))
    loadings = component_loadings(rows, keys, share).drop("explained").join(train, [*keys, "var"])
    part = F.coalesce(F.col("value") - F.col("mean"), F.lit(0.0)) * F.col("loading")
    rest = [c for c in rows.columns if c not in (*keys, "date", "var", "value")]
    projected = rows.join(loadings, [*keys, "var"]).groupBy(*keys, "date", "component").agg(
        F.sum(part).alias("value"), *[F.max(c).alias(c) for c in rest]
    )
    name = F.concat(F.lit("pca"), F.col("component").cast("string")).alias("var")
    return projected.select(*[name if c == "var" else F.col(c) for c in rows.columns])


def regression_metrics(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """R2, MAE, MSE, RMSE and MAPE per key from columns `dv` and `predicted`."""
    error = F.col("dv") - F.col("predicted")
    size = F.greatest(F.abs("dv"), F.lit(EPS))
    stats = predictions.where(F.col("dv").isNotNull() & F.col("predicted").isNotNull()).groupBy(
        *keys
    ).agg(
        F.count("*").alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(F.abs(error) / size).alias("mape"),
        F.var_pop("dv").alias("_spread"),
    )
    return stats.select(
        *keys,
        "n",
        (F.lit(1.0) - ratio("mse", "_spread")).alias("r2"),
        "mae",
        "mse",
        F.sqrt("mse").alias("rmse"),
        "mape",
    )


def actual_vs_predicted(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    return predictions.select(
        *keys, "date", F.col("dv").alias("actual"), F.col("predicted").alias("predicted")
    )


def latest_dv(rows: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Last known dependent value of a key."""
    known = rows.where(F.col("dv").isNotNull())
    return known.groupBy(*keys).agg(F.max_by("dv", "date").alias("latest_dv"))


def distinct_rows(rows: DataFrame) -> DataFrame:
    return rows.dropDuplicates()


def categories_of_brands(brand_list: DataFrame) -> DataFrame:
    """Brand to its list of categories; the list is as long as the brand's rows in scope."""
    return brand_list.groupBy("brand").agg(
        F.array_sort(F.collect_set("category")).alias("categories")
    )
