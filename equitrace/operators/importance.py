"""Relative importance of pillars and the detailed hub table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitrace.functions.exprs import ratio, without_suffix
from equitrace.functions.grouping import PANEL_KEY, SERIES, one_per_key, with_group_stats
from equitrace.operators import drivers, forests, stats
from equitrace.operators.scores import add_lags
from equitrace.sources.workspace import stage
from equitrace.spec import METRIC_TYPES, PILLAR_SUFFIX, RIDGE, RefreshSpec


PRICE_FEATURES = ("average_price", "acv_selling")


def parent_category(rows: DataFrame, parents: DataFrame) -> DataFrame:
    """Sales category of a row; the original stays as `category_new`."""
    names = one_per_key(parents.select("category_new", F.col("category").alias("parent")), ["category_new"])
    return (
        rows.withColumnRenamed("category", "category_new")
        .join(names, "category_new", "left")
        .withColumn("category", F.coalesce("parent", "category_new"))
        .drop("parent")
    )


def join_sales(rows: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales measures of the row's (parent) category."""
    return rows.join(sales, list(PANEL_KEY), "left")


def trend_family(
    features: DataFrame, pillars: Sequence[str], lags: bool = False, extra: Sequence[str] = ()
) -> DataFrame:
    """Past trends of the known pillars, with or without lags, and listed sales measures."""
    var = F.col("var")
    of_pillar = var.rlike("^(" + "|".join(pillars) + ")")
    keep = of_pillar & var.contains("_trend_past") & ~var.contains("_trend_past_future")
    if not lags:
        keep = keep & ~var.contains("_lag")
    return features.where(keep | var.isin(*extra))


def importance_rows(features: DataFrame) -> DataFrame:
    """Drop features with more than half missing, trim the start, fill with the mean.

    The share of missing values is taken before the trim, the mean after it.
    """
    series = [*SERIES, "var"]
    counted = with_group_stats(
        features,
        series,
        F.count("*").alias("_n"),
        F.count_if(F.col("value").isNull()).alias("_nulls"),
    )
    kept = counted.where(F.col("_nulls") <= F.col("_n") * 0.5).drop("_n", "_nulls")
    trimmed = stats.trim_start(kept, 3, series)
    filled = with_group_stats(trimmed, series, F.avg("value").alias("_mean"))
    return filled.withColumn("value", F.coalesce("value", "_mean")).drop("_mean")


def standardise(rows: DataFrame) -> DataFrame:
    """Population z-score per feature of a series; a constant feature gives 0."""
    sized = with_group_stats(
        rows, [*SERIES, "var"], F.avg("value").alias("_mean"), F.stddev_pop("value").alias("_std")
    )
    z = F.when(
        F.col("_std") > stats.MIN_SPREAD, (F.col("value") - F.col("_mean")) / F.col("_std")
    ).otherwise(F.lit(0.0))
    return sized.withColumn("value", F.when(F.col("value").isNotNull(), z)).drop("_mean", "_std")


def enough_features(rows: DataFrame, least: int = 3) -> DataFrame:
    """Series with more than two features."""
    counts = (
        rows.groupBy(*SERIES, "var")
        .agg(F.count("value").alias("n"))
        .groupBy(*SERIES)
        .agg(F.count_if(F.col("n") > 0).alias("n_features"))
    )
    return rows.join(
        counts.where(F.col("n_features") >= least).select(*SERIES), list(SERIES), "left_semi"
    )


def price_and_distribution(keys: DataFrame, sales: DataFrame) -> DataFrame:
    """Price and distribution as further features of the same rows; null where nothing was sold."""
    priced = join_sales(keys, sales.select(*PANEL_KEY, *PRICE_FEATURES))
    return priced.unpivot(keys.columns, list(PRICE_FEATURES), "var", "value")


def pillar_importance(
    features: DataFrame, sales: DataFrame, parents: DataFrame, spec: RefreshSpec
) -> DataFrame:
    """Every configured driver model of the dependent variable on pillar trends, for every brand and category.

    Sales are those of the parent category; results carry the row's own category. Every model is fitted for
    each brand and category. Columns that only one kind of model has are null for the other.
    """
    model = spec.importance_model
    chosen = trend_family(add_lags(features) if model.lags else features, spec.pillars, model.lags)
    dv = sales.select(*PANEL_KEY, F.col(spec.dv).alias("dv"))
    rows = parent_category(chosen, parents)
    if model.price_and_distribution:
        keys = rows.select("brand", "category_new", "category", "date").distinct()
        rows = rows.unionByName(price_and_distribution(keys, sales))
    rows = (
        join_sales(rows, dv).drop("category").withColumnRenamed("category_new", "category")
    )
    rows = stats.fill_dv(importance_rows(rows))
    if model.standardize:
        rows = standardise(rows)
    rows, parts = enough_features(rows), []
    kinds = [k for k in model.run if k != RIDGE]
    if RIDGE in model.run or not kinds:
        parts.append(drivers.ridge_model(rows, SERIES, model, spec)[0])
    if kinds:
        samples = stage(drivers.learning_rows(rows, SERIES, model, spec), "importance-samples")
        parts += [forests.tree_model(samples, kind, model, SERIES)[0] for kind in kinds]
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts)


def relative_importance(results: DataFrame, model: str) -> DataFrame:
    """Attribution of a pillar as a share of its brand and category."""
    rows = results.where(F.col("model") == model).select(*SERIES, "var", "attribution")
    return drivers.relative_share(rows, SERIES, "attribution", "relative_importance")


def metric_contribution(index: DataFrame, weights: DataFrame) -> DataFrame:
    """Value times weight; rows without a weight keep a null contribution."""
    sheet = one_per_key(
        weights.select(
            "category",
            F.lower("metric").alias("var"),
            without_suffix("pillar").alias("equity_pillar"),
            "weight",
        ),
        ["category", "var", "equity_pillar"],
    )
    return index.join(sheet, ["category", "var", "equity_pillar"], "left").withColumn(
        "metric_contribution", F.col("value") * F.col("weight")
    )


def category_contribution(rows: DataFrame) -> DataFrame:
    """Category mean of the contribution on the date, and the distance to it."""
    return with_group_stats(
        rows, ["date", "category", "var"], F.avg("metric_contribution").alias("category_mc_avg")
    ).withColumn("mc_diff_to_catg_avg", F.col("metric_contribution") - F.col("category_mc_avg"))


def is_pillar(rows: DataFrame) -> DataFrame:
    return rows.withColumn("is_pillar", F.col("equity_pillar").endswith(PILLAR_SUFFIX))


def add_scaled(rows: DataFrame, scores: DataFrame) -> DataFrame:
    """Scaled score of each metric, from the long score table."""
    picked = scores.where(F.col("variable").endswith("_scores")).select(
        *PANEL_KEY,
        F.regexp_replace("variable", "_scores$", "").alias("var"),
        F.col("column_value").alias("scaled_values"),
    )
    return rows.join(picked, [*PANEL_KEY, "var"], "left")


def metric_type(rows: DataFrame) -> DataFrame:
    """Kind of a metric by the first pattern its name holds."""
    kind = F.lit("")
    for pattern, name in reversed(METRIC_TYPES):
        kind = F.when(F.col("var").contains(pattern), F.lit(name)).otherwise(kind)
    return rows.withColumn("metric_type", kind)


def metric_map(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Name, source and vendor group of every metric in the data."""
    known = one_per_key(dictionary.select("var", "metric_name", "data_source", "vendor_group"), ["var"])
    return rows.select("var").distinct().join(known, "var", "left")


def hub_table(index: DataFrame, weights: DataFrame, scores: DataFrame) -> DataFrame:
    """Detailed rows: contribution, category mean, flags and scaled values."""
    rows = category_contribution(metric_contribution(index, weights))
    dated = rows.withColumns({"year": F.year("date"), "month": F.month("date")})
    return add_scaled(is_pillar(dated), scores)
