"""Capping, sparse-metric removal, imputation, scaling and the dependent variable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equitrace.functions.exprs import clip, ratio
from equitrace.functions.grouping import PANEL_KEY, one_per_key
from equitrace.spec import RefreshSpec

ALL_BRANDS = "Stacked Brand"
LEVEL = ("scope", "level_brand", "category")


def keep_listed_brands(panel: DataFrame, brand_list: DataFrame) -> DataFrame:
    return panel.join(brand_list, ["brand", "category"], "left_semi")


def selected_metrics(dictionary: DataFrame) -> DataFrame:
    """Selected dictionary rows, one per category and lower-case metric name."""
    rows = dictionary.where(F.col("select_flag") == "Y").withColumn("var", F.lower("var"))
    return one_per_key(rows.select("category", "var", "min", "max"), ["category", "var"])


def select_metrics(panel: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Metrics selected for the category, with their bounds."""
    return panel.join(selected_metrics(dictionary), ["category", "var"], "inner")


def cap(panel: DataFrame) -> DataFrame:
    return panel.withColumn("value", clip("value", "min", "max"))


def levels(panel: DataFrame) -> DataFrame:
    """Every row once for its own brand and once for the pool of its category."""
    return panel.withColumn("scope", F.explode(F.array(F.lit("category"), F.lit("brand")))).withColumn(
        "level_brand",
        F.when(F.col("scope") == "brand", F.col("brand")).otherwise(F.lit(ALL_BRANDS)),
    )


def null_limit(spec: RefreshSpec) -> Column:
    """Share of missing values, in percent, that a metric may have in a category."""
    return F.when(
        F.col("category").isin(*spec.high_null_categories), F.lit(spec.high_null_pct)
    ).otherwise(F.lit(spec.null_pct))


def level_stats(rows: DataFrame) -> DataFrame:
    """Counts, mean, range and spread per level and metric, in one aggregate."""
    return rows.groupBy(*LEVEL, "var").agg(
        F.count("*").alias("n"),
        F.count("value").alias("non_null"),
        F.avg("value").alias("mean"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.stddev_pop("value").alias("std"),
    )


def dense_enough(stats: DataFrame, spec: RefreshSpec) -> DataFrame:
    """Metrics with enough values in their level; one value at least."""
    need = F.greatest(F.lit(1), F.floor(F.col("n") * (F.lit(100) - null_limit(spec)) / F.lit(100)))
    return stats.where(F.col("non_null") >= need)


def drop_sparse(rows: DataFrame, spec: RefreshSpec) -> DataFrame:
    """Rows of the metrics that are dense enough, with their level's statistics."""
    kept = dense_enough(level_stats(rows), spec)
    return rows.join(kept, [*LEVEL, "var"], "inner")


def impute(rows: DataFrame) -> DataFrame:
    """Missing values become the mean of the level."""
    return rows.withColumn("value", F.coalesce("value", "mean"))


def scale_bounds(rows: DataFrame) -> DataFrame:
    return rows.withColumn(
        "value", ratio(F.col("value") - F.col("min"), F.col("max") - F.col("min"))
    )


def scale_minmax(rows: DataFrame) -> DataFrame:
    """Observed range to [0, 1]; a constant metric gives 0. Means lie inside the range."""
    scaled = ratio(F.col("value") - F.col("low"), F.col("high") - F.col("low"))
    return rows.withColumn(
        "value", F.when(F.col("value").isNotNull(), F.coalesce(scaled, F.lit(0.0)))
    )


def scale_zscore(rows: DataFrame) -> DataFrame:
    """Population z-score of the imputed metric; a constant metric gives 0.

    Filling with the mean keeps the mean and shrinks the spread by sqrt(non_null / n).
    """
    std = F.col("std") * F.sqrt(F.col("non_null") / F.col("n"))
    scaled = ratio(F.col("value") - F.col("mean"), std)
    return rows.withColumn(
        "value", F.when(F.col("value").isNotNull(), F.coalesce(scaled, F.lit(0.0)))
    )


SCALERS = {"bounds": scale_bounds, "minmax": scale_minmax, "zscore": scale_zscore}


def scaled_panel(
    panel: DataFrame, dictionary: DataFrame, brand_list: DataFrame, spec: RefreshSpec
) -> DataFrame:
    """Both levels of every category in one job: cap, drop, fill, scale."""
    rows = select_metrics(keep_listed_brands(panel, brand_list), dictionary)
    if spec.cap:
        rows = cap(rows)
    rows = impute(drop_sparse(levels(rows), spec))
    rows = SCALERS[spec.scaling](rows)
    return rows.select("scope", *PANEL_KEY, F.col("level_brand").alias("new_brand"), "var", "value")


def dependent_variable(sales: DataFrame, spec: RefreshSpec) -> DataFrame:
    """The chosen sales measure under one name, `dv`."""
    return sales.select(*PANEL_KEY, F.col(spec.dv).alias("dv"))


def attach_dv(rows: DataFrame, dv: DataFrame) -> DataFrame:
    return rows.join(dv, list(PANEL_KEY), "left")
