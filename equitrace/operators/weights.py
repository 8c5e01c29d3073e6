"""Metric weights from driver attributions and factor loadings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitrace.functions.exprs import mean_of_present, ratio, with_suffix
from equitrace.functions.grouping import with_group_stats
from equitrace.spec import PILLAR_SUFFIX, RefreshSpec


def look_back(dv: DataFrame, end: dt.date, months: int = 12) -> DataFrame:
    """Rows with a value in the last months up to the end date, both ends included."""
    last = F.lit(end).cast("date")
    return dv.where(F.col("dv").isNotNull() & F.col("date").between(F.add_months(last, -months), last))


def category_sums(dv: DataFrame) -> DataFrame:
    """Mean of a brand in its category, and the sum of those means per category."""
    means = dv.groupBy("category", "brand").agg(F.avg("dv").alias("brand_mean"))
    return with_group_stats(means, ["category"], F.sum("brand_mean").alias("category_sum"))


def weighted_attribution(attributions: DataFrame, sums: DataFrame) -> DataFrame:
    """Attribution weighted by the brand's share in its category."""
    return attributions.join(sums, ["brand", "category"], "left").withColumn(
        "weighted", ratio(F.col("attribution") * F.col("brand_mean"), F.col("category_sum"))
    )


def mean_attribution(rows: DataFrame, value: str = "weighted") -> DataFrame:
    """Mean over the brands of a category."""
    return rows.groupBy("category", "pillar", "var").agg(F.avg(value).alias("attribution"))


def mean_of_means(by_category: DataFrame) -> DataFrame:
    """Mean over categories of the category means: every category counts the same."""
    return by_category.groupBy("pillar", "var").agg(F.avg("attribution").alias("attribution"))


def pillar_suffix(rows: DataFrame) -> DataFrame:
    return rows.withColumn("pillar", with_suffix("pillar"))


def loading_subset(fits: DataFrame, spec: RefreshSpec) -> DataFrame:
    """Loadings of one seed, without the pillars that take no weight from them."""
    excluded = [p + PILLAR_SUFFIX for p in spec.loading_excluded_pillars]
    return fits.where(
        (F.col("op") == "=~")
        & (F.col("seed") == spec.loading_seed)
        & ~F.col("pillar").isin(*excluded)
        & F.col("est_std").isNotNull()
    ).select("category", "pillar", "var", "est_std")


def lower_var(rows: DataFrame) -> DataFrame:
    return rows.withColumn("var", F.lower("var"))


def merge_sources(
    attributions: DataFrame, loadings: DataFrame, pillars: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Metrics known to either source, for the listed pillars."""
    return attributions.join(loadings, list(keys), "full").where(
        F.col("pillar").isin(*[p + PILLAR_SUFFIX for p in pillars])
    )


def metric_weights(merged: DataFrame, group: Sequence[str]) -> DataFrame:
    """Mean of a metric's share in each source that knows it; shares are not rescaled."""
    sized = merged.withColumns(
        {"abs_attribution": F.abs("attribution"), "abs_loading": F.abs("est_std")}
    )
    summed = with_group_stats(
        sized,
        group,
        F.sum("abs_attribution").alias("sum_attribution"),
        F.sum("abs_loading").alias("sum_loading"),
    )
    return summed.withColumns(
        {
            "share_attribution": ratio("abs_attribution", "sum_attribution"),
            "share_loading": ratio("abs_loading", "sum_loading"),
        }
    ).withColumn("weight", mean_of_present("share_loading", "share_attribution"))


def equal_weights(weights: DataFrame, pillars: Sequence[str], group: Sequence[str]) -> DataFrame:
    """1 / n for the metrics of the listed pillars."""
    counted = with_group_stats(weights, group, F.count("*").alias("n_metrics"))
    chosen = F.col("pillar").isin(*[p + PILLAR_SUFFIX for p in pillars])
    return counted.withColumn(
        "weight", F.when(chosen, F.lit(1.0) / F.col("n_metrics")).otherwise(F.col("weight"))
    ).drop("n_metrics")


def replicate(weights: DataFrame, categories: Sequence[str]) -> DataFrame:
    """One copy of the pooled weights per configured category."""
    return weights.withColumn("category", F.explode(F.array(*[F.lit(c) for c in categories])))


def weights_sheet(by_category: DataFrame, pooled: DataFrame) -> DataFrame:
    """The published sheet: category, pillar, metric, weight."""
    cols = ["category", "pillar", F.col("var").alias("metric"), "weight"]
    return by_category.select(*cols).unionByName(pooled.select(*cols))


def create_weights(
    attributions: DataFrame,
    pooled_fits: DataFrame,
    category_fits: DataFrame,
    dv: DataFrame,
    spec: RefreshSpec,
) -> DataFrame:
    """Weights of every metric in every category from both sources."""
    rows = lower_var(pillar_suffix(attributions)).where(F.col("category").isin(*spec.categories))
    if spec.weight_by_dv:
        sums = category_sums(look_back(dv, spec.end_date, spec.dv_lookback_months))
        by_cat = mean_attribution(weighted_attribution(rows, sums))
    else:
        by_cat = mean_attribution(rows, "attribution")
    cat_loadings = lower_var(loading_subset(category_fits, spec))
    all_loadings = lower_var(loading_subset(pooled_fits, spec)).drop("category")
    by_category = metric_weights(
        merge_sources(by_cat, cat_loadings, spec.category_pillars, ["category", "pillar", "var"]),
        ["category", "pillar"],
    )
    pooled = metric_weights(
        merge_sources(mean_of_means(by_cat), all_loadings, spec.pooled_pillars, ["pillar", "var"]),
        ["pillar"],
    )
    pooled = equal_weights(pooled, spec.equal_weight_pillars, ["pillar"])
    return weights_sheet(by_category, replicate(pooled, spec.categories))
