"""Harmonised metrics: names, pivot, derived metrics, category moves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from equitrace.functions.exprs import num, ratio
from equitrace.functions.grouping import PANEL_KEY, one_per_key, with_group_stats

REVIEW_COUNT = "ratings_reviews_review_count"
SEARCH_VOLUME = "search_searchvolume"
COUNTED = r"^ratings_.*_count$|^ratings_reviews_[1-5]_star_ratings$"


def metric_names(long: DataFrame) -> DataFrame:
    """One name per metric from its four parts; missing parts are skipped."""
    parts = F.concat_ws("_", "data_source", "metric_type", "metric_name", "user_segment")
    return long.withColumn("var", F.translate(F.lower(parts), " ", "_"))


def average_by_metric(long: DataFrame) -> DataFrame:
    """Mean value per panel key and metric: the long form of the pivot."""
    return long.groupBy(*PANEL_KEY, "var").agg(F.avg("metric_value").alias("value"))


def pivot_metrics(panel: DataFrame, names: Sequence[str]) -> DataFrame:
    """Long to wide for export; the names are given, so no extra pass looks for them."""
    return panel.groupBy(*PANEL_KEY).pivot("var", list(names)).agg(F.avg("value"))


def unpivot_metrics(
    wide: DataFrame, ids: Sequence[str] = PANEL_KEY, exclude: Sequence[str] = (), value: str = "value"
) -> DataFrame:
    """Wide to long, nulls kept; listed columns are left out."""
    names = [c for c in wide.columns if c not in ids and c not in exclude]
    return wide.select(
        *ids, *[F.col(f"`{n}`").cast("double").alias(n) for n in names]
    ).unpivot(list(ids), names, "var", value)


def add_sales(panel: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales columns beside the metrics; panel rows without sales stay."""
    return panel.join(sales, list(PANEL_KEY), "left")


def rename_metrics(panel: DataFrame, mapping: DataFrame) -> DataFrame:
    """New names where the mapping has one; rows of the mapping without a target are ignored."""
    names = one_per_key(mapping.where(F.col("new_name").isNotNull()), ["old_name"])
    return (
        panel.join(names, panel["var"] == names["old_name"], "left")
        .withColumn("var", F.coalesce("new_name", "var"))
        .drop("old_name", "new_name")
    )


def percentage_metrics(panel: DataFrame) -> DataFrame:
    """Counts and star ratings as a share of the review count, added as `<name>_percentage`.

    The review count is itself one of the counted metrics, so the counted rows of a panel key, a
    handful, hold their denominator.
    """
    cell = Window.partitionBy(*PANEL_KEY)
    reviews = F.max(F.when(F.col("var") == REVIEW_COUNT, F.col("value"))).over(cell)
    derived = (
        panel.where(F.col("var").rlike(COUNTED))
        .withColumn("value", ratio("value", reviews))
        .select(*PANEL_KEY, F.concat("var", F.lit("_percentage")).alias("var"), "value")
    )
    return panel.unionByName(derived)


def inverse_metrics(panel: DataFrame, rules: DataFrame) -> DataFrame:
    """Metrics by rule: `sub` gives constant - metric, `add` a row sum that skips nulls."""
    is_sub = F.col("operation") == "sub"
    sources = rules.select(
        F.explode(F.split(F.when(is_sub, F.col("raw_cols")).otherwise(F.col("values")), r"\+")).alias("var"),
        "new_name",
        F.when(is_sub, num("values")).alias("constant"),
        is_sub.alias("is_sub"),
    )
    derived = (
        panel.join(sources, "var")
        .groupBy(*PANEL_KEY, "new_name", "is_sub")
        .agg(
            F.max(F.col("constant") - F.col("value")).alias("less"),
            F.coalesce(F.sum("value"), F.lit(0.0)).alias("sum"),
        )
        .select(
            *PANEL_KEY,
            F.col("new_name").alias("var"),
            F.when(F.col("is_sub"), F.col("less")).otherwise(F.col("sum")).alias("value"),
        )
    )
    return panel.unionByName(derived)


def share_metrics(
    panel: DataFrame, names: Sequence[str] = (SEARCH_VOLUME, REVIEW_COUNT)
) -> DataFrame:
    """Search volume and review count as shares of their category on that date."""
    picked = panel.where(F.col("var").isin(*names))
    shares = with_group_stats(
        picked, ("date", "category", "var"), F.sum("value").alias("group_sum")
    ).select(
        *PANEL_KEY,
        F.concat("var", F.lit("_share")).alias("var"),
        ratio("value", "group_sum").alias("value"),
    )
    return panel.unionByName(shares)


def move_categories(panel: DataFrame, moves: DataFrame) -> DataFrame:
    """Listed brands go from one category to another."""
    moves = one_per_key(
        moves.select("brand", F.col("from_category").alias("category"), "to_category"),
        ["brand", "category"],
    )
    return (
        panel.join(moves, ["brand", "category"], "left")
        .withColumn("category", F.coalesce("to_category", "category"))
        .select(*panel.columns)
    )


def derive_metrics(panel: DataFrame, rules: DataFrame, moves: DataFrame) -> DataFrame:
    """Percentages, inverses, shares and category moves, in that order."""
    return move_categories(share_metrics(inverse_metrics(percentage_metrics(panel), rules)), moves)
