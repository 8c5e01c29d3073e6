"""The published scorecard: summary and pillar importance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitrace.functions.exprs import half_even, lookup, num, title_case
from equitrace.functions.grouping import PANEL_KEY, one_per_key
from equitrace.operators.harmonise import unpivot_metrics
from equitrace.spec import PILLAR_LABELS, ROUNDING, SCORECARD_COLUMNS

WORKING_COLUMNS = ("value", "metric_contribution", "category_mc_avg", "mc_diff_to_catg_avg")
MISSING_CLASS = "#NA"  # fixed value: price class of a mapped brand without one


def scorecard_detail(hub: DataFrame) -> DataFrame:
    """Drop working columns and spell out the row type."""
    return (
        hub.drop(*WORKING_COLUMNS)
        .withColumn("metric_type", F.when(F.col("is_pillar"), "Pillar").otherwise("Metric"))
        .drop("is_pillar")
    )


def raw_values(wide: DataFrame) -> DataFrame:
    """Raw metric values in long form."""
    return unpivot_metrics(wide, value="metric_raw_value")


def price_classes(mapping: DataFrame) -> DataFrame:
    filled = mapping.select(
        "brand", "category", F.coalesce("price_class", F.lit(MISSING_CLASS)).alias("price_class")
    )
    return one_per_key(filled, ["brand", "category"])


def enrich_detail(
    detail: DataFrame, raw: DataFrame, prices: DataFrame, names: DataFrame
) -> DataFrame:
    """Raw value, price class and dashboard name of every detail row."""
    renamed = one_per_key(
        names.select(F.col("scorecard_attribute").alias("var"), "scorecard_attribute_updated"), ["var"]
    )
    return (
        detail.join(raw, [*PANEL_KEY, "var"], "left")
        .join(price_classes(prices), ["brand", "category"], "left")
        .join(renamed, "var", "left")
        .withColumn("var", F.coalesce("scorecard_attribute_updated", "var"))
        .drop("scorecard_attribute_updated")
    )


def pretty_pillar(col: str, suffix: str = "_pillar"):
    """Pillar name without suffix, with blanks, in title case."""
    return title_case(F.replace(F.replace(F.col(col), F.lit(suffix), F.lit("")), F.lit("_"), F.lit(" ")))


def pretty_names(detail: DataFrame) -> DataFrame:
    return detail.withColumn("equity_pillar", pretty_pillar("equity_pillar"))


def pillar_labels(detail: DataFrame) -> DataFrame:
    """Pillar rows get their label in place of the pillar id."""
    return detail.withColumn("var", lookup("var", PILLAR_LABELS))


def project_summary(detail: DataFrame) -> DataFrame:
    return detail.withColumnsRenamed({"var": "metric_name", "scaled_values": "scaled_scores"}).select(
        *SCORECARD_COLUMNS
    )


def drop_unweighted(summary: DataFrame) -> DataFrame:
    """Metric rows without a weight are not published; pillar rows never have one."""
    return summary.where(~(F.col("weight").isNull() & (F.col("metric_type") == "Metric")))


def round_summary(summary: DataFrame) -> DataFrame:
    return summary.withColumns({c: half_even(num(c), n) for c, n in ROUNDING.items()})


def sort_summary(summary: DataFrame) -> DataFrame:
    return summary.orderBy("brand", "category", "equity_pillar", "metric_type", "metric_name", "date")


def importance_sheet(importance: DataFrame, prices: DataFrame) -> DataFrame:
    """Relative importance per brand, category and pillar, with the price class."""
    return importance.join(price_classes(prices), ["brand", "category"], "left").select(
        "brand",
        "category",
        "price_class",
        pretty_pillar("var", "_pillar_trend_past").alias("equity_pillar"),
        half_even(num("relative_importance"), 4).alias("relative_importance"),
    )


def scorecard_summary(
    detail: DataFrame, raw: DataFrame, prices: DataFrame, names: DataFrame
) -> DataFrame:
    """The summary table as published."""
    rows = pillar_labels(pretty_names(enrich_detail(detail, raw, prices, names)))
    return round_summary(drop_unweighted(project_summary(rows)))
