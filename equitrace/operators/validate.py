"""Refresh-to-refresh comparison, scope tags, deviations and data sufficiency."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equitrace.functions.exprs import half_even, lookup, num, percent_text, ratio
from equitrace.functions.grouping import PANEL_KEY, one_per_key
from equitrace.spec import CATEGORY_SUFFIXES, SALES_METRICS, SALES_SOURCE, SOURCE_NAMES


def coerce_values(long: DataFrame, col: str = "value") -> DataFrame:
    return long.withColumn(col, num(col))


def common_frame(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both refreshes cut to the dates they share."""
    bounds = F.struct(F.min("date").alias("first"), F.max("date").alias("last")).alias("bounds")
    spans = [df.agg(bounds).scalar() for df in (old, new)]
    start = F.greatest(*[s["first"] for s in spans])
    end = F.least(*[s["last"] for s in spans])
    inside = (F.col("date") >= start) & (F.col("date") <= end)
    return old.where(inside), new.where(inside)


def match_refreshes(
    old: DataFrame, new: DataFrame, keys: Sequence[str] = (*PANEL_KEY, "var"), value: str = "value"
) -> DataFrame:
    """Rows present in both refreshes, old and new value side by side."""
    before = old.select(*keys, F.col(value).alias("value_old"))
    after = new.select(*keys, F.col(value).alias("value_new"))
    return before.join(after, list(keys), "inner")


def percent_difference(matched: DataFrame) -> DataFrame:
    """Change in percent of the old value; a move away from zero has no percentage but a flag."""
    old, new = F.col("value_old"), F.col("value_new")
    return matched.withColumns(
        {
            "difference_pct": ratio(new - old, old) * F.lit(100.0),
            "from_zero": F.coalesce((old == 0) & (new != 0), F.lit(False)),
        }
    )


def mean_difference(compared: DataFrame) -> DataFrame:
    """Mean change per key, date and value pair; pairs with a missing value drop out."""
    return (
        compared.where(F.col("value_new").isNotNull() & F.col("value_old").isNotNull())
        .groupBy("brand", "category", "var", "date", "value_new", "value_old", "from_zero")
        .agg(F.avg("difference_pct").alias("avg_difference_pct"))
    )


def mean_difference_by_metric(compared: DataFrame) -> DataFrame:
    """Mean change per brand, category and measure, over all dates."""
    return compared.groupBy("brand", "category", "var").agg(
        F.avg("difference_pct").alias("avg_difference_pct"),
        F.max("from_zero").alias("from_zero"),
    )


def tag_scope(df: DataFrame, dictionary: DataFrame, brand_list: DataFrame) -> DataFrame:
    """Y/N flags: is the metric selected for the category, is the brand in scope for it."""
    metrics = one_per_key(
        dictionary.where(F.col("select_flag") == "Y").select("category", "var"), ["category", "var"]
    ).withColumn("idv_list", F.lit("Y"))
    brands = one_per_key(brand_list.select("brand", "category"), ["brand", "category"]).withColumn(
        "brand_list", F.lit("Y")
    )
    return (
        df.join(metrics, ["category", "var"], "left")
        .join(brands, ["brand", "category"], "left")
        .withColumns(
            {
                "idv_list": F.coalesce("idv_list", F.lit("N")),
                "brand_list": F.coalesce("brand_list", F.lit("N")),
            }
        )
    )


def data_source(
    df: DataFrame,
    names: Mapping[str, str] = SOURCE_NAMES,
    sales_metrics: Sequence[str] = SALES_METRICS,
) -> DataFrame:
    """Source of a metric: the first part of its name, with fixed replacements."""
    source = lookup(F.split_part("var", F.lit("_"), F.lit(1)), names)
    return df.withColumn(
        "data_source", F.when(F.col("var").isin(*sales_metrics), F.lit(SALES_SOURCE)).otherwise(source)
    )


def brand_label(df: DataFrame) -> DataFrame:
    """Brand and the first word of its category."""
    return df.withColumn(
        "label", F.concat_ws(" ", "brand", F.split_part("category", F.lit(" "), F.lit(1)))
    )


def sales_label(df: DataFrame, suffixes: Sequence[str] = CATEGORY_SUFFIXES) -> DataFrame:
    """Brand and category without the listed category endings."""
    text = F.concat_ws(" ", "brand", "category")
    for s in suffixes:
        text = F.regexp_replace(text, s, "")
    return df.withColumn("label", text)


def deviates(limit: float = 5.0, pct: str = "avg_difference_pct") -> Column:
    """Beyond the limit in either direction, or away from zero."""
    return F.coalesce(F.abs(F.col(pct)) > limit, F.lit(False)) | F.col("from_zero")


def in_scope(df: DataFrame) -> DataFrame:
    return df.where((F.col("idv_list") == "Y") & (F.col("brand_list") == "Y"))


def deviations(tagged: DataFrame, limit: float = 5.0) -> DataFrame:
    return in_scope(tagged).where(deviates(limit))


def deviation_text(pct: str = "avg_difference_pct", new: str = "value_new") -> Column:
    """One decimal and a percent sign; a move away from zero reads inf or -inf."""
    endless = F.when(F.col(new) > 0, F.lit("inf%")).otherwise(F.lit("-inf%"))
    return F.when(F.col("from_zero"), endless).otherwise(percent_text(pct))


def deviation_report(flagged: DataFrame) -> DataFrame:
    """Report columns of the metric comparison."""
    return brand_label(flagged).select(
        F.col("label").alias("Brand"),
        F.col("date").alias("Date"),
        F.col("var").alias("Variable"),
        F.col("value_old").alias("Previous Refresh"),
        F.col("value_new").alias("Current Refresh"),
        deviation_text().alias("%Deviation"),
    )


def deviation_summary(rows: DataFrame, flag: Column) -> DataFrame:
    """How many labels deviate, and their share, from `label` rows and a deviation test."""
    per_label = rows.groupBy("label").agg(F.max(flag).alias("deviating"))
    counts = per_label.agg(
        F.count("*").alias("total_brands"),
        F.count_if("deviating").alias("brands_with_deviation"),
    ).withColumn(
        "brands_without_deviation", F.col("total_brands") - F.col("brands_with_deviation")
    )
    return counts.select(
        "total_brands",
        "brands_without_deviation",
        "brands_with_deviation",
        half_even(ratio("brands_without_deviation", "total_brands") * 100, 2).alias("success_pct"),
        half_even(ratio("brands_with_deviation", "total_brands") * 100, 2).alias("fail_pct"),
    )


def deviating_brands(flagged: DataFrame, brand_list: DataFrame) -> DataFrame:
    """The deviating labels as one text, in order.

    The list is taken from the brand list, so its length is that of the refresh's own scope
    table and does not grow with the panel.
    """
    hits = flagged.select("brand", "category").distinct()
    labels = brand_label(brand_list.join(hits, ["brand", "category"], "left_semi"))
    return labels.agg(
        F.array_join(F.array_sort(F.collect_set("label")), ", ").alias("brands_with_deviation")
    )


def added_brands(old: DataFrame, new: DataFrame) -> DataFrame:
    """Brands of the new refresh that the old one did not have."""
    return (
        new.select("brand").distinct().join(old.select("brand").distinct(), "brand", "left_anti")
    )


def pillar_rows(scorecard: DataFrame) -> DataFrame:
    return scorecard.where(F.col("metric_type") == "Pillar")


def date_range(df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return df.where(F.col("date").between(F.lit(start), F.lit(end)))


def sufficiency(tagged: DataFrame) -> DataFrame:
    """Per brand, category and metric: how many values there are, and from when to when."""
    has = F.col("value").isNotNull()
    return tagged.groupBy(
        "brand", "category", "var", "data_source", "brand_list", "idv_list"
    ).agg(
        F.count("value").alias("non_null_count"),
        F.count("value").alias("total_count"),
        (F.avg(has.cast("double")) * 100).alias("availability_pct"),
        F.min(F.when(has, F.col("date"))).alias("start_date"),
        F.max(F.when(has, F.col("date"))).alias("end_date"),
    )


def score_comparison(old: DataFrame, new: DataFrame) -> DataFrame:
    """Pillar scores of two scorecards over their common dates, with the percent change."""
    old, new = common_frame(pillar_rows(old), pillar_rows(new))
    keys = ("date", "brand", "category", "equity_pillar")
    return percent_difference(match_refreshes(old, new, keys, "scaled_scores"))


def score_report(compared: DataFrame, limit: float = 5.0) -> DataFrame:
    flagged = brand_label(compared).where(deviates(limit, "difference_pct"))
    return flagged.select(
        F.col("label").alias("Brand"),
        F.col("date").alias("Date"),
        F.col("equity_pillar").alias("Pillar"),
        F.col("value_old").alias("Previous Refresh"),
        F.col("value_new").alias("Current Refresh"),
        deviation_text("difference_pct").alias("%Deviation"),
    )
