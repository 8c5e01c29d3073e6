"""Sales facts to market share and price per vendor, brand, category and period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitrace.functions.exprs import half_even, ratio, total
from equitrace.functions.grouping import with_group_stats
from equitrace.spec import SALES_MEASURES, RefreshSpec

WEEK_KEY = ("vendor", "brand", "category", "date")


def star_sales(
    fact: DataFrame,
    periods: DataFrame,
    markets: DataFrame,
    products: DataFrame,
    market: str | None = None,
) -> DataFrame:
    """Weekly sums per vendor, brand and category, over one market or over all.

    Distribution is carried as a weighted sum and its weight; the ratio is taken later. Keys of
    the dimensions are unique, so without a market filter the fact need not meet the markets.
    """
    weeks = periods.where(F.col("period_weeks") == 1).select("period_key", "week_ending")
    rows = fact.join(weeks, "period_key")
    if market is not None:
        chosen = markets.where(F.col("market_description") == market)
        rows = rows.join(chosen, "market_key", "left_semi")
    rows = rows.join(products, "product_key", "left")
    return rows.groupBy("vendor", "brand", "category", F.col("week_ending").alias("date")).agg(
        total("dollars").alias("s_dollars"),
        total("base_dollars").alias("s_base_dollars"),
        total("pounds").alias("s_pounds"),
        total("base_pounds").alias("s_base_pounds"),
        total(F.col("pct_acv") * F.col("dollars")).alias("acv_num"),
        total("dollars").alias("acv_den"),
        total("units").alias("s_units"),
        total("base_units").alias("s_base_units"),
    )


def acv_ratio(weekly: DataFrame) -> DataFrame:
    """Weighted-average distribution: sum(w * x) / sum(w)."""
    return weekly.withColumn("acv_selling_wt", ratio("acv_num", "acv_den"))


def vendor_rollup(weekly: DataFrame, vendor: str) -> DataFrame:
    """Add one pseudo-brand that carries a vendor's sum over its brands.

    Rows are chosen by vendor and removed by brand, so the vendor's own brands stay beside the
    roll-up. The distribution ratio is not derived again for it.
    """
    sums = [c for c in weekly.columns if c.startswith(("s_", "acv_")) and c != "acv_selling_wt"]
    rolled = (
        weekly.where(F.col("vendor") == vendor)
        .groupBy("vendor", "category", "date")
        .agg(*[total(c).alias(c) for c in sums])
        .withColumn("brand", F.lit(vendor))
    )
    others = weekly.where(F.col("brand") != vendor)
    return others.unionByName(rolled, allowMissingColumns=True)


def calendar_parts(df: DataFrame, col: str = "date") -> DataFrame:
    return df.withColumns({"month": F.month(col), "year": F.year(col)})


def to_grain(df: DataFrame, grain: str) -> DataFrame:
    """Dates of a grain: the week itself, or the first of its month."""
    if grain == "monthly":
        return df.withColumn("date", F.trunc("date", "month"))
    if grain == "weekly":
        return df
    raise ValueError(f"unknown grain {grain!r}")


def panel_aggregate(weekly: DataFrame, grain: str) -> DataFrame:
    """Sum and mean of the six measures and the plain mean of the distribution ratio."""
    return (
        to_grain(weekly, grain)
        .dropna(subset=[c for c in WEEK_KEY if c != "date"])
        .groupBy(*WEEK_KEY)
        .agg(
            total("s_dollars").alias("total_sales"),
            total("s_base_dollars").alias("s_base_dollars"),
            total("s_pounds").alias("eq_volume"),
            total("s_base_pounds").alias("s_base_pounds"),
            F.avg("acv_selling_wt").alias("acv_selling"),
            total("s_units").alias("total_units"),
            total("s_base_units").alias("s_base_units"),
            F.avg("s_dollars").alias("a_dollars"),
            F.avg("s_base_dollars").alias("a_base_dollars"),
            F.avg("s_pounds").alias("a_pounds"),
            F.avg("s_base_pounds").alias("a_base_pounds"),
            F.avg("s_units").alias("a_units"),
            F.avg("s_base_units").alias("a_base_units"),
        )
    )


def monthly_normalise(panel: DataFrame) -> DataFrame:
    """Mean week times the weeks in the month, so that months of 4 and 5 weeks compare."""
    weeks = F.dayofmonth(F.last_day("date")) / F.lit(7.0)
    means = ("a_dollars", "a_base_dollars", "a_pounds", "a_base_pounds", "a_units", "a_base_units")
    return panel.withColumns({m: F.col(a) * weeks for m, a in zip(SALES_MEASURES, means, strict=True)})


def drop_means(panel: DataFrame) -> DataFrame:
    return panel.drop(*[c for c in panel.columns if c.startswith("a_")])


def round_measures(panel: DataFrame) -> DataFrame:
    """Whole units of money, volume and count; distribution to two places. Base measures stay."""
    return panel.withColumns(
        {
            "total_sales": half_even("total_sales", 0),
            "eq_volume": half_even("eq_volume", 0),
            "total_units": half_even("total_units", 0),
            "acv_selling": half_even("acv_selling", 2),
        }
    )


def average_price(panel: DataFrame) -> DataFrame:
    return panel.withColumn("average_price", ratio("total_sales", "total_units"))


def category_total(panel: DataFrame) -> DataFrame:
    return with_group_stats(
        panel, ("date", "category"), F.sum("total_sales").alias("category_total_sales")
    )


def market_share(panel: DataFrame) -> DataFrame:
    """Share of a row in its category total; needs `category_total` first."""
    return panel.withColumn(
        "market_share_total_sales", ratio("total_sales", "category_total_sales")
    )


def sort_panel(panel: DataFrame) -> DataFrame:
    return panel.orderBy(*WEEK_KEY)


def sales_base(
    fact: DataFrame, periods: DataFrame, markets: DataFrame, products: DataFrame, spec: RefreshSpec
) -> DataFrame:
    """Facts to the rounded panel with price: the part that reads the fact table."""
    weekly = acv_ratio(star_sales(fact, periods, markets, products, spec.market))
    if spec.rollup_vendor:
        weekly = vendor_rollup(weekly, spec.rollup_vendor)
    panel = panel_aggregate(weekly, spec.grain)
    if spec.grain == "monthly":
        panel = monthly_normalise(panel)
    return average_price(round_measures(drop_means(panel)))


def sales_shares(base: DataFrame) -> DataFrame:
    """Category totals and shares on a finished base panel."""
    return market_share(category_total(base))
