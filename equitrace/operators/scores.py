"""Pillar scores, trends, lags and scaled scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitrace.functions.exprs import clean_name
from equitrace.functions.grouping import PANEL_KEY, SERIES, by_date, one_per_key, with_group_stats
from equitrace.spec import PILLAR_SUFFIX, RefreshSpec


def pooled_rows(scaled: DataFrame) -> DataFrame:
    """Rows scaled inside their category's pool: the ones that scores compare."""
    return scaled.where(F.col("scope") == "category").select(*PANEL_KEY, "var", "value")


def pillar_scores(pooled: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted sum of the metrics per panel key and pillar, one row each.

    A missing value counts 0; a pillar whose metrics are absent scores 0, not null.
    """
    sheet = weights.select("category", "pillar", F.lower("metric").alias("var"), "weight")
    pillars = sheet.select("category", "pillar").distinct()
    per_metric = (
        pooled.join(sheet, ["category", "var"])
        .groupBy(*PANEL_KEY, "pillar")
        .agg(F.sum(F.col("weight") * F.coalesce("value", F.lit(0.0))).alias("score"))
    )
    frame = pooled.select(*PANEL_KEY).distinct().join(pillars, "category")
    return frame.join(per_metric, [*PANEL_KEY, "pillar"], "left").withColumn(
        "score", F.coalesce("score", F.lit(0.0))
    )


def long_index(pooled: DataFrame, scores: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Metrics and pillars stacked, each with its pillar; pillar rows carry their own name."""
    names = one_per_key(
        dictionary.where(F.col("pillar").isNotNull()).select(
            "category", clean_name("var").alias("var"), "pillar"
        ),
        ["category", "var"],
    )
    stacked = pooled.unionByName(
        scores.select(*PANEL_KEY, F.col("pillar").alias("var"), F.col("score").alias("value"))
    )
    return stacked.join(names, ["category", "var"], "left").select(
        *PANEL_KEY, "var", "value", F.coalesce("pillar", "var").alias("equity_pillar")
    )


def trends(scores: DataFrame, window: int) -> DataFrame:
    """Rolling mean up to the row, and the same one step ahead; null until the window is full."""
    series = by_date(*SERIES, "pillar")
    last = series.rowsBetween(1 - window, 0)
    past = F.when(F.count("score").over(last) == window, F.avg("score").over(last))
    return scores.withColumn("trend_past", past).withColumn(
        "trend_past_future", F.lead("trend_past", 1).over(series)
    )


def trend_features(trended: DataFrame) -> DataFrame:
    """Scores and trends as named features in one column: `<pillar>`, `<pillar>_trend_past`, ..."""
    parts = F.array(
        F.struct(F.col("pillar").alias("var"), F.col("score").alias("value")),
        *[
            F.struct(F.concat("pillar", F.lit(f"_{t}")).alias("var"), F.col(t).alias("value"))
            for t in ("trend_past", "trend_past_future")
        ],
    )
    return trended.select(*PANEL_KEY, F.explode(parts).alias("p")).select(*PANEL_KEY, "p.*")


def add_lags(features: DataFrame, lags: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Earlier values of each feature as further features, `<name>_lag_<k>`."""
    series = by_date(*SERIES, "var")
    lagged = features.withColumns({f"_lag_{k}": F.lag("value", k).over(series) for k in lags})
    parts = F.array(
        F.struct("var", "value"),
        *[
            F.struct(F.concat("var", F.lit(f"_lag_{k}")).alias("var"), F.col(f"_lag_{k}").alias("value"))
            for k in lags
        ],
    )
    return lagged.select(*PANEL_KEY, F.explode(parts).alias("p")).select(*PANEL_KEY, "p.*")


def scaled_scores(long: DataFrame, only_pillars: bool = False) -> DataFrame:
    """100 at the category mean of the date, one point per hundredth above or below it."""
    rows = long.where(F.col("var").endswith(PILLAR_SUFFIX)) if only_pillars else long
    centred = with_group_stats(rows, ["date", "category", "var"], F.avg("value").alias("_mean"))
    return centred.withColumn(
        "score", (F.col("value") - F.col("_mean")) * F.lit(100.0) + F.lit(100.0)
    ).drop("_mean")


def scores_long(scaled: DataFrame) -> DataFrame:
    """Value and scaled score of a metric as two named rows, `<var>` and `<var>_scores`."""
    parts = F.array(
        F.struct(F.col("var").alias("variable"), F.col("value").alias("column_value")),
        F.struct(
            F.concat("var", F.lit("_scores")).alias("variable"), F.col("score").alias("column_value")
        ),
    )
    return scaled.select(*PANEL_KEY, F.explode(parts).alias("p")).select(*PANEL_KEY, "p.*")


def date_categories(rows: DataFrame) -> DataFrame:
    return rows.select("date", "category").distinct()


def score_panel(
    scaled: DataFrame, weights: DataFrame, spec: RefreshSpec
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pooled metric rows, pillar scores and their trends."""
    pooled = pooled_rows(scaled)
    scores = pillar_scores(pooled, weights)
    return pooled, scores, trends(scores, spec.trend_window)
