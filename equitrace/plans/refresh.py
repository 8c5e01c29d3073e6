"""A refresh end to end: panel, validation, preparation, learning, scoring, publishing."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitrace.functions.grouping import PANEL_KEY
from equitrace.operators import (
    drivers,
    factor,
    forests,
    harmonise,
    importance,
    prepare,
    sales,
    scorecard,
    scores,
    stats,
    validate,
    weights,
)
from equitrace.schemas import ATTRIBUTIONS
from equitrace.sources.commits import Attempt
from equitrace.sources.workspace import stage
from equitrace.spec import FOREST, RIDGE, RefreshSpec


@dataclass(frozen=True)
class Mappings:
    """The small tables a refresh is steered by."""

    dictionary: DataFrame
    brand_list: DataFrame
    inverse_rules: DataFrame
    category_moves: DataFrame
    category_parents: DataFrame
    price_classes: DataFrame
    dashboard_names: DataFrame


def build_sales(
    fact: DataFrame, periods: DataFrame, markets: DataFrame, products: DataFrame, spec: RefreshSpec
) -> DataFrame:
    """Sales panel with shares; the fact table is read once, the shares work on the result."""
    base = stage(sales.sales_base(fact, periods, markets, products, spec), "sales-base")
    return sales.sales_shares(base)


def build_panel(metrics: DataFrame, maps: Mappings) -> DataFrame:
    """Processed metric panel in long form."""
    return stage(
        harmonise.derive_metrics(metrics, maps.inverse_rules, maps.category_moves), "panel"
    )


def compare_panels(old: DataFrame, new: DataFrame, maps: Mappings) -> DataFrame:
    """Mean percent change of every metric over the common dates, with scope flags."""
    old, new = validate.common_frame(old, new)
    compared = validate.percent_difference(validate.match_refreshes(old, new))
    tagged = validate.tag_scope(validate.mean_difference(compared), maps.dictionary, maps.brand_list)
    return validate.data_source(tagged)


def validate_panels(old: DataFrame, new: DataFrame, maps: Mappings, spec: RefreshSpec) -> dict[str, DataFrame]:
    """Deviation report, summary and list of brands."""
    tagged = stage(compare_panels(old, new, maps), "tagged")
    flagged = validate.deviations(tagged, spec.deviation_pct)
    labelled = validate.brand_label(validate.in_scope(tagged))
    return {
        "report": validate.deviation_report(flagged),
        "summary": validate.deviation_summary(labelled, validate.deviates(spec.deviation_pct)),
        "brands": validate.deviating_brands(flagged, maps.brand_list),
    }


def prepare_data(
    panel: DataFrame, dv: DataFrame, maps: Mappings, spec: RefreshSpec
) -> tuple[DataFrame, DataFrame]:
    """Scaled panel at both levels, and the same with the dependent variable."""
    ranged = validate.date_range(panel, spec.start_date, spec.end_date)
    scaled = stage(prepare.scaled_panel(ranged, maps.dictionary, maps.brand_list, spec), "scaled")
    return scaled, prepare.attach_dv(scaled, dv)


def weight_rows(modelling: DataFrame, maps: Mappings, spec: RefreshSpec) -> DataFrame:
    """Rows of every weights model: brand level, known pillar, enough data."""
    rows = stats.by_pillar(stats.present_in_pool(modelling), maps.dictionary, spec.forced_metrics)
    rows = stats.without_pattern(rows, *spec.dropped_patterns)
    rows = stats.fill_dv(stats.drop_and_fill(rows))
    if spec.check_expected_sign:
        kept = stats.drop_counter_intuitive(
            stats.dv_correlation(rows), maps.dictionary, spec.counter_intuitive_cutoff
        )
        rows = rows.join(kept.select("brand", "category", "var"), ["brand", "category", "var"], "left_semi")
    return stats.eligible(rows, spec, drivers.MODEL_KEY)


def select_features(rows: DataFrame, maps: Mappings, spec: RefreshSpec) -> DataFrame:
    """Metrics that enter the ridge model: all, those correlated with the DV, or a forest's best."""
    choice, key = spec.weights_model.selection, [*drivers.MODEL_KEY, "var"]
    if choice == "all":
        return rows
    if choice == "correlation":
        found = stats.dv_correlation(rows, drivers.MODEL_KEY)
        kept = stats.select_by_correlation(found, spec.correlation_cutoff)
    elif choice == "forest":
        forest_only = replace(spec, weights_model=replace(spec.weights_model, run=(FOREST,)))
        found = learn_drivers(rows, maps, forest_only)
        kept = stats.top_features(found, drivers.MODEL_KEY, spec.top_features, "attribution")
    else:
        raise ValueError(f"unknown selection {choice!r}")
    return rows.join(kept.select(*key), key, "left_semi")


def learn_drivers(rows: DataFrame, maps: Mappings, spec: RefreshSpec) -> DataFrame:
    """Attributions of every configured weights model.

    The models of all keys are one job, whatever their kind.
    """
    model, out = spec.weights_model, [*drivers.MODEL_KEY, "var", "model", "attribution"]
    parts = [rows.sparkSession.createDataFrame([], ATTRIBUTIONS)]
    if RIDGE in model.run:
        chosen = select_features(rows, maps, spec)
        results, _ = drivers.ridge_model(chosen, drivers.MODEL_KEY, model, spec)
        parts.append(results.select(*out))
    kinds = [k for k in model.run if k != RIDGE]
    if kinds:
        samples = stage(drivers.learning_rows(rows, drivers.MODEL_KEY, model, spec), "samples")
        parts += [forests.tree_model(samples, kind, model, drivers.MODEL_KEY)[0].select(*out) for kind in kinds]
    return reduce(DataFrame.unionByName, parts)


def learn_weights(
    scaled: DataFrame, modelling: DataFrame, dv: DataFrame, maps: Mappings, spec: RefreshSpec
) -> DataFrame:
    """Weights sheet of a refresh that learns."""
    pool = stats.by_pillar(scaled.where(F.col("scope") == "category"), maps.dictionary)
    attributions = learn_drivers(weight_rows(modelling, maps, spec), maps, spec)
    sheet = weights.create_weights(
        attributions,
        factor.pooled_factors(pool, spec),
        factor.category_factors(pool, spec),
        dv,
        spec,
    )
    return stage(sheet, "weights")


@dataclass(frozen=True)
class Scores:
    """Tables that scoring hands on."""

    index: DataFrame
    trended: DataFrame
    scaled: DataFrame


def score(scaled: DataFrame, sheet: DataFrame, maps: Mappings, spec: RefreshSpec) -> Scores:
    """Pillar scores, trends and scaled scores from a scaled panel and a weights sheet."""
    pooled, points, trended = scores.score_panel(scaled, sheet, spec)
    index = stage(scores.long_index(pooled, points, maps.dictionary), "index")
    return Scores(index, trended, scores.scaled_scores(index, spec.only_pillar_scores))


def publish_summary(panel: DataFrame, scored: Scores, sheet: DataFrame, maps: Mappings) -> dict[str, DataFrame]:
    """Hub table, scorecard summary and metric map."""
    hub = stage(importance.hub_table(scored.index, sheet, scores.scores_long(scored.scaled)), "hub")
    raw = panel.select(*PANEL_KEY, "var", F.col("value").alias("metric_raw_value"))
    return {
        "hub": hub,
        "metric_map": importance.metric_type(importance.metric_map(scored.index, maps.dictionary)),
        "summary": scorecard.scorecard_summary(
            scorecard.scorecard_detail(hub), raw, maps.price_classes, maps.dashboard_names
        ),
    }


def publish_importance(scored: Scores, sales_panel: DataFrame, maps: Mappings, spec: RefreshSpec) -> DataFrame:
    """Relative importance of every pillar per brand and category, by the model that the settings publish."""
    features = scores.trend_features(scored.trended)
    results = importance.pillar_importance(features, sales_panel, maps.category_parents, spec)
    return scorecard.importance_sheet(
        importance.relative_importance(results, spec.importance_model.published), maps.price_classes
    )


def compare_scorecards(old: DataFrame, new: DataFrame, spec: RefreshSpec) -> dict[str, DataFrame]:
    """Score moves between two refreshes, their summary, and the brands that are new."""
    old, new = stage(old, "old-card"), stage(new, "new-card")
    compared = stage(validate.score_comparison(old, new), "compared")
    labelled = validate.brand_label(compared)
    return {
        "report": validate.score_report(compared, spec.deviation_pct),
        "summary": validate.deviation_summary(
            labelled, validate.deviates(spec.deviation_pct, "difference_pct")
        ),
        "added_brands": validate.added_brands(validate.pillar_rows(old), validate.pillar_rows(new)),
    }


def commit_tables(
    root: str, month: dt.date, tables: dict[tuple[str, str], DataFrame], carry_over: bool = False
) -> Attempt:
    """Write the (stage, table) tables of a refresh as one attempt; readers see all of them or none.

    A run that fails is never seen. `carry_over` keeps the tables of the last attempt that this one lacks.
    """
    attempt = Attempt(next(iter(tables.values())).sparkSession, root, month)
    for (stage_name, table), df in tables.items():
        attempt.write(df, stage_name, table, [c for c in ("category",) if c in df.columns])
    attempt.commit(carry_over)
    return attempt
