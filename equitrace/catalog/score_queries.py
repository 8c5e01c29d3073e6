"""Queries on weights, scores, importance and the published scorecard."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitrace.catalog.inputs import Inputs
from equitrace.catalog.oracle import even, r
from equitrace.catalog.oracle import query as sql
from equitrace.catalog.registry import query
from equitrace.functions.exprs import title_case
from equitrace.functions.grouping import PANEL_KEY
from equitrace.operators import (
    harmonise,
    importance,
    prepare,
    scorecard,
    scores,
    stats,
    validate,
    weights,
)
from equitrace.plans import refresh
from equitrace.spec import RIDGE

PANEL = "brand, category, date, var"
KEY = "brand, category, pillar"

# weights


def sums(i: Inputs) -> DataFrame:
    return weights.category_sums(weights.look_back(i.dv, i.spec.end_date, i.spec.dv_lookback_months))


def weighted(i: Inputs) -> DataFrame:
    return weights.weighted_attribution(
        weights.lower_var(weights.pillar_suffix(i.attributions)), sums(i)
    )


def pooled_merge(i: Inputs) -> DataFrame:
    found = weights.mean_of_means(weights.mean_attribution(weighted(i)))
    loadings = weights.loading_subset(i.pooled_loadings, i.spec).drop("category")
    return weights.merge_sources(found, loadings, i.spec.pooled_pillars, ["pillar", "var"])


def category_merge(i: Inputs) -> DataFrame:
    found = weights.mean_attribution(weighted(i))
    loadings = weights.loading_subset(i.category_loadings, i.spec)
    keys = ["category", "pillar", "var"]
    return weights.merge_sources(found, loadings, i.spec.category_pillars, keys)


def pooled_weights(i: Inputs) -> DataFrame:
    return weights.metric_weights(pooled_merge(i), ["pillar"])


def category_weights(i: Inputs) -> DataFrame:
    return weights.metric_weights(category_merge(i), ["category", "pillar"])


@query("w1_category_sums", sql("dv_sums", f"select brand, category, {r('brand_mean')}, {r('category_sum')} from dv_sums"))
def w1(i: Inputs) -> DataFrame:
    return sums(i)


@query("w2_look_back", sql("dv_year", f"select brand, category, date, {r('dv')} from dv_year"))
def w2(i: Inputs) -> DataFrame:
    return weights.look_back(i.dv, i.spec.end_date, i.spec.dv_lookback_months)


@query("w3_weighted_attribution", sql("weighted", f"select {KEY}, var, {r('attribution')}, {r('weighted', places=8)} from weighted"), 8)
def w3(i: Inputs) -> DataFrame:
    return weighted(i).drop("brand_mean", "category_sum")


@query(
    "w4_mean_of_means",
    sql("attr_all", f"select pillar, var, {r('attribution', places=8)} from attr_all"),
    8,
)
def w4(i: Inputs) -> DataFrame:
    return weights.mean_of_means(weights.mean_attribution(weighted(i)))


@query(
    "w4_category_means",
    sql(
        "attributions",
        f"""select category, pillar || '_pillar' pillar, var, {r("avg(attribution)", "attribution")}
        from attributions group by 1, 2, 3""",
    ),
)
def w4_category(i: Inputs) -> DataFrame:
    return weights.mean_attribution(weights.pillar_suffix(i.attributions), "attribution")


@query(
    "w5_pillar_suffix",
    sql("sheet", "select pillar, count(*) n from (select pillar from sheet) group by 1"),
)
def w5(i: Inputs) -> DataFrame:
    """Names without the suffix get it, names with it keep it."""
    bare = F.when(F.col("category") == "LARGE", F.regexp_replace("pillar", "_pillar$", ""))
    rows = i.sheet.withColumn("pillar", F.coalesce(bare, "pillar"))
    return weights.pillar_suffix(rows).groupBy("pillar").agg(F.count("*").alias("n"))


@query(
    "w6_loading_subset",
    sql("load_cat", f"select category, pillar, var, {r('est_std')} from load_cat"),
)
def w6(i: Inputs) -> DataFrame:
    return weights.loading_subset(i.category_loadings, i.spec)


@query("w7_lower_var", sql("attributions", "select var, count(*) n from attributions group by 1"))
def w7(i: Inputs) -> DataFrame:
    upper = i.attributions.withColumn("var", F.upper("var"))
    return weights.lower_var(upper).groupBy("var").agg(F.count("*").alias("n"))


@query(
    "w8_merge_sources",
    sql("merged_all", f"select pillar, var, {r('attribution', places=8)}, {r('est_std', places=8)} from merged_all"),
    8,
)
def w8(i: Inputs) -> DataFrame:
    return pooled_merge(i)


@query(
    "w9_metric_weights",
    sql("weights_cat", f"select category, pillar, var, {r('sl', 'share_loading')}, {r('sa', 'share_attribution')}, {r('weight')} from weights_cat"),
)
def w9(i: Inputs) -> DataFrame:
    return category_weights(i).select(
        "category", "pillar", "var", "share_loading", "share_attribution", "weight"
    )


@query("w10_equal_weights", sql("weights_equal", f"select pillar, var, {r('weight')} from weights_equal"))
def w10(i: Inputs) -> DataFrame:
    equal = weights.equal_weights(pooled_weights(i), i.spec.equal_weight_pillars, ["pillar"])
    return equal.select("pillar", "var", "weight")


@query(
    "w11_replicate",
    sql(
        "sheet",
        f"""select category, pillar, metric as var, {r("weight")} from sheet where pillar not in
        ('brand_perceptions_pillar', 'product_feedback_pillar', 'awareness_pillar')""",
    ),
)
def w11(i: Inputs) -> DataFrame:
    pooled = pooled_weights(i).where(F.col("pillar") != "awareness_pillar")
    return weights.replicate(pooled, i.spec.categories).select("category", "pillar", "var", "weight")


@query("w12_weights_sheet", sql("sheet", f"select category, pillar, metric, {r('weight')} from sheet"))
def w12(i: Inputs) -> DataFrame:
    return weights.create_weights(
        i.attributions, i.pooled_loadings, i.category_loadings, i.dv, i.spec
    )


# scores


@query("r1_pillar_scores", sql("scores", f"select {KEY}, date, {r('score')} from scores"))
def r1(i: Inputs) -> DataFrame:
    return scores.pillar_scores(i.pooled(), i.sheet)


@query("r2_long_index", sql("index", f"select {PANEL}, {r('value')}, equity_pillar from index"))
def r2(i: Inputs) -> DataFrame:
    return scores.long_index(i.pooled(), i.scores, i.dictionary())


@query(
    "r3_index_with_dv",
    sql(
        "index dv",
        f"""select {PANEL}, {r("value")}, equity_pillar, {r("dv")} from index
        left join dv using (brand, category, date)""",
    ),
)
def r3(i: Inputs) -> DataFrame:
    return prepare.attach_dv(i.index, i.dv)


TREND = f"select {KEY}, date, {r('trend_past')}, {r('trend_past_future')} from trended"


@query("r4_trend_past", sql("trended", f"select {KEY}, date, {r('score')}, {r('trend_past')} from trended"))
def r4(i: Inputs) -> DataFrame:
    return i.trended().drop("trend_past_future")


@query("r5_trend_past_future", sql("trended", TREND))
def r5(i: Inputs) -> DataFrame:
    return i.trended().drop("score")


@query(
    "r6_lags",
    sql(
        "features",
        f"""select {PANEL}, {r("value")} from (select * from features
        {" ".join(f"union all select brand, category, date, var || '_lag_{k}', lag(value, {k}) over (partition by brand, category, var order by date) from features" for k in (1, 2, 3))})""",
    ),
)
def r6(i: Inputs) -> DataFrame:
    return scores.add_lags(scores.trend_features(i.trended()))


@query("r7_scaled_scores", sql("scored", f"select {PANEL}, equity_pillar, {r('value')}, {r('score')} from scored"))
def r7(i: Inputs) -> DataFrame:
    return scores.scaled_scores(i.index)


@query(
    "r7_scaled_pillars",
    sql("scored", f"select {PANEL}, {r('score')} from scored where var like '%\\_pillar' escape '\\'"),
)
def r7_pillars(i: Inputs) -> DataFrame:
    return scores.scaled_scores(i.index, only_pillars=True).select(*PANEL_KEY, "var", "score")


@query(
    "r8_scores_long",
    sql(
        "scored",
        f"""select brand, category, date, var as variable, {r("value", "column_value")} from scored
        union all select brand, category, date, var || '_scores', {r("score", "column_value")} from scored""",
    ),
)
def r8(i: Inputs) -> DataFrame:
    return scores.scores_long(scores.scaled_scores(i.index))


@query("r9_date_categories", sql("scored", "select distinct date, category from scored"))
def r9(i: Inputs) -> DataFrame:
    return scores.date_categories(i.index)


# importance and hub


def moved_features(i: Inputs) -> DataFrame:
    """Trend features whose brands sit in a sub-category of their sales category."""
    return harmonise.move_categories(scores.trend_features(i.trended()), i.moves())


MOVED = """select f.brand, coalesce(to_category, f.category) category, date, var, value
  from features f left join moves using (brand, category)"""
PARENTED = f"""select brand, m.category as category_new, coalesce(parent, m.category) category, date, var, value
  from ({MOVED}) m left join parents p on p.category_new = m.category"""


@query(
    "i1_parent_category",
    sql(
        "features moves parents",
        f"select brand, category_new, category, date, var, {r('value')} from ({PARENTED})",
    ),
)
def i1(i: Inputs) -> DataFrame:
    return importance.parent_category(moved_features(i), i.parents())


@query(
    "i2_join_sales",
    sql(
        "features sales",
        f"""select {PANEL}, {r("value")}, {r("total_sales")}, {r("average_price")} from features
        left join (select brand, category, date, total_sales, average_price from sales) using (brand, category, date)""",
    ),
)
def i2(i: Inputs) -> DataFrame:
    """Through sub-category and parent the rows find the sales of their own category again."""
    sold = i.sales().select(*PANEL_KEY, "total_sales", "average_price")
    rows = importance.parent_category(moved_features(i), i.parents()).drop("category_new")
    return importance.join_sales(rows, sold)


FAMILY = "select * from features where var like '%\\_trend\\_past' escape '\\'"


@query("i3_trend_family", sql("features", f"select {PANEL}, {r('value')} from ({FAMILY})"))
def i3(i: Inputs) -> DataFrame:
    lagged = scores.add_lags(scores.trend_features(i.trended()))
    return importance.trend_family(lagged, i.spec.pillars)


IMPORTANCE_ROWS = f"""select brand, category, date, var, coalesce(value, avg(value) over
  (partition by brand, category, var)) as value from (select *, row_number() over
  (partition by brand, category, var order by date) rn from (select *, count(*) over w n,
  count(*) filter (value is null) over w nulls from ({FAMILY}) window w as (partition by brand, category, var))
  where nulls <= n * 0.5) where rn > 3"""


@query("i4_importance_rows", sql("features", f"select {PANEL}, {r('value')} from ({IMPORTANCE_ROWS})"))
def i4(i: Inputs) -> DataFrame:
    family = importance.trend_family(scores.trend_features(i.trended()), i.spec.pillars)
    return importance.importance_rows(family)


@query(
    "i4_standardised_rows",
    sql(
        "features",
        f"""select {PANEL}, {r("case when sd > 1e-12 then (value - mu) / sd else 0 end", "value")} from
        (select *, avg(value) over w mu, stddev_pop(value) over w sd from ({IMPORTANCE_ROWS})
        window w as (partition by brand, category, var))""",
    ),
)
def i4_standard(i: Inputs) -> DataFrame:
    family = importance.trend_family(scores.trend_features(i.trended()), i.spec.pillars)
    return importance.standardise(importance.importance_rows(family))


@query("i5_pillar_importance")
def i5(i: Inputs) -> DataFrame:
    return importance.pillar_importance(
        scores.trend_features(i.trended()), i.sales(), i.parents(), i.spec
    )


@query("i5_importance_with_price")
def i5_price(i: Inputs) -> DataFrame:
    """Brands in sub-categories, whose sales lie in the parent, with price, distribution and lags."""
    model = replace(i.spec.importance_model, price_and_distribution=True, lags=True)
    spec = replace(i.spec, importance_model=model)
    return importance.pillar_importance(moved_features(i), i.sales(), i.parents(), spec)


def trend_results(i: Inputs) -> DataFrame:
    """Result rows of a finished importance run: |corr| of each pillar trend with the share."""
    rows = i.trended().join(i.dv, list(PANEL_KEY), "left").select(
        *PANEL_KEY, F.concat("pillar", F.lit("_trend_past")).alias("var"),
        F.col("trend_past").alias("value"), "dv",
    )
    found = stats.dv_correlation(rows).where(F.col("corr_abs").isNotNull())
    one = found.select("brand", "category", "var", F.col("corr_abs").alias("attribution"))
    ids = [one.withColumn("model", F.lit(m)) for m in (RIDGE, "other")]
    return reduce(DataFrame.unionByName, ids)


RELATIVE = """select brand, category, var, attribution, attribution / nullif(sum(attribution) over
  (partition by brand, category), 0) relative_importance from (
  select brand, category, pillar || '_trend_past' as var, abs(covar_pop(dv, trend_past) /
    (stddev_pop(case when trend_past is not null then dv end) * stddev_pop(case when dv is not null then trend_past end))) attribution
  from trended left join dv using (brand, category, date) group by 1, 2, 3
  having stddev_pop(case when trend_past is not null then dv end) * stddev_pop(case when dv is not null then trend_past end) > 1e-12)"""


@query(
    "i6_relative_importance",
    sql("trended dv", f"select brand, category, var, {r('attribution')}, {r('relative_importance')} from ({RELATIVE})"),
)
def i6(i: Inputs) -> DataFrame:
    return importance.relative_importance(trend_results(i), RIDGE)


@query(
    "i7_metric_contribution",
    sql("contrib", f"select {PANEL}, equity_pillar, {r('value')}, {r('weight')}, {r('metric_contribution')} from contrib"),
)
def i7(i: Inputs) -> DataFrame:
    return importance.metric_contribution(i.index, i.sheet)


@query(
    "i8_category_contribution",
    sql("hub", f"select {PANEL}, {r('category_mc_avg')}, {r('mc_diff_to_catg_avg')} from hub"),
)
def i8(i: Inputs) -> DataFrame:
    rows = importance.category_contribution(importance.metric_contribution(i.index, i.sheet))
    return rows.select(*PANEL_KEY, "var", "category_mc_avg", "mc_diff_to_catg_avg")


@query("i9_is_pillar", sql("hub", "select var, equity_pillar, is_pillar, count(*) n from hub group by 1, 2, 3"))
def i9(i: Inputs) -> DataFrame:
    return importance.is_pillar(i.index).groupBy("var", "equity_pillar", "is_pillar").agg(
        F.count("*").alias("n")
    )


@query("i10_scaled_values", sql("hub", f"select {PANEL}, {r('value')}, equity_pillar, {r('scaled_values')} from hub"))
def i10(i: Inputs) -> DataFrame:
    return importance.add_scaled(i.index, scores.scores_long(scores.scaled_scores(i.index)))


@query(
    "i11_metric_map",
    sql(
        "index dict",
        """select var, metric_name, data_source, vendor_group from (select distinct var from index)
        left join (select distinct var, metric_name, data_source, vendor_group from dict) using (var)""",
    ),
)
def i11(i: Inputs) -> DataFrame:
    return importance.metric_map(i.index, i.dictionary())


@query(
    "i12_metric_type",
    sql(
        "index",
        """select var, case when contains(var, '_mean') then 'mean' when contains(var, '_rank_1st') then 'rank_1st'
        when contains(var, '_net') then 'net' else '' end metric_type, count(*) n from index group by 1, 2""",
    ),
)
def i12(i: Inputs) -> DataFrame:
    return importance.metric_type(i.index).groupBy("var", "metric_type").agg(F.count("*").alias("n"))


# scorecard


def hub(i: Inputs) -> DataFrame:
    return importance.hub_table(i.index, i.sheet, scores.scores_long(scores.scaled_scores(i.index)))


def detail(i: Inputs) -> DataFrame:
    return scorecard.scorecard_detail(hub(i))


def raw(i: Inputs) -> DataFrame:
    return i.panel.select(*PANEL_KEY, "var", F.col("value").alias("metric_raw_value"))


def enriched(i: Inputs) -> DataFrame:
    return scorecard.enrich_detail(detail(i), raw(i), i.prices(), i.dashboard())


def summary(i: Inputs) -> DataFrame:
    return scorecard.scorecard_summary(detail(i), raw(i), i.prices(), i.dashboard())


@query(
    "c1_scorecard_detail",
    sql(
        "hub",
        f"""select {PANEL}, equity_pillar, {r("weight")}, {r("scaled_values")}, cast(year as int) as year,
        cast(month as int) as month, case when is_pillar then 'Pillar' else 'Metric' end metric_type from hub""",
    ),
)
def c1(i: Inputs) -> DataFrame:
    return detail(i)


@query("c2_raw_values", sql("panel", f"select {PANEL}, {r('value', 'metric_raw_value')} from panel"))
def c2(i: Inputs) -> DataFrame:
    return scorecard.raw_values(i.panel_wide())


@query(
    "c3_enrich_detail",
    sql(
        "hub panel prices dashboard",
        f"""select h.brand, h.category, h.date, coalesce(new_name, h.var) as var, equity_pillar, {r("weight")},
        {r("scaled_values")}, case when is_pillar then 'Pillar' else 'Metric' end metric_type, price_class,
        {r("p.value", "metric_raw_value")} from hub h
        left join panel p on p.brand = h.brand and p.category = h.category and p.date = h.date and p.var = h.var
        left join prices on prices.brand = h.brand and prices.category = h.category
        left join dashboard d on d.var = h.var""",
    ),
)
def c3(i: Inputs) -> DataFrame:
    return enriched(i).drop("year", "month")


@query(
    "c4_pretty_names",
    sql(
        "named",
        """select distinct metric_type, array_to_string(list_transform(string_split(replace(replace(
        equity_pillar, '_pillar', ''), '_', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') equity_pillar,
        (select count(*) from named) n from named""",
    ),
)
def c4(i: Inputs) -> DataFrame:
    rows = scorecard.pretty_names(enriched(i)).groupBy("metric_type", "equity_pillar").agg(
        F.count("*").alias("part")
    )
    return rows.withColumn("n", rows.agg(F.sum("part")).scalar()).drop("part")


@query(
    "c4_title_case",
    sql(
        "",
        """select distinct p_name, array_to_string(list_transform(string_split(lower(p_name), ' '),
        lambda w: upper(w[1]) || w[2:]), ' ') title from part""",
    ),
)
def c4_title(i: Inputs) -> DataFrame:
    return i.table("part").select("p_name").distinct().withColumn("title", title_case("p_name"))


@query(
    "c5_pillar_labels",
    sql("named", "select metric_type, metric_name as var, count(*) n from named group by 1, 2"),
)
def c5(i: Inputs) -> DataFrame:
    return scorecard.pillar_labels(enriched(i)).groupBy("metric_type", "var").agg(F.count("*").alias("n"))


CARD = "brand, category, price_class, equity_pillar, metric_type, metric_name, date"
VALUES = f"{r('metric_raw_value')}, {r('weight')}, {r('scaled_scores')}"


@query("c6_project_summary", sql("named", f"select {CARD}, {VALUES} from named"))
def c6(i: Inputs) -> DataFrame:
    return scorecard.project_summary(scorecard.pillar_labels(enriched(i)))


@query(
    "c7_drop_unweighted",
    sql(
        "named",
        """select metric_type, weight is null no_weight, count(*) n from named
        where not (weight is null and metric_type = 'Metric') group by 1, 2""",
    ),
)
def c7(i: Inputs) -> DataFrame:
    kept = scorecard.drop_unweighted(scorecard.project_summary(enriched(i)))
    return kept.groupBy("metric_type", F.col("weight").isNull().alias("no_weight")).agg(
        F.count("*").alias("n")
    )


@query("c8_sorted_summary", sql("summary", f"select {CARD}, {VALUES} from summary"))
def c8(i: Inputs) -> DataFrame:
    return scorecard.sort_summary(summary(i))


@query(
    "c9_round_summary",
    sql(
        "named",
        f"""select {CARD}, {even("metric_raw_value", 5)} metric_raw_value, {even("weight", 5)} weight,
        {even("scaled_scores", 2)} scaled_scores from named""",
    ),
)
def c9(i: Inputs) -> DataFrame:
    return scorecard.round_summary(scorecard.project_summary(scorecard.pillar_labels(enriched(i))))


@query(
    "c10_importance_sheet",
    sql(
        "trended dv prices",
        f"""select brand, category, price_class, array_to_string(list_transform(string_split(replace(
        replace(var, '_pillar_trend_past', ''), '_', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') equity_pillar,
        {even("relative_importance", 4)} relative_importance from ({RELATIVE})
        left join prices using (brand, category)""",
    ),
)
def c10(i: Inputs) -> DataFrame:
    shares = importance.relative_importance(trend_results(i), RIDGE)
    return scorecard.importance_sheet(shares, i.prices())


@query("c11_scorecard_summary", sql("summary", f"select {CARD}, {VALUES} from summary"))
def c11(i: Inputs) -> DataFrame:
    return summary(i)


# end to end


@query("e5_score", sql("scored", f"select {PANEL}, equity_pillar, {r('value')}, {r('score')} from scored"))
def e5(i: Inputs) -> DataFrame:
    return refresh.score(i.scaled, i.sheet, i.maps(), i.spec).scaled


@query("e6_publish", sql("summary", f"select {CARD}, {VALUES} from summary"))
def e6(i: Inputs) -> DataFrame:
    scored = refresh.score(i.scaled, i.sheet, i.maps(), i.spec)
    return refresh.publish_summary(i.panel, scored, i.sheet, i.maps())["summary"]


@query("e6_published_importance")
def e6_importance(i: Inputs) -> DataFrame:
    scored = refresh.score(i.scaled, i.sheet, i.maps(), i.spec)
    return refresh.publish_importance(scored, i.sales(), i.maps(), i.spec)


MOVES_SQL = """with card as materialized (select brand, category, date, equity_pillar, scaled_scores from summary where metric_type = 'Pillar'),
  old as (select * exclude (scaled_scores), scaled_scores * case when month(date) % 2 = 0 then 0.9::double else 1.0::double end old_score from card)
  select n.brand, n.category, n.date, n.equity_pillar, old_score, n.scaled_scores new_score,
  (n.scaled_scores - old_score) / nullif(old_score, 0) * 100 pct,
  coalesce(old_score = 0 and n.scaled_scores <> 0, false) from_zero, n.brand || ' ' || split_part(n.category, ' ', 1) as label
  from card n join old o on n.brand = o.brand and n.category = o.category and n.date = o.date
  and n.equity_pillar = o.equity_pillar"""
FLAG = "(coalesce(abs(pct) > 5, false) or from_zero)"


def old_card(i: Inputs, card: DataFrame) -> DataFrame:
    """The scorecard of the refresh before: lower scores in every other month."""
    factor = F.when(F.month("date") % 2 == 0, 0.9).otherwise(1.0)
    return card.withColumn("scaled_scores", F.col("scaled_scores") * factor)


@query(
    "e7_compare_scores",
    sql(
        "summary",
        f"""select label as "Brand", date as "Date", equity_pillar as "Pillar",
        {r("old_score", '"Previous Refresh"')}, {r("new_score", '"Current Refresh"')},
        case when from_zero then case when new_score > 0 then 'inf%' else '-inf%' end
        else printf('%.1f%%', {even("pct", 1)}) end as "%Deviation" from ({MOVES_SQL}) where {FLAG}""",
    ),
)
def e7(i: Inputs) -> DataFrame:
    card = i.staged("card", lambda: summary(i))
    return refresh.compare_scorecards(old_card(i, card), card, i.spec)["report"]


@query(
    "e7_compare_summary",
    sql(
        "summary",
        f"""select total_brands, total_brands - bad brands_without_deviation, bad brands_with_deviation,
        {even("(total_brands - bad) / total_brands * 100", 2)} success_pct, {even("bad / total_brands * 100", 2)} fail_pct
        from (select count(distinct label) total_brands, count(distinct case when {FLAG} then label end) bad
        from ({MOVES_SQL}))""",
    ),
)
def e7_summary(i: Inputs) -> DataFrame:
    card = i.staged("card", lambda: summary(i))
    return refresh.compare_scorecards(old_card(i, card), card, i.spec)["summary"]


@query(
    "v5_score_difference",
    sql(
        "summary",
        f"""select brand, category, date, equity_pillar, {r("old_score", "value_old")},
        {r("new_score", "value_new")}, {r("pct", "difference_pct")}, from_zero from ({MOVES_SQL})""",
    ),
)
def v5_scores(i: Inputs) -> DataFrame:
    card = i.staged("card", lambda: summary(i))
    return validate.score_comparison(old_card(i, card), card)
