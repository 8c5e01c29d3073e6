"""Queries that compare refreshes and prepare data."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitrace.catalog.inputs import Inputs
from equitrace.catalog.oracle import even, r
from equitrace.catalog.oracle import query as sql
from equitrace.catalog.registry import query
from equitrace.catalog.sales_queries import INVERSE, PERCENT, SHARES
from equitrace.catalog.score_queries import summary
from equitrace.functions.grouping import PANEL_KEY
from equitrace.operators import harmonise, prepare, validate
from equitrace.plans import refresh

PANEL = "brand, category, date, var"
PAIR = f"{r('value_old')}, {r('value_new')}"


def compared(i: Inputs) -> DataFrame:
    return validate.percent_difference(
        validate.match_refreshes(*validate.common_frame(i.old_panel, i.panel))
    )


def tagged(i: Inputs) -> DataFrame:
    return validate.tag_scope(validate.mean_difference(compared(i)), i.dictionary(), i.brand_list())


def scoped(i: Inputs) -> DataFrame:
    return validate.brand_label(validate.in_scope(tagged(i)))


@query("v1_unpivot", sql("panel", f"select {PANEL}, {r('value')} from panel where var not like 'search%'"))
def v1(i: Inputs) -> DataFrame:
    return harmonise.unpivot_metrics(i.panel_wide(), exclude=("search_searchvolume",))


@query(
    "v2_numeric_coercion",
    sql(
        "",
        f"""select brand, n, {r("value")} from (
        select p_brand brand, count(*) n, sum(try_cast(case when p_partkey % 2 = 0
        then cast(p_retailprice as varchar) else p_name end as double)) as value from part group by 1)""",
    ),
)
def v2(i: Inputs) -> DataFrame:
    """Prices as text on some rows, names on the others."""
    text = F.when(F.col("p_partkey") % 2 == 0, F.col("p_retailprice").cast("string")).otherwise(
        F.col("p_name")
    )
    rows = validate.coerce_values(i.table("part").select(F.col("p_brand").alias("brand"), text.alias("value")))
    return rows.groupBy("brand").agg(F.count("*").alias("n"), F.sum("value").alias("value"))


@query(
    "v3_common_frame",
    sql(
        "panel old_panel",
        f"""select {PANEL}, {r("value")} from panel where date between
        (select greatest(min(o.date), (select min(date) from panel)) from old_panel o) and
        (select least(max(o.date), (select max(date) from panel)) from old_panel o)""",
    ),
)
def v3(i: Inputs) -> DataFrame:
    return validate.common_frame(i.old_panel, i.panel)[1]


@query("v4_match_refreshes", sql("joined", f"select {PANEL}, {PAIR} from joined"))
def v4(i: Inputs) -> DataFrame:
    return validate.match_refreshes(*validate.common_frame(i.old_panel, i.panel))


@query(
    "v5_percent_difference",
    sql("compared", f"select {PANEL}, {PAIR}, {r('difference_pct')}, from_zero from compared"),
)
def v5(i: Inputs) -> DataFrame:
    return compared(i)


@query(
    "v6_mean_difference",
    sql("mean_diff", f"select {PANEL}, {PAIR}, from_zero, {r('avg_difference_pct')} from mean_diff"),
)
def v6(i: Inputs) -> DataFrame:
    return validate.mean_difference(compared(i))


@query(
    "v6_mean_by_metric",
    sql(
        "compared",
        f"""select brand, category, var, {r("avg(difference_pct)", "avg_difference_pct")},
        bool_or(from_zero) from_zero from compared group by 1, 2, 3""",
    ),
)
def v6_sales(i: Inputs) -> DataFrame:
    return validate.mean_difference_by_metric(compared(i))


@query(
    "v7_scope_tags",
    sql(
        "tagged",
        f"""select {PANEL}, {PAIR}, from_zero, {r("avg_difference_pct")}, idv_list, brand_list from tagged""",
    ),
)
def v7(i: Inputs) -> DataFrame:
    return tagged(i)


@query(
    "v8_data_source",
    sql(
        "panel",
        """select var, case split_part(var, '_', 1) when 'neilsen' then 'neilsen_panel'
        when 'ratings' then 'ratings_reviews' else split_part(var, '_', 1) end data_source,
        count(*) n_rows from panel group by 1
        union all select 'average_price_rt', 'RMS', count(*) from wide""",
    ),
)
def v8(i: Inputs) -> DataFrame:
    priced = i.panel_wide().select("brand", F.lit("average_price_rt").alias("var"))
    rows = i.panel.select("brand", "var").unionByName(priced)
    return validate.data_source(rows).groupBy("var", "data_source").agg(F.count("*").alias("n_rows"))


@query(
    "v9_deviations",
    sql("flagged", f"select {PANEL}, {PAIR}, from_zero, {r('avg_difference_pct')} from flagged"),
)
def v9(i: Inputs) -> DataFrame:
    return validate.deviations(tagged(i)).drop("idv_list", "brand_list")


@query(
    "v10_brand_label",
    sql(
        "scoped",
        """select brand, category, label, replace(replace(replace(brand || ' ' || category,
        ' TREATS ONLY', ''), ' LITTER', ''), ' FOOD', '') sales_label, count(*) n from scoped group by all""",
    ),
)
def v10(i: Inputs) -> DataFrame:
    counts = scoped(i).groupBy("brand", "category", "label").agg(F.count("*").alias("n"))
    both = validate.sales_label(counts.withColumnRenamed("label", "first"))
    return both.withColumnsRenamed({"label": "sales_label", "first": "label"})


TEXT = f"""case when from_zero then case when value_new > 0 then 'inf%' else '-inf%' end
  else printf('%.1f%%', {even("avg_difference_pct", 1)}) end"""


@query("v11_percent_text", sql("flagged", f"select {PANEL}, {TEXT} as pct_text from flagged"))
def v11(i: Inputs) -> DataFrame:
    rows = validate.deviations(tagged(i))
    return rows.select(*PANEL_KEY, "var", validate.deviation_text().alias("pct_text"))


@query(
    "v12_deviation_report",
    sql(
        "flagged",
        f"""select label as "Brand", date as "Date", var as "Variable",
        {r("value_old", '"Previous Refresh"')}, {r("value_new", '"Current Refresh"')},
        {TEXT} as "%Deviation" from flagged""",
    ),
)
def v12(i: Inputs) -> DataFrame:
    return validate.deviation_report(validate.deviations(tagged(i)))


SUMMARY = f"""select total_brands, total_brands - bad brands_without_deviation, bad brands_with_deviation,
  {even("(total_brands - bad) / total_brands * 100", 2)} success_pct, {even("bad / total_brands * 100", 2)} fail_pct"""


@query(
    "v13_deviation_summary",
    sql(
        "scoped flagged",
        f"""{SUMMARY} from (select count(distinct label) total_brands,
        (select count(distinct label) from flagged where abs(avg_difference_pct) > 5) bad from scoped)""",
    ),
)
def v13(i: Inputs) -> DataFrame:
    """Brands whose metrics move by more than the configured limit."""
    return validate.deviation_summary(
        scoped(i),
        F.coalesce(F.abs("avg_difference_pct") > i.spec.deviation_pct, F.lit(False)),
    )


@query(
    "v14_deviating_brands",
    sql(
        "flagged",
        """select string_agg(label, ', ' order by label) brands_with_deviation
        from (select distinct label from flagged)""",
    ),
)
def v14(i: Inputs) -> DataFrame:
    return validate.deviating_brands(validate.deviations(tagged(i)), i.brand_list())


@query(
    "v15_added_brands",
    sql(
        "panel old_panel brand_list",
        """select distinct brand from panel where brand not in (select brand from old_panel
        semi join brand_list using (brand, category))""",
    ),
)
def v15(i: Inputs) -> DataFrame:
    """Against the whole old refresh, which held only brands in scope."""
    old = i.old_panel.join(i.brand_list(), ["brand", "category"], "left_semi")
    return validate.added_brands(old, i.panel)


@query(
    "v16_pillar_rows",
    sql(
        "summary",
        f"""select brand, category, date, metric_name, {r("scaled_scores")} from summary
        where metric_type = 'Pillar'""",
    ),
)
def v16(i: Inputs) -> DataFrame:
    return validate.pillar_rows(summary(i)).select(
        "brand", "category", "date", "metric_name", "scaled_scores"
    )


@query(
    "v17_sufficiency",
    sql(
        "panel dict brand_list",
        f"""select p.brand, p.category, p.var, case split_part(p.var, '_', 1) when 'ratings' then 'ratings_reviews'
        else split_part(p.var, '_', 1) end data_source, case when b.brand is null then 'N' else 'Y' end brand_list,
        coalesce(d.select_flag, 'N') idv_list, count(value) non_null_count, count(value) total_count,
        {r("avg(case when value is null then 0.0::double else 1 end) * 100", "availability_pct")},
        min(date) filter (value is not null) start_date, max(date) filter (value is not null) end_date
        from panel p left join (select * from dict where select_flag = 'Y') d
          on d.category = p.category and d.var = p.var
        left join brand_list b on b.brand = p.brand and b.category = p.category
        where date between '1996-01-01' and '2000-12-31' group by 1, 2, 3, 4, 5, 6""",
    ),
)
def v17(i: Inputs) -> DataFrame:
    rows = validate.date_range(i.panel, dt.date(1996, 1, 1), dt.date(2000, 12, 31))
    rows = validate.tag_scope(validate.data_source(rows), i.dictionary(), i.brand_list())
    return validate.sufficiency(rows)


@query(
    "v18_date_range",
    sql(
        "panel",
        f"""select {PANEL}, {r("value")} from panel
        where date between '1996-01-01' and '2000-12-31'""",
    ),
)
def v18(i: Inputs) -> DataFrame:
    return validate.date_range(i.panel, dt.date(1996, 1, 1), dt.date(2000, 12, 31))


# data preparation


def leveled(i: Inputs) -> DataFrame:
    return prepare.levels(prepare.cap(i.selected()))


@query(
    "p1_levels",
    sql(
        "lev",
        f"""select scope, new_brand level_brand, category, var, count(*) n, count(value) non_null,
        {r("min(value)", "low")} from lev group by 1, 2, 3, 4""",
    ),
)
def p1(i: Inputs) -> DataFrame:
    return leveled(i).groupBy(*prepare.LEVEL, "var").agg(
        F.count("*").alias("n"), F.count("value").alias("non_null"), F.min("value").alias("low")
    )


@query(
    "p2_listed_brands",
    sql("panel brand_list", f"select {PANEL}, {r('value')} from panel semi join brand_list using (brand, category)"),
)
def p2(i: Inputs) -> DataFrame:
    return prepare.keep_listed_brands(i.panel, i.brand_list())


@query("p3_select_metrics", sql("sel", f"select {PANEL}, {r('value')}, {r('lo', 'min')}, {r('hi', 'max')} from sel"))
def p3(i: Inputs) -> DataFrame:
    return i.selected()


@query("p4_cap", sql("capped", f"select {PANEL}, {r('value')} from capped"))
def p4(i: Inputs) -> DataFrame:
    return prepare.cap(i.selected()).drop("min", "max")


KEPT = "nn >= greatest(1, (n * (100 - case when category = 'PROMO' then 90 else 50 end)) // 100)"


@query(
    "p5_sparse_drop",
    sql("lstat", f"select scope, new_brand level_brand, category, var, n, nn non_null from lstat where {KEPT}"),
)
def p5(i: Inputs) -> DataFrame:
    kept = prepare.dense_enough(prepare.level_stats(leveled(i)), i.spec)
    return kept.select(*prepare.LEVEL, "var", "n", "non_null")


FILLED = f"""select scope, new_brand, brand, category, date, var, coalesce(value, mean) as value,
  mean, low, high, std, n, nn, lo, hi from lev join lstat using (scope, new_brand, category, var) where {KEPT}"""
LEVELLED = "scope, new_brand as level_brand, brand, category, date, var"


def imputed(i: Inputs) -> DataFrame:
    return prepare.impute(prepare.drop_sparse(leveled(i), i.spec))


def level_rows(df: DataFrame) -> DataFrame:
    return df.select("scope", "level_brand", *PANEL_KEY, "var", "value")


@query("p6_impute", sql("lev lstat", f"select {LEVELLED}, {r('value')} from ({FILLED})"))
def p6(i: Inputs) -> DataFrame:
    return level_rows(imputed(i))


@query("p7_scale_bounds", sql("lev lstat", f"select {LEVELLED}, {r('(value - lo) / nullif(hi - lo, 0)', 'value')} from ({FILLED})"))
def p7(i: Inputs) -> DataFrame:
    return level_rows(prepare.scale_bounds(imputed(i)))


@query(
    "p8_scale_minmax",
    sql("lev lstat", f"select {LEVELLED}, {r('coalesce((value - low) / nullif(high - low, 0), 0)', 'value')} from ({FILLED})"),
)
def p8(i: Inputs) -> DataFrame:
    return level_rows(prepare.scale_minmax(imputed(i)))


@query(
    "p9_scale_zscore",
    sql(
        "lev lstat",
        f"""select {LEVELLED}, {r("case when sd > 0 then (value - mu) / sd else 0 end", "value")} from (
        select *, avg(value) over w mu, stddev_pop(value) over w sd from ({FILLED})
        window w as (partition by scope, new_brand, category, var))""",
    ),
)
def p9(i: Inputs) -> DataFrame:
    return level_rows(prepare.scale_zscore(imputed(i)))


@query("p10_level_tags", sql("scaled", "select scope, new_brand, category, count(*) n from scaled group by 1, 2, 3"))
def p10(i: Inputs) -> DataFrame:
    return i.scaled.groupBy("scope", "new_brand", "category").agg(F.count("*").alias("n"))


@query("p11_union_levels", sql("scaled", f"select scope, {PANEL}, new_brand, {r('value')} from scaled"))
def p11(i: Inputs) -> DataFrame:
    return prepare.scaled_panel(i.panel, i.dictionary(), i.brand_list(), i.spec)


@query(
    "p12_attach_dv",
    sql("modelling", f"select scope, {PANEL}, new_brand, {r('value')}, {r('dv')} from modelling"),
)
def p12(i: Inputs) -> DataFrame:
    return i.modelling()


# end to end


# the panel with percentages, then inverses, then shares, then moves
DERIVED = {
    "d1": f"select * from panel union all {PERCENT}",
    "d2": f"select * from d1 union all {INVERSE}".replace("from panel", "from d1"),
    "d3": f"select * from d2 union all {SHARES}".replace("from panel", "from d2"),
}


@query(
    "e1_build_panel",
    sql("panel rules moves", "").rstrip()
    + "".join(f",\n{n} as materialized ({t})" for n, t in DERIVED.items())
    + f"""
    select brand, coalesce(to_category, category) category, date, var, {r("value")}
    from d3 left join moves using (brand, category)""",
)
def e1(i: Inputs) -> DataFrame:
    return refresh.build_panel(i.panel, i.maps())


@query(
    "e2_validate_refresh",
    sql(
        "flagged",
        f"""select label as "Brand", date as "Date", var as "Variable",
        {r("value_old", '"Previous Refresh"')}, {r("value_new", '"Current Refresh"')},
        {TEXT} as "%Deviation" from flagged""",
    ),
)
def e2(i: Inputs) -> DataFrame:
    return refresh.validate_panels(i.old_panel, i.panel, i.maps(), i.spec)["report"]


@query(
    "e3_prepare",
    sql("modelling", f"""select scope, {PANEL}, new_brand, {r("value")}, {r("dv")} from modelling""").replace(
        "select brand, category, date, var, value, lo, hi from panel",
        "select brand, category, date, var, value, lo, hi from (select * from panel"
        " where date between '1996-01-01' and '2000-12-31')",
    ),
)
def e3(i: Inputs) -> DataFrame:
    spec = replace(i.spec, start_date=dt.date(1996, 1, 1), end_date=dt.date(2000, 12, 31))
    return refresh.prepare_data(i.panel, i.dv, i.maps(), spec)[1]

