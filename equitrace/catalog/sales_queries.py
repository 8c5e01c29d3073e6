"""Queries on sources, sales facts and harmonised metrics."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitrace import schemas
from equitrace.catalog.inputs import CATEGORIES, EVENT_VARS, MARKET, ROLLUP, Inputs
from equitrace.catalog.oracle import EVENT_PIVOT, r
from equitrace.catalog.oracle import query as sql
from equitrace.catalog.registry import query
from equitrace.operators import harmonise, sales
from equitrace.plans import refresh
from equitrace.sources import commits, io
from equitrace.sources.workspace import shared_dir

PANEL = "brand, category, date, var"
WEEK = "vendor, brand, category, date"
SUMS = ("s_dollars", "s_base_dollars", "s_pounds", "s_base_pounds", "s_units", "s_base_units")
MEASURES = ("total_sales", "s_base_dollars", "eq_volume", "s_base_pounds", "total_units", "s_base_units")
MEANS = ("a_dollars", "a_base_dollars", "a_pounds", "a_base_pounds", "a_units", "a_base_units")
NORMALISED = dict(zip(MEASURES, MEANS, strict=True))


def rs(names, places: int = 4) -> str:
    return ", ".join(r(n, places=places) for n in names)


def new_path(i: Inputs, name: str) -> str:
    return f"{shared_dir(i.spark)}/equitrace/{name}-{uuid.uuid4().hex[:12]}"


# sources and sinks


@query("io1_csv_scan", sql("panel", f"select {PANEL}, {r('value')} from panel"))
def io1(i: Inputs) -> DataFrame:
    path = new_path(i, "panel-csv")
    io.write_csv(harmonise.unpivot_metrics(i.panel_wide()), path)
    return io.read_csv(i.spark, path, schemas.PANEL_LONG)


@query(
    "io2_table_scan",
    sql("events_long", f"select * exclude (metric_value), {r('metric_value')} from events_long"),
)
def io2(i: Inputs) -> DataFrame:
    i.events_long().createOrReplaceTempView("metrics_by_week")
    return io.read_harmonised(i.spark, "weekly", {"weekly": "metrics_by_week"})


@query("io3_warehouse_query", sql("weekly", f"select {WEEK}, {rs(SUMS)} from weekly"), 4)
def io3(i: Inputs) -> DataFrame:
    for name, df in zip(("facts", "periods", "markets", "products"), i.star(), strict=True):
        df.createOrReplaceTempView(f"rms_{name}")
    return i.spark.sql(
        """
        SELECT vendor, brand, category, week_ending AS date,
               round(sum(dollars), 4) AS s_dollars, round(sum(base_dollars), 4) AS s_base_dollars,
               round(sum(pounds), 4) AS s_pounds, round(sum(base_pounds), 4) AS s_base_pounds,
               round(sum(units), 4) AS s_units, round(sum(base_units), 4) AS s_base_units
        FROM rms_facts
        LEFT JOIN rms_periods USING (period_key)
        LEFT JOIN rms_markets USING (market_key)
        LEFT JOIN rms_products USING (product_key)
        WHERE period_weeks = 1 AND market_description = :market
        GROUP BY vendor, brand, category, week_ending
        """,
        args={"market": MARKET},
    )


@query(
    "io4_load_and_clean",
    sql(
        "",
        """select l_orderkey, l_linenumber, cast(l_shipdate as date) shipped,
        make_date(cast(year(l_shipdate) as int), cast(month(l_shipdate) as int), 1) date,
        count(*) n from lineitem group by all""",
    ),
)
def io4(i: Inputs) -> DataFrame:
    rows = i.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_tax",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
        F.year("l_shipdate").cast("string").alias("year_rt"),
        F.month("l_shipdate").cast("string").alias("month_rt"),
    )
    out = io.load_and_clean(rows, ["shipped"], ["l_tax", "Unnamed: 0"], "year_rt", "month_rt")
    return out.groupBy("l_orderkey", "l_linenumber", "shipped", "date").agg(F.count("*").alias("n"))


@query("io5_stage_sink", sql("panel", f"select {PANEL}, {r('value')} from panel"))
def io5(i: Inputs) -> DataFrame:
    root, month = new_path(i, "staging"), dt.date(2024, 12, 1)
    io.write_stage(harmonise.unpivot_metrics(i.panel_wide()), root, "data_prep", "panel", month)
    return io.read_stage(i.spark, root, "data_prep", "panel", month).select(*PANEL.split(", "), "value")


@query(
    "io6_dated_layout",
    sql("panel", f"select brand, category, date, var, {r('value')} from panel"),
)
def io6(i: Inputs) -> DataFrame:
    """Two refreshes side by side; the later one is read back alone."""
    root = new_path(i, "refreshes")
    now, before = io.refresh_month(dt.date(2024, 12, 17)), io.refresh_month(dt.date(2024, 11, 5))
    io.write_stage(i.old_panel, root, "processed_input_data", "panel", before)
    io.write_stage(i.panel, root, "processed_input_data", "panel", now)
    return io.read_stage(i.spark, root, "processed_input_data", "panel", now).select(
        *PANEL.split(", "), "value"
    )


@query(
    "io5_whole_refresh",
    sql("panel", f"select {PANEL}, {r('value')} from panel where category <> '{CATEGORIES[0]}'"),
)
def io5_whole(i: Inputs) -> DataFrame:
    """A refresh, its re-run without one category, and a run that ends before its commit."""
    root, month = new_path(i, "whole"), dt.date(2024, 12, 1)
    fewer = i.panel.where(F.col("category") != CATEGORIES[0])
    for panel in (i.old_panel, fewer):
        refresh.commit_tables(root, month, {("data_prep", "panel"): panel})
    commits.Attempt(i.spark, root, month).write(i.panel, "data_prep", "panel")
    return commits.read_table(i.spark, root, "data_prep", "panel", month).select(*PANEL.split(", "), "value")


@query("io6_carried_tables", sql("sheet", f"select category, pillar, metric, {r('weight')} from sheet"))
def io6_carried(i: Inputs) -> DataFrame:
    """Two refreshes, the later one run again for its panel alone: its sheet stays."""
    root, now, before = new_path(i, "carried"), dt.date(2024, 12, 1), dt.date(2024, 11, 1)
    panel, sheet = ("data_prep", "panel"), ("pillar_creation", "weights_sheet")
    refresh.commit_tables(root, before, {panel: i.old_panel, sheet: i.sheet.where("weight > 0.5")})
    refresh.commit_tables(root, now, {panel: i.old_panel, sheet: i.sheet})
    refresh.commit_tables(root, now, {panel: i.panel}, carry_over=True)
    return commits.read_table(i.spark, root, *sheet, now).select("category", "pillar", "metric", "weight")


@query("io7_stored_weights", sql("sheet", f"select category, pillar, metric, {r('weight')} from sheet"))
def io7(i: Inputs) -> DataFrame:
    root, month = new_path(i, "stored"), dt.date(2024, 11, 1)
    io.write_stage(i.sheet, root, "pillar_creation", "weights_sheet", month)
    return io.read_stored_weights(i.spark, root, month)


# sales


@query("s1_star_sales", sql("weekly", f"select {WEEK}, {rs((*SUMS, 'acv_num', 'acv_den'))} from weekly"), 4)
def s1(i: Inputs) -> DataFrame:
    return sales.star_sales(*i.star(), MARKET)


@query("s2_acv_ratio", sql("weekly", f"select {WEEK}, {rs(('acv_num', 'acv_den', 'acv_selling_wt'))} from weekly"), 4)
def s2(i: Inputs) -> DataFrame:
    return i.weekly().select(*WEEK.split(", "), "acv_num", "acv_den", "acv_selling_wt")


@query(
    "s3_vendor_rollup",
    sql(
        "weekly",
        f"""select {WEEK}, {rs((*SUMS, "acv_num", "acv_den", "acv_selling_wt"))} from (
        select * from weekly where brand <> 'Vendor#1' union all by name
        select vendor, vendor brand, category, date, sum(acv_num) acv_num, sum(acv_den) acv_den,
        {", ".join(f"sum({c}) {c}" for c in SUMS)} from weekly where vendor = 'Vendor#1'
        group by vendor, category, date)""",
    ),
    4,
)
def s3(i: Inputs) -> DataFrame:
    return sales.vendor_rollup(i.weekly(), ROLLUP)


@query(
    "s4_calendar_parts",
    sql(
        "weekly",
        f"select {WEEK}, {rs(('s_dollars',))}, cast(month(date) as int) as month, cast(year(date) as int) as year from weekly",
    ),
    4,
)
def s4(i: Inputs) -> DataFrame:
    return sales.calendar_parts(i.weekly()).select(*WEEK.split(", "), "s_dollars", "month", "year")


@query(
    "s5_monthly_grain",
    sql(
        "weekly_all",
        """select vendor, brand, category, cast(date_trunc('month', date) as date) date, count(*) n_weeks,
        round(sum(s_units), 4) + 0.0 s_units from weekly_all group by 1, 2, 3, 4""",
    ),
    4,
)
def s5(i: Inputs) -> DataFrame:
    weeks = sales.to_grain(i.weekly(None), "monthly")
    return weeks.groupBy(*sales.WEEK_KEY).agg(F.count("*").alias("n_weeks"), F.sum("s_units").alias("s_units"))


@query(
    "s6_panel_aggregate",
    sql(
        "weekly_all",
        f"""select vendor, brand, category, cast(date_trunc('month', date) as date) date,
        {", ".join(r(f"sum({c})", m, 4) for c, m in zip(SUMS, MEASURES, strict=True))},
        {", ".join(r(f"avg({c})", m, 4) for c, m in zip(SUMS, MEANS, strict=True))},
        {r("avg(acv_selling_wt)", "acv_selling", 4)}
        from weekly_all group by 1, 2, 3, 4""",
    ),
    4,
)
def s6(i: Inputs) -> DataFrame:
    return sales.panel_aggregate(i.weekly(None), "monthly")


@query(
    "s7_monthly_normalise",
    sql(
        "base_sums",
        f"""select {WEEK}, {r("acv_selling", places=4)},
        {", ".join(r(f"{a} * wk", m, 4) for m, a in NORMALISED.items())} from base_sums""",
    ),
    4,
)
def s7(i: Inputs) -> DataFrame:
    panel = sales.monthly_normalise(sales.panel_aggregate(i.weekly(None), "monthly"))
    return sales.drop_means(panel)


@query(
    "s8_round_measures",
    sql("base", f"select {WEEK}, {rs((*MEASURES, 'acv_selling'))} from base"),
    4,
)
def s8(i: Inputs) -> DataFrame:
    panel = sales.monthly_normalise(sales.panel_aggregate(i.weekly(None), "monthly"))
    return sales.drop_means(sales.round_measures(panel))


@query(
    "s9_average_price",
    sql("base", f"select {WEEK}, {rs(('total_sales', 'total_units', 'average_price'))} from base"),
    4,
)
def s9(i: Inputs) -> DataFrame:
    return sales.sales_base(*i.star(), i.spec).select(
        *WEEK.split(", "), "total_sales", "total_units", "average_price"
    )


@query(
    "s10_category_total",
    sql("sales", f"select {WEEK}, {rs(('total_sales', 'category_total_sales'))} from sales"),
    4,
)
def s10(i: Inputs) -> DataFrame:
    return sales.category_total(i.sales_base).select(
        *WEEK.split(", "), "total_sales", "category_total_sales"
    )


@query(
    "s11_market_share",
    sql("sales", f"select {WEEK}, {rs(('total_sales', 'market_share_total_sales'), 6)} from sales"),
)
def s11(i: Inputs) -> DataFrame:
    return sales.sales_shares(i.sales_base).select(
        *WEEK.split(", "), "total_sales", "market_share_total_sales"
    )


@query("s12_sorted_panel", sql("base", f"select {WEEK}, {rs(('total_sales',))} from base order by {WEEK}"), 4)
def s12(i: Inputs) -> DataFrame:
    return sales.sort_panel(i.sales_base).select(*WEEK.split(", "), "total_sales")


@query(
    "s13_iso_dates",
    sql(
        "",
        """select cast(l_shipdate as date) date, count(*) n, round(sum(l_extendedprice), 4) dollars
        from lineitem group by 1""",
    ),
    4,
)
def s13(i: Inputs) -> DataFrame:
    text = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    rows = io.iso_date(i.table("lineitem").withColumn("date", text))
    return rows.groupBy("date").agg(F.count("*").alias("n"), F.sum("l_extendedprice").alias("dollars"))


# harmonised metrics


@query(
    "h1_metric_names",
    sql(
        "events_named",
        f"select brand, category, date, var, {r('metric_value')} from events_named",
    ),
)
def h1(i: Inputs) -> DataFrame:
    return harmonise.metric_names(i.events_long()).select(*PANEL.split(", "), "metric_value")


@query(
    "h2_average_by_metric", sql("events_avg", f"select brand, category, date, var, {r('value')} from events_avg")
)
def h2(i: Inputs) -> DataFrame:
    return harmonise.average_by_metric(harmonise.metric_names(i.events_long()))


@query(
    "h2_pivot_metrics",
    sql(
        "events_avg",
        f"""select brand, category, date, {", ".join(r(v) for v in EVENT_VARS)} from
        (select brand, category, date, {EVENT_PIVOT} from events_avg group by 1, 2, 3)""",
    ),
)
def h2_wide(i: Inputs) -> DataFrame:
    long = harmonise.average_by_metric(harmonise.metric_names(i.events_long()))
    return harmonise.pivot_metrics(long, EVENT_VARS)


@query(
    "h3_add_sales",
    sql(
        "wide sales",
        f"""select brand, category, date, {r("survey_reach_orders_all")}, {r("total_sales")},
        {r("market_share_total_sales")} from wide left join
        sales using (brand, category, date)""",
    ),
)
def h3(i: Inputs) -> DataFrame:
    return harmonise.add_sales(i.panel_wide(), i.sales()).select(
        "brand", "category", "date", "survey_reach_orders_all", "total_sales", "market_share_total_sales"
    )


@query(
    "h4_rename_metrics",
    sql(
        "panel renames",
        f"""select brand, category, date, coalesce(new_name, var) as var, {r("value")}
        from panel left join renames on var = old_name""",
    ),
)
def h4(i: Inputs) -> DataFrame:
    return harmonise.rename_metrics(i.panel, i.renames())


PERCENT = """select brand, category, date, var || '_percentage' as var, value / nullif(reviews, 0) as value
  from panel left join (select brand, category, date, value reviews from panel
    where var = 'ratings_reviews_review_count') using (brand, category, date)
  where regexp_matches(var, '^ratings_.*_count$|^ratings_reviews_[1-5]_star_ratings$')"""
INVERSE = """select brand, category, date, new_name as var, cast(vals as double) - value as value
  from panel join rules on operation = 'sub' and raw_cols = var
  union all select brand, category, date, new_name, coalesce(sum(value), 0) from panel
  join (select unnest(string_split(vals, '+')) as var, new_name from rules where operation = 'add')
  using (var) group by all"""
SHARES = """select brand, category, date, var || '_share' as var,
  value / nullif(sum(value) over (partition by date, category, var), 0) as value
  from panel where var in ('search_searchvolume', 'ratings_reviews_review_count')"""


def stacked(part: str) -> str:
    return f"select {PANEL}, {r('value')} from (select * from panel union all {part})"


@query("h5_percentage_metrics", sql("panel", stacked(PERCENT)))
def h5(i: Inputs) -> DataFrame:
    return harmonise.percentage_metrics(i.panel)


@query("h6_inverse_metrics", sql("panel rules", stacked(INVERSE)))
def h6(i: Inputs) -> DataFrame:
    return harmonise.inverse_metrics(i.panel, i.rules())


@query("h7_share_metrics", sql("panel", stacked(SHARES)))
def h7(i: Inputs) -> DataFrame:
    return harmonise.share_metrics(i.panel)


@query(
    "h8_move_categories",
    sql(
        "panel moves",
        f"""select brand, coalesce(to_category, category) category, date, var, {r("value")}
        from panel left join moves using (brand, category)""",
    ),
)
def h8(i: Inputs) -> DataFrame:
    return harmonise.move_categories(i.panel, i.moves())


@query(
    "h9_lower_columns",
    sql("", "select p_brand, p_type, count(*) n_parts from part group by 1, 2"),
)
def h9(i: Inputs) -> DataFrame:
    parts = i.table("part").groupBy("P_BRAND", "P_TYPE").agg(F.count("*").alias("N_PARTS"))
    return io.lower_columns(parts.withColumnsRenamed({"p_brand": "P_Brand", "p_type": "P_Type"}))
