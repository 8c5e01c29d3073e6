"""Building blocks of the check SQL: the derived tables as text, for an independent engine."""

from __future__ import annotations

from equitrace.catalog.inputs import (
    CATEGORIES,
    DASHBOARD,
    EVENT_VARS,
    INVERSES,
    METRICS,
    MOVES,
    NOT_SELECTED,
    OUT_OF_SCOPE,
    PANEL_VARS,
    PARENTS,
    RENAMES,
)


def lit(v) -> str:
    if v is None:
        return "null"
    return str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"


def values(rows, names: str) -> str:
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"select * from (values {body}) t({names})"


def r(expr: str, name: str | None = None, places: int = 6) -> str:
    return f"{up(expr, places)} + 0.0 as {name or expr}"


def up(expr: str, places: int) -> str:
    """Half-up rounding on a decimal, free of float noise."""
    return f"cast(round(cast({expr} as decimal(38, {places + 3})), {places}) as double)"


def even(expr: str, places: int) -> str:
    """Half-even rounding on a decimal, free of float noise."""
    return f"cast(round_even(cast(round({expr}, 9) as decimal(38, 9)), {places}) as double)"


def corr(x: str, y: str) -> str:
    sd = (
        f"stddev_pop(case when {y} is not null then {x} end) * "
        f"stddev_pop(case when {x} is not null then {y} end)"
    )
    return f"case when {sd} > 1e-12 then covar_pop({y}, {x}) / ({sd}) end"


WEEK = "(cast(l_shipdate as date) + cast(6 - dayofweek(l_shipdate) as int))"
MEASURES = """
  round(sum(l_extendedprice), 4) s_dollars,
  round(sum(l_extendedprice * (1 - l_discount)), 4) s_base_dollars,
  round(sum(l_quantity * p_size), 4) s_pounds,
  round(sum(l_quantity * p_size * (1 - l_tax)), 4) s_base_pounds,
  round(sum(l_discount * 1000 * l_extendedprice), 4) acv_num,
  round(sum(l_extendedprice), 4) acv_den,
  round(sum(l_quantity), 4) s_units,
  round(sum(l_quantity * (1 - l_tax)), 4) s_base_units"""
CELL = f"""
  cast(count(distinct o_custkey) as double) survey_reach_customers_all,
  cast(count(*) as double) survey_reach_lines_all,
  cast(count(distinct l_orderkey) as double) survey_reach_orders_all,
  {up("avg(case when c_mktsegment = 'BUILDING' then 1.0::double else 0 end)", 6)} panel_segment_share_net,
  {up("avg(case when o_orderstatus = 'F' then 1.0::double else 0 end)", 6)} panel_status_share_all,
  {up("avg(o_totalprice)", 6)} panel_order_value_mean,
  {up("avg(case when l_returnflag <> 'R' then 1.0::double else 0 end)", 6)} directions_kept_share_all,
  {up("sum(case when l_returnflag = 'R' then 0 else l_quantity end) / sum(l_quantity)", 6)} directions_kept_quantity_share,
  {up("avg(case when o_orderpriority = '1-URGENT' then 1.0::double else 0 end)", 6)} directions_urgent_mean,
  {up("avg(l_quantity)", 6)} directions_quantity_mean,
  {up("avg(l_quantity * (1 - l_discount))", 6)} directions_net_quantity_mean,
  {up("avg(l_discount)", 6)} brandtone_discount_mean,
  {up("avg(l_extendedprice / l_quantity)", 6)} brandtone_price_mean,
  {up("avg(l_extendedprice)", 6)} brandtone_revenue_mean,
  {up("avg(l_tax) filter (l_returnflag = 'R' and l_quantity > 20)", 6)} + 0.0 ratings_tax_returned_mean,
  {up("avg(case when l_returnflag = 'R' then 1.0::double else 0 end)", 6)} ratings_returned_rank_1st,
  {up("sum(case when l_returnflag = 'R' then l_quantity else 0 end) / sum(l_quantity)", 6)} ratings_returned_quantity_share,
  {up("avg(l_tax) filter (l_returnflag = 'R' and l_quantity >= 45)", 6)} + 0.0 ratings_sparse_mean,
  cast(count(*) as double) ratings_reviews_review_count,
  sum(l_quantity) search_searchvolume,
  cast(count(*) filter (l_quantity > 0 and l_quantity <= 10) as double) ratings_reviews_1_star_ratings,
  cast(count(*) filter (l_quantity > 10 and l_quantity <= 20) as double) ratings_reviews_2_star_ratings,
  cast(count(*) filter (l_quantity > 20 and l_quantity <= 30) as double) ratings_reviews_3_star_ratings,
  cast(count(*) filter (l_quantity > 30 and l_quantity <= 40) as double) ratings_reviews_4_star_ratings,
  cast(count(*) filter (l_quantity > 40 and l_quantity <= 50) as double) ratings_reviews_5_star_ratings"""


def _weekly(market: bool) -> str:
    joins = (
        "join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey "
        "join region on n_regionkey = r_regionkey and r_name = 'AMERICA'"
        if market
        else ""
    )
    return f"""select *, acv_num / nullif(acv_den, 0) acv_selling_wt from (
      select 'Vendor#' || right(p_brand, 1) vendor, p_brand brand, p_type category, {WEEK} date, {MEASURES}
      from lineitem join part on l_partkey = p_partkey {joins} group by 1, 2, 3, 4)"""


def _wide() -> str:
    return f"""select p_brand brand, p_type category, cast(date_trunc('month', l_shipdate) as date) date, {CELL}
      from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey
      join customer on o_custkey = c_custkey group by 1, 2, 3"""


def _long(wide: str) -> str:
    return (
        f"select brand, category, date, var, value from {wide} "
        f"unpivot include nulls (value for var in ({', '.join(PANEL_VARS)}))"
    )


def _scaled(expr: str) -> str:
    return f"""select scope, brand, category, date, new_brand, var, {expr} as value
      from lev join lstat using (scope, new_brand, category, var)
      where nn >= greatest(1, (n * (100 - case when category = 'PROMO' then 90 else 50 end)) // 100)"""


NORM = "replace(replace(lower({0}), ' - ', '_'), ' ', '_')"
BY_PILLAR = """join (select distinct category, pillar, var from dict
      where select_flag = 'Y' and pillar is not null) using (category, var)"""

# name: (tables it reads, text)
CTES: dict[str, tuple[str, str]] = {
    "weekly": ("", _weekly(True)),
    "weekly_all": ("", _weekly(False)),
    "base_sums": (
        "weekly_all",
        """select vendor, brand, category, cast(date_trunc('month', date) as date) date,
          avg(s_dollars) a_dollars, avg(s_base_dollars) a_base_dollars, avg(s_pounds) a_pounds,
          avg(s_base_pounds) a_base_pounds, avg(s_units) a_units, avg(s_base_units) a_base_units,
          avg(acv_selling_wt) acv_selling, cast(day(last_day(date_trunc('month', min(date)))) as double) / 7 wk
          from weekly_all group by 1, 2, 3, 4""",
    ),
    "base": (
        "base_sums",
        f"""select *, total_sales / nullif(total_units, 0) average_price from (
          select vendor, brand, category, date, {even("a_dollars * wk", 0)} total_sales,
          a_base_dollars * wk s_base_dollars, {even("a_pounds * wk", 0)} eq_volume,
          a_base_pounds * wk s_base_pounds, {even("acv_selling", 2)} acv_selling,
          {even("a_units * wk", 0)} total_units, a_base_units * wk s_base_units from base_sums)""",
    ),
    "sales": (
        "base",
        """select *, total_sales / nullif(category_total_sales, 0) market_share_total_sales from (
          select *, sum(total_sales) over (partition by date, category) category_total_sales from base)""",
    ),
    "dv": ("sales", "select brand, category, date, market_share_total_sales dv from sales"),
    "wide": ("", _wide()),
    "panel": ("wide", _long("wide")),
    "old_panel": (
        "panel",
        f"""select * exclude (step) replace ({up("case when step = 7 then 0.0 * value else value * (1 + (step - 3) / 25.0::double) end", 6)}
          + 0.0 as value) from (select *, (month(date) + year(date) + length(var) + length(category)) % 8 as step
          from panel where month(date) <> 7)""",
    ),
    "events_long": (
        "",
        f"""select 'Brand#' || cast(user_id % 25 + 1 as varchar) brand,
          list_extract({list(CATEGORIES)}, cast(user_id % 6 + 1 as int)) category, cast(ts as date) date,
          'Web Panel' data_source, event_type metric_type,
          case when event_id % 2 = 0 then 'avg value' else 'Net Value' end metric_name,
          case when event_id % 2 = 0 then 'all users' end user_segment, value metric_value from events""",
    ),
    "events_named": (
        "events_long",
        """select *, replace(lower(concat_ws('_', data_source, metric_type, metric_name, user_segment)),
          ' ', '_') var from events_long""",
    ),
    "events_avg": (
        "events_named",
        "select brand, category, date, var, avg(metric_value) value from events_named group by 1, 2, 3, 4",
    ),
    "dict": (
        "",
        f"""select category, var, replace(var, '_', ' ') metric_name, split_part(var, '_', 1) data_source,
          'group ' || split_part(var, '_', 1) vendor_group, pillar,
          case when category = {lit(NOT_SELECTED[0])} and var = {lit(NOT_SELECTED[1])} then 'N'
            else select_flag end select_flag,
          cast(lo as double) lo, cast(hi as double) hi, expected_sign
          from ({values(METRICS, "var, pillar, select_flag, lo, hi, expected_sign")})
          cross join ({values([(c,) for c in CATEGORIES], "category")})""",
    ),
    "brand_list": (
        "",
        f"""select distinct p_brand brand, p_type category from part
          where p_brand not in ({", ".join(lit(b) for b in OUT_OF_SCOPE)})""",
    ),
    "renames": ("", values(RENAMES, "old_name, new_name")),
    "rules": ("", values(INVERSES, "operation, raw_cols, vals, new_name")),
    "moves": ("", values(MOVES, "brand, category, to_category")),
    "parents": ("", values(PARENTS, "category_new, parent")),
    "dashboard": ("", values(DASHBOARD, "var, new_name")),
    "prices": (
        "",
        """select p_brand brand, p_type category, case when max(p_size) = 50 then 'Premium'
          when max(p_size) = 49 then '#NA' else 'Mainstream' end price_class
          from part where p_brand <> 'Brand#1' group by 1, 2""",
    ),
    "joined": (
        "panel old_panel",
        """select brand, category, date, var, o.value value_old, p.value value_new
          from old_panel o join panel p using (brand, category, date, var)
          where date >= (select greatest((select min(date) from old_panel), (select min(date) from panel)))
          and date <= (select least((select max(date) from old_panel), (select max(date) from panel)))""",
    ),
    "compared": (
        "joined",
        """select *, (value_new - value_old) / nullif(value_old, 0) * 100 difference_pct,
          coalesce(value_old = 0 and value_new <> 0, false) from_zero from joined""",
    ),
    "mean_diff": (
        "compared",
        """select brand, category, var, date, value_new, value_old, from_zero,
          avg(difference_pct) avg_difference_pct from compared
          where value_new is not null and value_old is not null group by all""",
    ),
    "tagged": (
        "mean_diff dict brand_list",
        """select m.*, coalesce(d.select_flag, 'N') idv_list,
          case when b.brand is null then 'N' else 'Y' end brand_list from mean_diff m
          left join (select * from dict where select_flag = 'Y') d using (category, var)
          left join brand_list b on b.brand = m.brand and b.category = m.category""",
    ),
    "scoped": (
        "tagged",
        """select *, brand || ' ' || split_part(category, ' ', 1) as label from tagged
          where idv_list = 'Y' and brand_list = 'Y'""",
    ),
    "flagged": (
        "scoped",
        "select * from scoped where coalesce(abs(avg_difference_pct) > 5, false) or from_zero",
    ),
    "sel": (
        "panel dict brand_list",
        """select brand, category, date, var, value, lo, hi from panel
          join (select * from dict where select_flag = 'Y') d using (category, var)
          semi join brand_list using (brand, category)""",
    ),
    "capped": (
        "sel",
        """select brand, category, date, var, lo, hi, case when value is not null then
          least(greatest(value, lo), hi) end value from sel""",
    ),
    "lev": (
        "capped",
        """select 'brand' scope, brand new_brand, * from capped
          union all select 'category', 'Stacked Brand', * from capped""",
    ),
    "lstat": (
        "lev",
        """select scope, new_brand, category, var, count(*) n, count(value) nn, avg(value) mean,
          min(value) low, max(value) high, stddev_pop(value) std from lev group by 1, 2, 3, 4""",
    ),
    "scaled": ("lev lstat", _scaled("(coalesce(value, mean) - lo) / nullif(hi - lo, 0)")),
    "modelling": ("scaled dv", "select s.*, dv from scaled s left join dv using (brand, category, date)"),
    "pool_vars": (
        "scaled",
        "select category, var from scaled where scope = 'category' group by 1, 2 having count(value) > 0",
    ),
    "brand_rows": (
        "modelling pool_vars dict",
        f"""select brand, category, date, var, value, dv, pillar from modelling
          semi join pool_vars using (category, var) {BY_PILLAR} where scope = 'brand'""",
    ),
    "pool_rows": (
        "modelling dict",
        f"""select brand, category, date, var, value, dv, pillar from modelling
          {BY_PILLAR} where scope = 'category'""",
    ),
    "sizes": (
        "brand_rows",
        """select brand, category, pillar, count(distinct date) n_rows, count(distinct var) n_metrics,
          sum(dv) filter (rn = 1) dv_sum from (select *, row_number() over
          (partition by brand, category, pillar, date order by var) rn from brand_rows) group by 1, 2, 3""",
    ),
    "eligibility": (
        "sizes",
        """select *, case when coalesce(dv_sum, 0) <= 0 then 'no sales' when n_rows <= 20 then 'too few rows'
          when n_metrics < 2 then 'too few metrics' else 'ok' end status from sizes""",
    ),
    "drawn": (
        "brand_rows eligibility",
        """select *, case when rn > 6 then ntile(4) over (partition by brand, category, pillar, rn <= 6 order by rn) end fold
          from (select *, row_number() over (partition by brand, category, pillar order by
          md5(concat_ws('~', brand, category, cast(date as varchar), '2'))) rn
          from (select distinct brand, category, pillar, date from brand_rows
          semi join (select * from eligibility where status = 'ok') using (brand, category, pillar)))""",
    ),
    "samples": (
        "brand_rows drawn",
        """select b.*, rn, case when rn <= 6 then 'holdout' else 'train' end split, fold
          from brand_rows b join drawn using (brand, category, pillar, date)""",
    ),
    "attributions": (
        "brand_rows",
        f"""select * from (select brand, category, pillar, var, {up(f"abs({corr('value', 'dv')})", 6)} attribution
          from brand_rows group by 1, 2, 3, 4) where attribution is not null""",
    ),
    "pooled_corr": (
        "pool_rows",
        f"""select * from (select pillar, var, {up(corr("value", "dv"), 6)} est_std
          from pool_rows group by 1, 2) where est_std is not null""",
    ),
    "category_corr": (
        "pool_rows",
        f"""select * from (select category, pillar, var, {up(corr("value", "dv"), 6)} est_std
          from pool_rows group by 1, 2, 3) where est_std is not null""",
    ),
    "dv_year": (
        "dv",
        """select * from dv where dv is not null
          and date between cast('2001-06-30' as date) - interval 12 month and cast('2001-06-30' as date)""",
    ),
    "dv_sums": (
        "dv_year",
        """select *, sum(brand_mean) over (partition by category) category_sum from
          (select category, brand, avg(dv) brand_mean from dv_year group by 1, 2)""",
    ),
    "weighted": (
        "attributions dv_sums",
        """select a.brand, a.category, a.pillar || '_pillar' pillar, a.var, a.attribution, brand_mean, category_sum,
          a.attribution * brand_mean / nullif(category_sum, 0) weighted
          from attributions a left join dv_sums using (brand, category)""",
    ),
    "attr_cat": (
        "weighted",
        "select category, pillar, var, avg(weighted) attribution from weighted group by 1, 2, 3",
    ),
    "attr_all": ("attr_cat", "select pillar, var, avg(attribution) attribution from attr_cat group by 1, 2"),
    "load_all": (
        "pooled_corr",
        "select pillar || '_pillar' pillar, var, est_std from pooled_corr where pillar <> 'advocacy'",
    ),
    "load_cat": (
        "category_corr",
        """select category, pillar || '_pillar' pillar, var, est_std from category_corr
          where pillar <> 'advocacy'""",
    ),
    "merged_cat": (
        "attr_cat load_cat",
        """select * from attr_cat full join load_cat using (category, pillar, var)
          where pillar in ('brand_perceptions_pillar', 'product_feedback_pillar')""",
    ),
    "merged_all": (
        "attr_all load_all",
        """select * from attr_all full join load_all using (pillar, var) where pillar in
          ('awareness_pillar', 'loyalty_pillar', 'advocacy_pillar', 'consideration_pillar')""",
    ),
    "weights_cat": (
        "merged_cat",
        """select *, coalesce((sl + sa) / 2, sl, sa) weight from (select *,
          abs(attribution) / nullif(sum(abs(attribution)) over (partition by category, pillar), 0) sa,
          abs(est_std) / nullif(sum(abs(est_std)) over (partition by category, pillar), 0) sl
          from merged_cat)""",
    ),
    "weights_all": (
        "merged_all",
        """select *, coalesce((sl + sa) / 2, sl, sa) weight from (select *,
          abs(attribution) / nullif(sum(abs(attribution)) over (partition by pillar), 0) sa,
          abs(est_std) / nullif(sum(abs(est_std)) over (partition by pillar), 0) sl from merged_all)""",
    ),
    "weights_equal": (
        "weights_all",
        """select pillar, var, case when pillar = 'awareness_pillar'
          then 1.0::double / count(*) over (partition by pillar) else weight end weight from weights_all""",
    ),
    "sheet": (
        "weights_cat weights_equal",
        f"""select category, pillar, var metric, weight from weights_cat union all
          select category, pillar, var, weight from weights_equal
          cross join ({values([(c,) for c in CATEGORIES], "category")})""",
    ),
    "pooled": ("scaled", "select brand, category, date, var, value from scaled where scope = 'category'"),
    "scores": (
        "pooled sheet",
        """select f.brand, f.category, f.date, p.pillar, coalesce(s.score, 0) score
          from (select distinct brand, category, date from pooled) f
          join (select distinct category, pillar from sheet) p using (category)
          left join (select brand, category, date, pillar, sum(weight * coalesce(value, 0)) score
            from pooled join sheet on sheet.category = pooled.category and metric = var
            group by 1, 2, 3, 4) s using (brand, category, date, pillar)""".replace(
            "select brand, category, date, pillar, sum", "select brand, pooled.category, date, pillar, sum"
        ),
    ),
    "index": (
        "pooled scores dict",
        """select brand, category, date, var, value, coalesce(pillar, var) equity_pillar from (
          select * from pooled union all select brand, category, date, pillar, score from scores)
          left join (select distinct category, var, pillar from dict where pillar is not null)
          using (category, var)""",
    ),
    "trended": (
        "scores",
        """select *, lead(trend_past) over (partition by brand, category, pillar order by date) trend_past_future
          from (select *, case when count(score) over w = 3 then avg(score) over w end trend_past from scores
          window w as (partition by brand, category, pillar order by date rows between 2 preceding and current row))""",
    ),
    "features": (
        "trended",
        """select brand, category, date, pillar as var, score as value from trended
          union all select brand, category, date, pillar || '_trend_past', trend_past from trended
          union all select brand, category, date, pillar || '_trend_past_future', trend_past_future from trended""",
    ),
    "scored": (
        "index",
        """select brand, category, date, var, value, equity_pillar,
          (value - avg(value) over (partition by date, category, var)) * 100 + 100 score from index""",
    ),
    "contrib": (
        "index sheet",
        """select i.*, weight, value * weight metric_contribution from index i left join
          (select category, metric as var, replace(pillar, '_pillar', '') equity_pillar, weight from sheet)
          using (category, var, equity_pillar)""",
    ),
    "hub": (
        "contrib scored",
        """select c.*, avg(metric_contribution) over (partition by date, category, var) category_mc_avg,
          metric_contribution - avg(metric_contribution) over (partition by date, category, var) mc_diff_to_catg_avg,
          equity_pillar like '%\\_pillar' escape '\\' is_pillar, s.score scaled_values,
          year(date) as year, month(date) as month
          from contrib c left join (select brand, category, date, var, score from scored) s
          using (brand, category, date, var)""",
    ),
    "named": (
        "hub panel prices dashboard",
        """select brand, category, price_class, equity_pillar,
          case when is_pillar then 'Pillar' else 'Metric' end metric_type,
          coalesce(d.new_name, case h.var when 'brand_perceptions_pillar' then 'Brand Perceptions'
            when 'loyalty_pillar' then 'Loyalty' when 'advocacy_pillar' then 'Advocacy'
            when 'awareness_pillar' then 'Awareness' when 'consideration_pillar' then 'Consideration'
            when 'product_feedback_pillar' then 'Product Feedback' else h.var end) metric_name,
          date, p.value metric_raw_value, weight, scaled_values scaled_scores
          from hub h left join (select brand, category, date, var, value from panel) p
            using (brand, category, date, var)
          left join prices using (brand, category) left join dashboard d on d.var = h.var""",
    ),
    "summary": (
        "named",
        f"""select brand, category, price_class,
          array_to_string(list_transform(string_split(replace(replace(equity_pillar, '_pillar', ''), '_', ' '), ' '),
            lambda w: upper(w[1]) || lower(w[2:])), ' ') equity_pillar, metric_type, metric_name, date,
          {even("metric_raw_value", 5)} metric_raw_value, {even("weight", 5)} weight,
          {even("scaled_scores", 2)} scaled_scores
          from named where not (weight is null and metric_type = 'Metric')""",
    ),
}

EVENT_PIVOT = ", ".join(f"avg(value) filter (var = '{v}') {v}" for v in EVENT_VARS)


def query(needs: str, select: str) -> str:
    """A statement with every table it needs, in reading order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0].split():
            visit(dep)
        order.append(name)

    for n in needs.split():
        visit(n)
    if not order:
        return select
    body = ",\n".join(f"{n} as materialized ({CTES[n][1]})" for n in order)
    return f"with {body}\n{select}"
