"""Queries on learning data sets, driver models and factor models."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitrace.catalog.inputs import METRICS, Inputs
from equitrace.catalog.oracle import NORM, corr, r
from equitrace.catalog.oracle import query as sql
from equitrace.catalog.registry import query
from equitrace.functions.grouping import PANEL_KEY, seeded_sample
from equitrace.operators import drivers, factor, forests, stats
from equitrace.plans import refresh
from equitrace.sources.workspace import stage
from equitrace.spec import BOOSTED, FOREST, PILLARS_POOLED

PANEL = "brand, category, date, var"
POOLED = "(" + ", ".join(f"'{p}'" for p in PILLARS_POOLED) + ")"
KEY = "brand, category, pillar"
SERIES_VAR = ["brand", "category", "var"]
MODEL_VAR = ["brand", "category", "pillar", "var"]
FEATURES = {
    p: [m[0] for m in METRICS if m[1] == p and m[2] == "Y"]
    for p in dict.fromkeys(m[1] for m in METRICS if m[1])
}


@query(
    "t1_name_pattern",
    sql("panel", f"select {PANEL}, {r('value')} from panel where var not like '%\\_mean%' escape '\\' and var not like '%\\_rank\\_1st%' escape '\\'"),
)
def t1(i: Inputs) -> DataFrame:
    return stats.without_pattern(i.panel, "_mean", "_rank_1st")


@query(
    "t2_clean_names",
    sql(
        "events_long",
        f"""select {NORM.format("concat_ws(' - ', data_source, metric_type, metric_name, user_segment)")} as var,
        count(*) n, {r("sum(metric_value)", "value")} from events_long group by 1""",
    ),
)
def t2(i: Inputs) -> DataFrame:
    parts = F.concat_ws(" - ", "data_source", "metric_type", "metric_name", "user_segment")
    rows = stats.normalise_names(i.events_long().withColumn("var", parts))
    return rows.groupBy("var").agg(F.count("*").alias("n"), F.sum("metric_value").alias("value"))


@query(
    "t3_pillar_metrics",
    sql(
        "modelling dict",
        f"""select scope, brand, category, date, pillar, var, {r("value")} from modelling
        join (select distinct category, pillar, var from dict where select_flag = 'Y' and pillar is not null)
        using (category, var)""",
    ),
)
def t3(i: Inputs) -> DataFrame:
    rows = stats.by_pillar(i.scaled, i.dictionary())
    return rows.select("scope", *PANEL_KEY, "pillar", "var", "value")


@query(
    "t3_forced_metrics",
    sql(
        "panel dict",
        f"""select brand, category, date, pillar, var, {r("value")} from panel
        join (select distinct category, pillar, var from dict where pillar is not null
        and var in ('brandtone_price_mean', 'panel_segment_share_net')) using (category, var)""",
    ),
)
def t3_forced(i: Inputs) -> DataFrame:
    forced = ("brandtone_price_mean", "panel_segment_share_net")
    return stats.by_pillar(i.panel, i.dictionary(), forced).select(*PANEL_KEY, "pillar", "var", "value")


@query(
    "t4_present_in_pool",
    sql(
        "scaled pool_vars",
        f"select {PANEL}, {r('value')} from scaled semi join pool_vars using (category, var) where scope = 'brand'",
    ),
)
def t4(i: Inputs) -> DataFrame:
    return stats.present_in_pool(i.scaled).select(*PANEL_KEY, "var", "value")


@query("t5_eligibility", sql("eligibility", f"select {KEY}, n_rows, n_metrics, {r('dv_sum')}, status from eligibility"))
def t5(i: Inputs) -> DataFrame:
    return stats.eligibility(i.brand_rows(), i.spec, drivers.MODEL_KEY)


NULLS = """select *, count(*) over w n, count(*) filter (value is null) over w nulls, avg(value) over w mean
  from panel window w as (partition by brand, category, var)"""


@query(
    "t6_drop_and_fill",
    sql("panel", f"select {PANEL}, {r('coalesce(value, mean)', 'value')} from ({NULLS}) where nulls < n * 0.5"),
)
def t6(i: Inputs) -> DataFrame:
    return stats.drop_and_fill(i.panel)


@query(
    "t7_drop_log",
    sql(
        "panel",
        """select brand, category, var, count(*) n, count(*) filter (value is null) nulls,
        case when contains(var, '_mean') then 'mean column' when contains(var, '_rank_1st') then 'Rank column'
        when count(*) filter (value is null) >= count(*) * 0.5 then '> 50 % null' end reason
        from panel group by 1, 2, 3""",
    ),
)
def t7(i: Inputs) -> DataFrame:
    return stats.drop_log(i.panel, drop_means=True, drop_ranks=True)


@query("t8_log_dv", sql("dv", f"select brand, category, date, {r('ln(1 + dv)', 'dv')} from dv"))
def t8(i: Inputs) -> DataFrame:
    return stats.log_dv(i.dv)


@query(
    "t9_trim_start",
    sql(
        "panel",
        f"""select {PANEL}, {r("value")} from (select *, row_number() over
        (partition by brand, category, var order by date) rn from panel) where rn > 3""",
    ),
)
def t9(i: Inputs) -> DataFrame:
    return stats.trim_start(i.panel)


@query(
    "t10_time_split",
    sql(
        "dv",
        f"""select brand, category, date, {r("dv")}, case when up <= 42 then 'train' else 'holdout' end first_rows,
        case when down > 6 then 'train' else 'holdout' end last_rows from (select *,
        row_number() over (partition by brand, category order by date) up,
        row_number() over (partition by brand, category order by date desc) down from dv)""",
    ),
)
def t10(i: Inputs) -> DataFrame:
    keys = ["brand", "category"]
    first = stats.split_by_time(i.dv, keys, i.spec.train_rows).withColumnRenamed("split", "first_rows")
    return stats.split_by_time(first, keys).withColumnRenamed("split", "last_rows")


@query("t11_random_holdout", sql("samples", f"select {PANEL}, pillar, split from samples"))
def t11(i: Inputs) -> DataFrame:
    return i.model_rows.select(*PANEL_KEY, "var", "pillar", "split")


@query(
    "t12_seeded_sample",
    sql(
        "pooled",
        f"""select category, seed, brand, date, row_number() over (partition by seed, category order by
        md5(concat_ws('~', brand, category, cast(date as varchar), cast(seed as varchar))))
        <= (count(*) over (partition by seed, category)) * 95 // 100 taken
        from (select distinct brand, category, date from pooled),
        (select unnest([2, 3, 5, 7, 11, 13, 17, 19]) seed)""",
    ),
)
def t12(i: Inputs) -> DataFrame:
    return seeded_sample(
        i.pooled(), PANEL_KEY, i.spec.sample_pct, i.spec.sample_seeds, ["category"]
    )


@query(
    "t12_pooled_sample",
    sql(
        "pooled",
        """select seed, brand, category, date, row_number() over (partition by seed order by
        md5(concat_ws('~', brand, category, cast(date as varchar), cast(seed as varchar))))
        <= (count(*) over (partition by seed)) * 95 // 100 taken
        from (select distinct brand, category, date from pooled),
        (select unnest([2, 3, 5, 7, 11, 13, 17, 19]) seed)""",
    ),
)
def t12_pooled(i: Inputs) -> DataFrame:
    return seeded_sample(i.pooled(), PANEL_KEY, i.spec.sample_pct, i.spec.sample_seeds)


@query("t13_folds", sql("samples", f"select {PANEL}, pillar, split, cast(fold as int) fold from samples"))
def t13(i: Inputs) -> DataFrame:
    return i.model_rows.select(*PANEL_KEY, "var", "pillar", "split", "fold")


CORR = f"select brand, category, var, {corr('value', 'dv')} corr from brand_rows group by 1, 2, 3"


@query("t14_dv_correlation", sql("brand_rows", f"select brand, category, var, {r('corr')}, {r('abs(corr)', 'corr_abs')} from ({CORR})"))
def t14(i: Inputs) -> DataFrame:
    return stats.dv_correlation(i.brand_rows())


@query(
    "t15_correlation_pairs",
    sql(
        "pool_rows dv",
        f"""with m as (select brand, category, date, var, value from pool_rows
          union all select brand, category, date, 'dv', dv from dv semi join pool_rows using (brand, category))
        select brand, category, variable_1, variable_2, {r("corr")} from (
        select a.brand, a.category, a.var variable_1, b.var variable_2, {corr("a.value", "b.value")} corr
        from m a join m b on a.brand = b.brand and a.category = b.category and a.date = b.date and a.var <> b.var
        group by 1, 2, 3, 4)""",
    ).replace("with m as (select brand, category, date, var, value from pool_rows", ", m as (select brand, category, date, var, value from pool_rows"),
)
def t15(i: Inputs) -> DataFrame:
    rows = i.pool_rows().select(*PANEL_KEY, "var", "value")
    dv = i.dv.join(i.brand_list(), ["brand", "category"], "left_semi")
    both = rows.unionByName(dv.select(*PANEL_KEY, F.lit("dv").alias("var"), F.col("dv").alias("value")))
    return stats.correlation_pairs(both)


@query(
    "t16_counter_intuitive",
    sql(
        "brand_rows dict",
        f"""select brand, category, var, {r("corr")}, expected_sign from ({CORR})
        join (select distinct category, var, expected_sign from dict) using (category, var)
        where not coalesce((expected_sign = 'P' and corr < -0.3) or (expected_sign = 'N' and corr > 0.3), false)""",
    ),
)
def t16(i: Inputs) -> DataFrame:
    found = stats.dv_correlation(i.brand_rows())
    kept = stats.drop_counter_intuitive(found, i.dictionary(), i.spec.counter_intuitive_cutoff)
    return kept.drop("corr_abs")


@query(
    "t16_counter_intuitive_low",
    sql(
        "brand_rows dict",
        f"""select brand, category, var, {r("corr")}, expected_sign from ({CORR})
        join (select distinct category, var, expected_sign from dict) using (category, var)
        where not coalesce((expected_sign = 'P' and corr < -0.1) or (expected_sign = 'N' and corr > 0.1), false)""",
    ),
)
def t16_low(i: Inputs) -> DataFrame:
    """A lower cut-off, which drops more of this panel's weak correlations."""
    kept = stats.drop_counter_intuitive(stats.dv_correlation(i.brand_rows()), i.dictionary(), 0.1)
    return kept.drop("corr_abs")


@query(
    "t17_select_by_correlation",
    sql("brand_rows", f"select brand, category, var, {r('corr')}, {r('abs(corr)', 'corr_abs')} from ({CORR}) where abs(corr) > 0.4"),
)
def t17(i: Inputs) -> DataFrame:
    return stats.select_by_correlation(stats.dv_correlation(i.brand_rows()), i.spec.correlation_cutoff)


@query(
    "t18_top_features",
    sql(
        "attributions",
        f"""select brand, category, var, {r("attribution")}, rank from (select *, cast(row_number() over
        (partition by brand, category order by attribution desc, var) as int) rank from attributions) where rank <= 20""",
    ),
)
def t18(i: Inputs) -> DataFrame:
    top = stats.top_features(i.attributions, ["brand", "category"], i.spec.top_features, "attribution")
    return top.drop("pillar")


@query("t19_principal_components")
def t19(i: Inputs) -> DataFrame:
    """Components of all selected metrics of the pooled panel, gaps at the metric's mean."""
    names = [n for metrics in FEATURES.values() for n in metrics]
    wide = i.pooled().groupBy(*PANEL_KEY).pivot("var", names).agg(F.max("value"))
    means = wide.agg(*[F.avg(n).alias(n) for n in names]).first().asDict()
    wide = wide.fillna({n: m for n, m in means.items() if m is not None}).fillna(0.0, names)
    out = stats.principal_components(wide, names)
    return out.select(*PANEL_KEY, F.posexplode(vector_to_array("components")).alias("component", "value"))


# a one-metric regression per key stands for a fitted model in the checks of its reports

SLOPE = """select brand, category, pillar, var, date, split, fold, dv, value,
  coalesce(slope, 0) * (value - mx) + my predicted from samples join (
  select brand, category, pillar, var, covar_pop(dv, value) / nullif(var_pop(value), 0) slope, avg(value) mx, avg(dv) my
  from samples where split = 'train' group by 1, 2, 3, 4) using (brand, category, pillar, var)"""
FIT = f"""count(*) n, {r("1 - avg((dv - predicted) * (dv - predicted)) / nullif(var_pop(dv), 0)", "r2")},
  {r("avg(abs(dv - predicted))", "mae")}, {r("avg((dv - predicted) * (dv - predicted))", "mse")},
  {r("sqrt(avg((dv - predicted) * (dv - predicted)))", "rmse")},
  {r("avg(abs(dv - predicted) / greatest(abs(dv), 2.220446049250313e-16))", "mape")}"""


def single_metric_predictions(i: Inputs) -> DataFrame:
    """Least-squares line of the sales share on each metric alone, fitted on the training rows."""
    rows = i.model_rows
    slope = F.coalesce(F.try_divide(F.covar_pop("dv", "value"), F.var_pop("value")), F.lit(0.0))
    lines = (
        rows.where(F.col("split") == "train")
        .groupBy(*MODEL_VAR)
        .agg(slope.alias("slope"), F.avg("value").alias("mx"), F.avg("dv").alias("my"))
    )
    predicted = F.col("slope") * (F.col("value") - F.col("mx")) + F.col("my")
    return rows.join(lines, MODEL_VAR).withColumn("predicted", predicted)


@query(
    "t20_regression_metrics",
    sql("samples", f"select {KEY}, var, split, {FIT} from ({SLOPE}) where dv is not null group by 1, 2, 3, 4, 5"),
)
def t20(i: Inputs) -> DataFrame:
    return stats.regression_metrics(single_metric_predictions(i), [*MODEL_VAR, "split"])


@query(
    "t21_actual_vs_predicted",
    sql("samples", f"select {KEY}, var, date, {r('dv', 'actual')}, {r('predicted')} from ({SLOPE})"),
)
def t21(i: Inputs) -> DataFrame:
    return stats.actual_vs_predicted(single_metric_predictions(i), MODEL_VAR)


@query("t22_latest_dv", sql("dv", f"select brand, category, {r('max_by(dv, date)', 'latest_dv')} from dv group by 1, 2"))
def t22(i: Inputs) -> DataFrame:
    return stats.latest_dv(i.dv)


@query(
    "t23_distinct_rows",
    sql("", "select distinct l_returnflag, l_linestatus, l_linenumber, l_quantity from lineitem"),
)
def t23(i: Inputs) -> DataFrame:
    rows = i.table("lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity")
    return stats.distinct_rows(rows)


@query(
    "t24_brand_categories",
    sql("brand_list", "select brand, array_to_string(list_sort(list(category)), '|') categories from brand_list group by 1"),
)
def t24(i: Inputs) -> DataFrame:
    lists = stats.categories_of_brands(i.brand_list())
    return lists.withColumn("categories", F.array_join("categories", "|"))


@query("t25_run_log", sql("eligibility", f"select {KEY}, n_rows, status = 'ok' success, status from eligibility"))
def t25(i: Inputs) -> DataFrame:
    return stats.run_log(i.brand_rows(), i.spec, drivers.MODEL_KEY)


# models


@query("m1_pooled_factors")
def m1(i: Inputs) -> DataFrame:
    return factor.pooled_factors(i.pool_metrics(), i.spec)


@query("m2_category_factors")
def m2(i: Inputs) -> DataFrame:
    return factor.category_factors(i.pool_metrics(), i.spec)


CLEANED = """select brand, category, date, pillar, var, coalesce(value, avg(value) over w) as value from (
  select *, count(value) over (partition by pillar, var) nn from (select distinct category, pillar, var from dict
  where pillar is not null) join panel using (category, var)) where nn > 0 window w as (partition by pillar, var)"""


@query("m3_clean_before_fit", sql("panel dict", f"select brand, category, date, pillar, var, {r('value')} from ({CLEANED})"))
def m3(i: Inputs) -> DataFrame:
    names = i.dictionary().where(F.col("pillar").isNotNull()).select("category", "pillar", "var").distinct()
    return factor.clean_before_fit(i.panel.join(names, ["category", "var"]), ["pillar"])


@query(
    "m1_sample_moments",
    sql(
        "pool_rows",
        f"""with s as (select * from (select seed, brand, category, date, row_number() over (partition by seed order by
          md5(concat_ws('~', brand, category, cast(date as varchar), cast(seed as varchar)))) rn,
          count(*) over (partition by seed) * 95 // 100 n_take
          from (select distinct brand, category, date from pool_rows where pillar in {POOLED}),
          (select unnest([2, 3, 5, 7, 11, 13, 17, 19]) seed)) where rn <= n_take),
        c as (select pillar, brand, category, date, var, value - avg(value) over (partition by pillar, var) x
          from pool_rows where pillar in {POOLED}),
        j as (select c.*, seed, n_take n_rows from c join s using (brand, category, date))
        select pillar, seed, a.var var1, b.var var2, {r("sum(a.x * b.x)", "s")}, max(a.n_rows) n_rows
        from j a join j b using (pillar, seed, brand, category, date) where a.var <= b.var group by 1, 2, 3, 4
        union all select pillar, seed, var, '', {r("sum(x)", "s")}, max(n_rows) from j group by 1, 2, 3""",
    ).replace("with s as (select * from (select seed", ", s as (select * from (select seed"),
)
def m1_moments(i: Inputs) -> DataFrame:
    rows = i.pool_metrics().where(F.col("pillar").isin(*i.spec.pooled_pillars))
    return factor.sample_moments(rows, ["pillar"], i.spec)


@query(
    "m1_three_metric_factor",
    sql("pool_rows", "").rstrip()
    + f"""
, s as (select * from (select seed, brand, category, date, row_number() over (partition by seed order by
    md5(concat_ws('~', brand, category, cast(date as varchar), cast(seed as varchar)))) rn,
    count(*) over (partition by seed) * 95 // 100 n_take
    from (select distinct brand, category, date from pool_rows where pillar = 'awareness'),
    (select unnest([2, 3, 5, 7, 11, 13, 17, 19]) seed)) where rn <= n_take),
  w as (select brand, category, date, max(value) filter (var = 'survey_reach_customers_all') a,
    max(value) filter (var = 'survey_reach_lines_all') b, max(value) filter (var = 'survey_reach_orders_all') c
    from pool_rows group by 1, 2, 3),
  k as (select seed, max(n_take) n_rows, corr(a, b) ab, corr(a, c) ac, corr(b, c) bc
    from w join s using (brand, category, date) group by 1)
select seed, var, n_rows, {r("sqrt(case var when 'survey_reach_customers_all' then ab * ac / bc when "
        "'survey_reach_lines_all' then ab * bc / ac else ac * bc / ab end)", "est_std", 4)}
from k, (values ('survey_reach_customers_all'), ('survey_reach_lines_all'), ('survey_reach_orders_all')) v(var)""",
    4,
)
def m1_closed(i: Inputs) -> DataFrame:
    """The awareness pillar has three metrics, for which the loadings have a closed form."""
    fits = factor.pooled_factors(i.pool_metrics(), replace(i.spec, pooled_pillars=("awareness",)))
    return fits.select("seed", "var", "n_rows", "est_std")


# ridge by elimination on centred moments, for pillars with up to RIDGE_P metrics

RIDGE_P = max(map(len, FEATURES.values()))
_XS = range(1, RIDGE_P + 1)


def _elimination() -> str:
    """CTEs that solve (S + alpha I) b = c: one CTE per pivot, then the coefficients from the last up.

    A pillar with fewer metrics has columns of zeros, whose coefficients come out as 0.
    """
    ctes = []
    for k in range(1, RIDGE_P):
        cells = [
            f"s{i}{j} - s{k}{i} * s{k}{j} / s{k}{k} as s{i}{j}" for i in range(k + 1, RIDGE_P + 1) for j in range(i, RIDGE_P + 1)
        ] + [f"c{i} - s{k}{i} * c{k} / s{k}{k} as c{i}" for i in range(k + 1, RIDGE_P + 1)]
        ctes.append(f"e{k} as (select * replace ({', '.join(cells)}) from {'al' if k == 1 else f'e{k - 1}'})")
    last = f"e{RIDGE_P - 1}"
    for k in reversed(_XS):
        known = "".join(f" - s{k}{j} * b{j}" for j in range(k + 1, RIDGE_P + 1))
        name = "be" if k == 1 else f"u{k}"
        ctes.append(f"{name} as (select *, (c{k}{known}) / s{k}{k} as b{k} from {last})")
        last = name
    return ",\n".join(ctes)


RIDGE_SQL = f"""
, pos as (select brand, category, pillar, var, dense_rank() over (partition by {KEY} order by var) k
    from (select distinct {KEY}, var from samples)),
w as (select {KEY}, date, split, fold, max(dv) dv, {", ".join(f"coalesce(max(value) filter (k = {k}), 0) x{k}" for k in _XS)}
    from samples join pos using (brand, category, pillar, var) where dv is not null group by all),
tr as (select w.* exclude (fold), f as fold from w join (select unnest([0, 1, 2, 3, 4]) f) on split = 'train' and w.fold <> f),
mo as (select {KEY}, fold, count(*) n, avg(dv) my, {", ".join(f"avg(x{k}) m{k}" for k in _XS)},
    {", ".join(f"covar_pop(x{i}, x{j}) * count(*) s{i}{j}" for i in _XS for j in range(i, RIDGE_P + 1))},
    {", ".join(f"covar_pop(x{k}, dv) * count(*) c{k}" for k in _XS)}
    from tr group by all),
al as (select * replace ({", ".join(f"s{k}{k} + alpha as s{k}{k}" for k in _XS)}) from mo,
    (values (0, 0.001::double), (1, 0.01::double), (2, 0.1::double), (3, 1.0::double), (4, 5.0::double), (5, 10.0::double)) g(grid_no, alpha)),
{_elimination()},
coefs as (select {KEY}, grid_no, alpha, fold, var, case k {" ".join(f"when {k} then b{k}" for k in _XS)} end coef,
    my {" ".join(f"- m{k} * b{k}" for k in _XS)} intercept from be join pos using (brand, category, pillar)),
cv as (select {KEY}, grid_no, alpha, w.fold, w.dv, my {" ".join(f"+ b{k} * (x{k} - m{k})" for k in _XS)} predicted
    from w join be using (brand, category, pillar, fold)),
fm as (select {KEY}, grid_no, alpha, fold, 1 - avg((dv - predicted) * (dv - predicted)) / nullif(var_pop(dv), 0) r2,
    avg(abs(dv - predicted) / greatest(abs(dv), 2.220446049250313e-16)) mape from cv group by all),
chosen as (select *, cast(row_number() over (partition by {KEY} order by mape_fold, grid_no) as int) rank from (
    select {KEY}, grid_no, alpha, avg(r2) r2_fold, avg(mape) mape_fold from fm group by all)),
spread as (select {KEY}, var, avg(abs(value - m)) spread from (select *, avg(value) over (partition by {KEY}, var) m
    from samples where split = 'train') group by all),
attr as (select {KEY}, var, grid_no, coef, abs(coef) * spread attribution from coefs
    join spread using (brand, category, pillar, var) where fold = 0),
pr as (select {KEY}, grid_no, split, dv, my {" ".join(f"+ b{k} * (x{k} - m{k})" for k in _XS)} predicted
    from w join be using (brand, category, pillar) where be.fold = 0)
"""


def ridge_sql(select: str) -> str:
    return sql("samples", "").rstrip() + RIDGE_SQL + select


# components by Jacobi rotations on the same centred moments

JACOBI_SWEEPS = 10


def _moment(i: int, j: int) -> str:
    return f"s{min(i, j)}{max(i, j)}"


def _rotated(source: str, p: int, q: int) -> str:
    """One rotation that sets the moment of p and q to zero; v collects the rotations."""
    off = _moment(p, q)
    cells = [f"{_moment(p, p)} - t * {off} as {_moment(p, p)}", f"{_moment(q, q)} + t * {off} as {_moment(q, q)}", f"0.0::double as {off}"]
    for k in _XS:
        if k not in (p, q):
            a, b = _moment(k, p), _moment(k, q)
            cells += [f"co * {a} - si * {b} as {a}", f"si * {a} + co * {b} as {b}"]
        cells += [f"co * v{k}{p} - si * v{k}{q} as v{k}{p}", f"si * v{k}{p} + co * v{k}{q} as v{k}{q}"]
    return f"""(select * exclude (th, t, co, si) replace ({", ".join(cells)}) from (
      select *, 1 / sqrt(t * t + 1) co, t / sqrt(t * t + 1) si from (
      select *, case when abs({off}) < 1e-30 then 0 when th < 0 then -1 / (sqrt(th * th + 1) - th) else 1 / (sqrt(th * th + 1) + th) end t
      from (select *, ({_moment(q, q)} - {_moment(p, p)}) / (2 * case when abs({off}) < 1e-30 then 1 else {off} end) th from {source}))))"""


def _jacobi() -> str:
    moments = [_moment(i, j) for i in _XS for j in range(i, RIDGE_P + 1)]
    unit = ", ".join(f"{float(i == j)}::double v{i}{j}" for i in _XS for j in _XS)
    turns = "(select * from jac where sweep < {})".format(JACOBI_SWEEPS)
    for p in _XS:
        for q in range(p + 1, RIDGE_P + 1):
            turns = _rotated(turns, p, q)
    parts = " union all ".join(
        f"select {KEY}, s{k}{k} ev, {', '.join(f'v{j}{k} l{j}' for j in _XS)} from jac where sweep = {JACOBI_SWEEPS}" for k in _XS
    )
    return f""",
jac as (select {KEY}, 0 sweep, {", ".join(f"{m}::double {m}" for m in moments)}, {unit} from mo where fold = 0
    union all select * replace (sweep + 1 as sweep) from {turns}),
axes as (select *, row_number() over w - 1 component, sum(ev) over w - ev as before, sum(ev) over (partition by {KEY}) total
    from ({parts}) window w as (partition by {KEY} order by ev desc rows between unbounded preceding and current row)),
taken as (select * from axes where total > 1e-12 and before <= 0.95 * total)
"""


def components_sql(select: str) -> str:
    moments = RIDGE_SQL[: RIDGE_SQL.index(",\nal as")]
    return sql("samples", "").rstrip().replace("with ", "with recursive ", 1) + moments + _jacobi() + select


def complete_rows(i: Inputs) -> DataFrame:
    return i.model_rows.where(F.col("dv").isNotNull())


@query("t19_explained_variance", components_sql(f"select {KEY}, cast(component as int) component, {r('ev / total', 'explained')} from taken"))
def t19_explained(i: Inputs) -> DataFrame:
    """Components that hold 95 % of the variance of every brand's, category's and pillar's metrics."""
    loadings = stats.component_loadings(complete_rows(i), drivers.MODEL_KEY)
    return loadings.select(*drivers.MODEL_KEY, "component", "explained").distinct()


@query(
    "t19_key_components",
    components_sql(
        f"""select {KEY}, date, split, 'pca' || component as var,
        {r("abs(" + " + ".join(f"l{k} * (x{k} - m{k})" for k in _XS) + ")", "distance")}
        from w join taken using (brand, category, pillar) join (select * from mo where fold = 0) using (brand, category, pillar)"""
    ),
)
def t19_keys(i: Inputs) -> DataFrame:
    """Learning rows of every key on its components; the sign of a component is free."""
    rows = stats.component_rows(complete_rows(i), drivers.MODEL_KEY)
    return rows.select(*drivers.MODEL_KEY, "date", "split", "var", F.abs("value").alias("distance"))


def all_coefs(i: Inputs) -> DataFrame:
    model = i.spec.weights_model
    return drivers.ridge_coefficients(i.model_rows, drivers.MODEL_KEY, model.alphas)


@query(
    "m4_ridge_coefficients",
    ridge_sql(f"select {KEY}, cast(grid_no as int) grid_no, {r('alpha')}, cast(fold as int) fold, var, {r('coef')}, {r('intercept')} from coefs"),
)
def m4(i: Inputs) -> DataFrame:
    return all_coefs(i)


@query("m4_positive_ridge")
def m4_positive(i: Inputs) -> DataFrame:
    model = i.spec.weights_model
    return drivers.ridge_coefficients(i.model_rows, drivers.MODEL_KEY, model.alphas, positive=True)


@query("m4_correlation_selected_ridge")
def m4_selected(i: Inputs) -> DataFrame:
    """Ridge on the metrics that correlate with the sales share beyond the configured cut-off."""
    spec = replace(i.spec, weights_model=replace(i.spec.weights_model, selection="correlation"))
    rows = stats.eligible(i.brand_rows(), spec, drivers.MODEL_KEY)
    return refresh.learn_drivers(rows, i.maps(), spec)


def tree_results(i: Inputs, kind: str) -> DataFrame:
    """Results of the configured grid and folds for every brand, category and pillar."""
    rows = stats.eligible(i.brand_rows(), i.spec, drivers.MODEL_KEY)
    samples = stage(drivers.learning_rows(rows, drivers.MODEL_KEY, i.spec.weights_model, i.spec), "samples")
    return forests.tree_model(samples, kind, i.spec.weights_model, drivers.MODEL_KEY)[0]


@query("m5_forest_model")
def m5(i: Inputs) -> DataFrame:
    return tree_results(i, FOREST)


@query("m6_boosted_model")
def m6(i: Inputs) -> DataFrame:
    return tree_results(i, BOOSTED)


@query(
    "m7_linear_attribution",
    ridge_sql(f"select {KEY}, var, {r('coef')}, {r('attribution')} from attr where grid_no = 2"),
)
def m7(i: Inputs) -> DataFrame:
    coefs = all_coefs(i).where((F.col("fold") == 0) & (F.col("grid_no") == 2))
    train = i.model_rows.where(F.col("split") == "train")
    return drivers.linear_attribution(train, coefs, drivers.MODEL_KEY)


@query(
    "m8_selection_table",
    ridge_sql(f"select {KEY}, cast(grid_no as int) grid_no, {r('alpha')}, {r('r2_fold')}, {r('mape_fold')}, rank from chosen"),
)
def m8(i: Inputs) -> DataFrame:
    keys = drivers.MODEL_KEY
    predicted = drivers.linear_predictions(i.model_rows, all_coefs(i), keys, by_fold=True)
    metrics = stats.regression_metrics(predicted, [*keys, "grid_no", "alpha", "fold"])
    return drivers.selection_table(metrics, keys, ["grid_no", "alpha"])


@query(
    "m9_result_rows",
    ridge_sql(
        f"""select {KEY}, var, {r("coef", "importance")}, {r("attribution")}, {r("r2_fold")}, {r("mape_fold")},
        {r("r2_train")}, {r("mape_train")}, {r("r2_holdout")}, {r("mape_holdout")}, {r("r2_all")}, {r("mape_all")},
        {r("latest_dv")}, 'ridge' model, 'alpha=' || case grid_no when 0 then '0.001' when 1 then '0.01'
        when 2 then '0.1' when 3 then '1.0' when 4 then '5.0' else '10.0' end best_params
        from attr join (select {KEY}, grid_no, r2_fold, mape_fold from chosen where rank = 1)
          using (brand, category, pillar, grid_no)
        join (select {KEY}, grid_no, {", ".join(
            f"1 - avg((dv - predicted) * (dv - predicted)) {f} / nullif(var_pop(dv) {f}, 0) r2_{n}, "
            f"avg(abs(dv - predicted) / greatest(abs(dv), 2.220446049250313e-16)) {f} mape_{n}"
            for n, f in (("train", "filter (split = 'train')"), ("holdout", "filter (split = 'holdout')"), ("all", "")))}
          from pr group by all) using (brand, category, pillar, grid_no)
        join (select {KEY}, max_by(dv, date) latest_dv from samples where dv is not null group by all)
          using (brand, category, pillar)"""
    ),
)
def m9(i: Inputs) -> DataFrame:
    rows = stats.eligible(i.brand_rows(), i.spec, drivers.MODEL_KEY)
    return drivers.ridge_model(rows, drivers.MODEL_KEY, i.spec.weights_model, i.spec)[0]


@query("e4_learn")
def e4(i: Inputs) -> DataFrame:
    """Weights sheet learned from ridge attributions and factor loadings."""
    return refresh.learn_weights(i.scaled, i.modelling(), i.dv, i.maps(), i.spec)

