"""Properties of the refresh, and results that do not depend on how rows are laid out."""

import datetime as dt

from pyspark.sql import functions as F

from equitrace.catalog import inputs as tables
from equitrace.catalog.inputs import Inputs, rounded
from equitrace.operators import importance, prepare, sales, scores, weights
from equitrace.plans import refresh
from equitrace.sources import io
from equitrace.sources.workspace import shared_dir, stage
from equitrace.spec import RIDGE
from tests.conftest import SF_DIR


def near(df, col, value, tol=1e-9):
    assert df.count() > 0
    assert df.where(F.abs(F.col(col) - value) > tol).count() == 0


def test_market_shares_sum_to_one(inputs):
    near(inputs.sales().groupBy("date", "category").agg(F.sum("market_share_total_sales").alias("s")), "s", 1.0)


def test_scaled_scores_average_to_one_hundred(inputs):
    scored = scores.scaled_scores(inputs.index)
    near(scored.groupBy("date", "category", "var").agg(F.avg("score").alias("m")), "m", 100.0, 1e-6)


def test_weights_sum_to_one_where_both_sources_know_all(frame):
    merged = frame(
        [("p_pillar", f"m{k}", float(k + 1), 1.0 / (k + 1)) for k in range(4)],
        "pillar string, var string, attribution double, est_std double",
    )
    near(weights.metric_weights(merged, ["pillar"]).groupBy("pillar").agg(F.sum("weight").alias("s")), "s", 1.0)


def test_relative_importance_sums_to_one(inputs):
    from equitrace.catalog.score_queries import trend_results

    shares = importance.relative_importance(trend_results(inputs), RIDGE)
    near(shares.groupBy("brand", "category").agg(F.sum("relative_importance").alias("s")), "s", 1.0)


def test_panel_key_is_unique(inputs):
    for df in (inputs.panel, inputs.scaled.where("scope = 'category'"), inputs.index):
        keys = df.groupBy("brand", "category", "date", "var").count()
        assert keys.where("count > 1").count() == 0


def test_scaled_values_lie_in_the_unit_range(inputs):
    assert inputs.scaled.where("value < 0 or value > 1").count() == 0


def rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_result_does_not_depend_on_partitions(spark, inputs):
    def scaled():
        panel = prepare.scaled_panel(inputs.panel, inputs.dictionary(), inputs.brand_list(), inputs.spec)
        return rows(panel.withColumn("value", F.round("value", 9)).where("brand in ('Brand#1', 'Brand#2')"))

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = scaled()
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        many = scaled()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert one == many and one


def test_result_does_not_depend_on_row_order(inputs):
    fact, *dims = inputs.star()
    base = sales.star_sales(fact, *dims, "AMERICA")
    mixed = sales.star_sales(fact.orderBy(F.rand(3)), *dims, "AMERICA")
    assert rows(base) == rows(mixed)


def test_learned_weights_and_scoring_mode(spark, inputs, tmp_path):
    sheet = refresh.learn_weights(inputs.scaled, inputs.modelling(), inputs.dv, inputs.maps(), inputs.spec)
    assert sheet.where("weight < 0 or weight > 1").count() == 0
    assert sheet.groupBy("category", "pillar", "metric").count().where("count > 1").count() == 0
    month = dt.date(2024, 11, 1)
    io.write_stage(sheet, str(tmp_path), "pillar_creation", "weights_sheet", month)
    stored = io.read_stored_weights(spark, str(tmp_path), month)
    a = refresh.score(inputs.scaled, sheet, inputs.maps(), inputs.spec)
    b = refresh.score(inputs.scaled, stored, inputs.maps(), inputs.spec)
    assert rows(a.index) == rows(b.index)


def test_shared_folder_comes_from_the_session(spark, frame):
    base = shared_dir(spark)
    assert base == spark.conf.get("spark.checkpoint.dir")
    staged = stage(frame([(1, "a")], "k int, v string"), "probe")
    assert staged.inputFiles()[0].split("file:")[-1].lstrip("/").startswith(base.lstrip("/"))
    assert [tuple(r) for r in staged.collect()] == [(1, "a")]


def test_scans_read_only_what_they_need(inputs):
    plan = inputs.weekly()._jdf.queryExecution().executedPlan().toString()
    lineitem = [ln for ln in plan.splitlines() if "FileScan" in ln and "l_extendedprice" in ln][0]
    assert "l_returnflag" not in lineitem and "l_linestatus" not in lineitem
    dated = inputs.panel.where("var = 'search_searchvolume'").select("value")
    plan = dated._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(var), EqualTo(var,search_searchvolume)]" in plan


def test_hot_product_and_no_broadcast(spark, inputs):
    """One product, and so one brand and category, holds a third of the fact; joins must shuffle."""
    fact, *dims = inputs.star()
    hot = fact.withColumn("product_key", F.when(F.rand(5) < 0.4, F.lit(1)).otherwise(F.col("product_key")))
    hot = stage(hot, "hot-fact")
    assert hot.where("product_key = 1").count() * 3 > hot.count()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plain = rows(rounded(sales.sales_shares(sales.sales_base(hot, *dims, inputs.spec)), 4))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = sales.sales_shares(sales.sales_base(hot, *dims, inputs.spec))
        shuffled = rows(rounded(df, 4))
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
        panel = prepare.scaled_panel(inputs.panel, inputs.dictionary(), inputs.brand_list(), inputs.spec)
        assert panel.count() == inputs.scaled.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plain == shuffled


def test_tasks_of_the_panel_grow_with_the_lines(spark, monkeypatch):
    """Rows of an order or a customer are never grouped in tasks whose share grows with the input."""
    monkeypatch.setattr(tables, "_STAGED", {})
    monkeypatch.setattr(tables, "ROWS_OF_A_TASK", 500)
    own = Inputs(spark, SF_DIR)
    least = own.table("lineitem").count() // 500
    assert len(own.lines.inputFiles()) >= least > spark.sparkContext.defaultParallelism
    wide = own.panel_wide()
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and not [ln for ln in plan.splitlines() if "Aggregate" in ln and "l_orderkey" in ln]
    got = wide.agg(F.sum("survey_reach_orders_all"), F.sum("survey_reach_customers_all")).first()
    cells = own.table("lineitem").join(own.table("part"), F.col("l_partkey") == F.col("p_partkey"))
    cells = cells.join(own.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    counted = cells.groupBy("p_brand", "p_type", F.trunc("l_shipdate", "month")).agg(
        F.count_distinct("l_orderkey").alias("o"), F.count_distinct("o_custkey").alias("c")
    )
    assert tuple(got) == tuple(counted.agg(F.sum("o").cast("double"), F.sum("c").cast("double")).first())
