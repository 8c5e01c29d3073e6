"""Domain tables derived from the star-schema and event tables of a data folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from equitrace import schemas
from equitrace.functions.exprs import month_start, week_ending, with_suffix
from equitrace.functions.grouping import PANEL_KEY
from equitrace.operators import drivers, harmonise, prepare, sales, scores, stats, weights
from equitrace.plans.refresh import Mappings
from equitrace.sources.workspace import stage
from equitrace.spec import ModelSpec, RefreshSpec

CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
OUT_OF_SCOPE = ("Brand#24", "Brand#25")
MARKET = "AMERICA"
ROLLUP = "Vendor#1"
#: order lines that one task joins and sorts, about; the number of tasks grows with the lines
ROWS_OF_A_TASK = 400_000

SPEC = RefreshSpec(
    grain="monthly",
    start_date=dt.date(1995, 1, 1),
    end_date=dt.date(2001, 6, 30),
    categories=CATEGORIES,
    high_null_categories=("PROMO",),
    weights_model=ModelSpec(folds=4),
)

# var, pillar, selected, lower bound, upper bound, expected sign
METRICS = (
    ("survey_reach_customers_all", "awareness", "Y", 0.0, 12.0, "P"),
    ("survey_reach_lines_all", "awareness", "Y", 0.0, 14.0, "P"),
    ("survey_reach_orders_all", "awareness", "Y", 0.0, 12.0, "P"),
    ("panel_segment_share_net", "loyalty", "Y", 0.0, 1.0, "P"),
    ("panel_status_share_all", "loyalty", "Y", 0.0, 1.0, "P"),
    ("panel_order_value_mean", "loyalty", "Y", 0.0, 400000.0, "N"),
    ("directions_kept_share_all", "advocacy", "Y", 0.0, 1.0, "P"),
    ("directions_kept_quantity_share", "advocacy", "Y", 0.0, 1.0, "P"),
    ("directions_urgent_mean", "consideration", "Y", 0.0, 1.0, "P"),
    ("directions_quantity_mean", "consideration", "Y", 5.0, 45.0, "N"),
    ("directions_net_quantity_mean", "consideration", "Y", 5.0, 45.0, "P"),
    ("brandtone_discount_mean", "brand_perceptions", "Y", 0.0, 0.1, "N"),
    ("brandtone_price_mean", "brand_perceptions", "Y", 100.0, 20000.0, "P"),
    ("brandtone_revenue_mean", "brand_perceptions", "Y", 100.0, 80000.0, "P"),
    ("ratings_tax_returned_mean", "product_feedback", "Y", 0.0, 0.1, "N"),
    ("ratings_returned_rank_1st", "product_feedback", "Y", 0.0, 1.0, "N"),
    ("ratings_returned_quantity_share", "product_feedback", "Y", 0.0, 1.0, "N"),
    ("ratings_sparse_mean", "product_feedback", "Y", 0.0, 0.1, "P"),
    ("ratings_reviews_review_count", None, "N", None, None, None),
    ("search_searchvolume", None, "N", None, None, None),
)
STARS = tuple(f"ratings_reviews_{i}_star_ratings" for i in range(1, 6))
PANEL_VARS = tuple(m[0] for m in METRICS) + STARS
NOT_SELECTED = ("LARGE", "brandtone_discount_mean")
RENAMES = (
    ("survey_reach_customers_all", "survey_reach_buyers_all"),
    ("panel_status_share_all", "panel_closed_share_all"),
    ("search_searchvolume", None),
)
INVERSES = (
    ("sub", "panel_segment_share_net", "1", "panel_other_segment_share_net"),
    ("sub", "ratings_tax_returned_mean", "0.1", "ratings_tax_headroom_mean"),
    ("add", None, "ratings_reviews_1_star_ratings+ratings_reviews_2_star_ratings", "ratings_low_stars"),
    ("add", None, "ratings_tax_returned_mean+ratings_sparse_mean", "ratings_tax_sum"),
)
MOVES = (
    ("Brand#3", "PROMO", "PROMO TREATS"),
    ("Brand#7", "PROMO", "PROMO TREATS"),
    ("Brand#7", "ECONOMY", "ECONOMY TREATS"),
)
PARENTS = (("PROMO TREATS", "PROMO"), ("ECONOMY TREATS", "ECONOMY"))
DASHBOARD = (
    ("survey_reach_customers_all", "Reach among buyers"),
    ("panel_status_share_all", "Closed orders"),
    ("brandtone_price_mean", "Unit price"),
)
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
EVENT_VARS = tuple(
    f"web_panel_{t}_{s}" for t in EVENT_TYPES for s in ("avg_value_all_users", "net_value")
)


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to fixed places (and -0.0 to 0.0), so that results compare across engines."""
    cols = [
        (half_up(f"`{n}`", places) + F.lit(0.0)).alias(n) if t == "double" else F.col(f"`{n}`")
        for n, t in df.dtypes
    ]
    return df.select(*cols)


def half_up(c: str | Column, places: int) -> Column:
    """Round half up; the inner rounding removes float noise around a tie."""
    return F.round(F.round(c, places + 3), places)


def share(cond: Column) -> Column:
    return F.sum(cond.cast("int"))


_STAGED: dict[tuple[str, str, str], DataFrame] = {}


def forget_staged() -> None:
    """Derive the stage tables anew for the next query (the benchmark does so before each)."""
    _STAGED.clear()


class Inputs:
    """Lazy domain tables over one data folder.

    Like a refresh, a session derives each stage table once per folder, writes it to the shared
    folder and lets every query that needs it read it from there.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.spec = SPEC

    def staged(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _STAGED:
            _STAGED[key] = stage(build(), name)
        return _STAGED[key]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # sales facts and dimensions

    def fact(self) -> DataFrame:
        li = self.table("lineitem")
        part = self.table("part").select("p_partkey", "p_size")
        pounds = F.col("l_quantity") * F.col("p_size")
        return li.join(part, li["l_partkey"] == part["p_partkey"]).select(
            F.col("l_suppkey").alias("market_key"),
            F.col("l_partkey").alias("product_key"),
            F.unix_date(week_ending("l_shipdate")).cast("bigint").alias("period_key"),
            F.col("l_extendedprice").alias("dollars"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("base_dollars"),
            pounds.alias("pounds"),
            (pounds * (1 - F.col("l_tax"))).alias("base_pounds"),
            F.col("l_quantity").alias("units"),
            (F.col("l_quantity") * (1 - F.col("l_tax"))).alias("base_units"),
            (F.col("l_discount") * 1000).alias("pct_acv"),
        )

    def periods(self) -> DataFrame:
        weeks = self.table("lineitem").select(week_ending("l_shipdate").alias("week_ending"))
        return weeks.distinct().select(
            F.unix_date("week_ending").cast("bigint").alias("period_key"),
            F.lit(1).alias("period_weeks"),
            "week_ending",
        )

    def markets(self) -> DataFrame:
        s, n, r = self.table("supplier"), self.table("nation"), self.table("region")
        return (
            s.join(n, s["s_nationkey"] == n["n_nationkey"])
            .join(r, n["n_regionkey"] == r["r_regionkey"])
            .select(F.col("s_suppkey").alias("market_key"), F.col("r_name").alias("market_description"))
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_key"),
            F.concat(F.lit("Vendor#"), F.right("p_brand", F.lit(1))).alias("vendor"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("category"),
        )

    def star(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        return self.fact(), self.periods(), self.markets(), self.products()

    def weekly(self, market: str | None = MARKET) -> DataFrame:
        return sales.acv_ratio(sales.star_sales(*self.star(), market))

    @property
    def sales_base(self) -> DataFrame:
        """Monthly rounded panel over all markets, without a roll-up."""
        return self.staged("sales-base", lambda: sales.sales_base(*self.star(), self.spec))

    def sales(self) -> DataFrame:
        return sales.sales_shares(self.sales_base).drop("vendor")

    @property
    def dv(self) -> DataFrame:
        return prepare.dependent_variable(self.sales(), self.spec)

    # metric panel

    def dealt(self, df: DataFrame, rows: int, *keys: str) -> DataFrame:
        """The rows dealt by keys to tasks of a bounded share of so many rows, whatever the input's size."""
        least = self.spark.sparkContext.defaultParallelism
        return df.repartition(max(least, -(-rows // ROWS_OF_A_TASK)), *keys)

    @property
    def lines(self) -> DataFrame:
        """Order lines with their cell (brand, category, month), customer and what the metrics are made of.

        `first` marks one line of every order in a cell; an order's few lines are all that its window sorts.
        """
        def build() -> DataFrame:
            orders = self.table("orders").select(
                "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
            )
            customer = self.table("customer").select("c_custkey", "c_mktsegment")
            part = self.table("part").select("p_partkey", "p_brand", "p_type")
            li = self.table("lineitem")
            n = li.count()
            bought = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
            rows = self.dealt(li.join(part, li["l_partkey"] == part["p_partkey"]), n, "l_orderkey")
            rows = rows.join(self.dealt(bought, n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
                F.col("p_brand").alias("brand"),
                F.col("p_type").alias("category"),
                month_start("l_shipdate").alias("date"),
                "o_custkey",
                "l_orderkey",
                (F.col("c_mktsegment") == "BUILDING").alias("building"),
                (F.col("o_orderstatus") == "F").alias("closed"),
                (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
                (F.col("l_returnflag") == "R").alias("returned"),
                "o_totalprice",
                "l_quantity",
                "l_extendedprice",
                "l_discount",
                "l_tax",
            )
            of_order = Window.partitionBy("l_orderkey", *PANEL_KEY).orderBy("l_orderkey")
            return rows.withColumn("first", F.row_number().over(of_order) == 1).drop("l_orderkey")

        return self.staged("lines", build)

    def panel_wide(self) -> DataFrame:
        """One row per brand, category and month with every metric.

        All sums combine on the map side to one row per cell. Orders are counted by their first line, and
        only the distinct customers of a cell are grouped by themselves, as narrow rows. They are dealt
        before that, since a map side that meets nearly no customer twice would hold all its rows.
        """
        rows = self.lines
        qty, returned = F.col("l_quantity"), F.col("returned")
        sums = {
            "lines": F.count("*"),
            "orders": share(F.col("first")),
            "building": share(F.col("building")),
            "closed": share(F.col("closed")),
            "order_value": F.sum("o_totalprice"),
            "kept": share(~returned),
            "urgent": share(F.col("urgent")),
            "quantity": F.sum(qty),
            "net_quantity": F.sum(qty * (1 - F.col("l_discount"))),
            "discount": F.sum("l_discount"),
            "unit_price": F.sum(F.col("l_extendedprice") / qty),
            "revenue": F.sum("l_extendedprice"),
            "tax_returned": F.sum(F.when(returned & (qty > 20), F.col("l_tax"))),
            "n_tax_returned": share(returned & (qty > 20)),
            "returned": share(returned),
            "quantity_kept": F.sum(F.when(returned, 0.0).otherwise(qty)),
            "quantity_returned": F.sum(F.when(returned, qty).otherwise(0.0)),
            "tax_sparse": F.sum(F.when(returned & (qty >= 45), F.col("l_tax"))),
            "n_tax_sparse": share(returned & (qty >= 45)),
            **{
                f"star_{i}": share((qty > 10 * (i - 1)) & (qty <= 10 * i)) for i in range(1, 6)
            },
        }
        cell = list(PANEL_KEY)
        summed = rows.groupBy(*cell).agg(*[agg.alias(n) for n, agg in sums.items()])
        buyers = self.dealt(rows.select(*cell, "o_custkey"), rows.count(), *cell, "o_custkey").distinct()
        buyers = buyers.groupBy(*cell).agg(F.count("o_custkey").alias("customers"))
        # a union and not a join, so that cells of null keys stay
        per_cell = summed.unionByName(buyers, allowMissingColumns=True).groupBy(*cell).agg(
            *[F.max(n).alias(n) for n in (*sums, "customers")]
        )

        def mean(a: str, n: str = "lines") -> Column:
            return half_up(F.try_divide(F.col(a), F.col(n)), 6) + F.lit(0.0)

        def whole(c: str) -> Column:
            return F.col(c).cast("double")

        values = {
            "survey_reach_customers_all": whole("customers"),
            "survey_reach_lines_all": whole("lines"),
            "survey_reach_orders_all": whole("orders"),
            "panel_segment_share_net": mean("building"),
            "panel_status_share_all": mean("closed"),
            "panel_order_value_mean": mean("order_value"),
            "directions_kept_share_all": mean("kept"),
            "directions_kept_quantity_share": mean("quantity_kept", "quantity"),
            "directions_urgent_mean": mean("urgent"),
            "directions_quantity_mean": mean("quantity"),
            "directions_net_quantity_mean": mean("net_quantity"),
            "brandtone_discount_mean": mean("discount"),
            "brandtone_price_mean": mean("unit_price"),
            "brandtone_revenue_mean": mean("revenue"),
            "ratings_tax_returned_mean": mean("tax_returned", "n_tax_returned"),
            "ratings_returned_rank_1st": mean("returned"),
            "ratings_returned_quantity_share": mean("quantity_returned", "quantity"),
            "ratings_sparse_mean": mean("tax_sparse", "n_tax_sparse"),
            "ratings_reviews_review_count": whole("lines"),
            "search_searchvolume": whole("quantity"),
            **{s: whole(f"star_{i}") for i, s in enumerate(STARS, 1)},
        }
        return per_cell.select(*cell, *[v.alias(n) for n, v in values.items()])

    @property
    def panel(self) -> DataFrame:
        return self.staged("panel", lambda: harmonise.unpivot_metrics(self.panel_wide()))

    @property
    def old_panel(self) -> DataFrame:
        """The refresh before: the same rows with values moved by a rule of key and month.

        Steps run from -12 % to +12 % in 4 %, one rest class stands at 0, and no row has the month July.
        """
        step = (F.month("date") + F.year("date") + F.length("var") + F.length("category")) % 8
        moved = F.when(step == 7, 0.0 * F.col("value")).otherwise(F.col("value") * (1 + (step - 3) / 25.0))
        rows = self.panel.where(F.month("date") != 7)
        return self.staged(
            "old-panel", lambda: rows.withColumn("value", half_up(moved, 6) + F.lit(0.0))
        )

    def events_long(self) -> DataFrame:
        ev = self.table("events")
        even = F.col("event_id") % 2 == 0
        categories = F.array(*[F.lit(c) for c in CATEGORIES])
        return ev.select(
            F.concat(F.lit("Brand#"), (F.col("user_id") % 25 + 1).cast("string")).alias("brand"),
            F.element_at(categories, (F.col("user_id") % 6 + 1).cast("int")).alias("category"),
            F.col("ts").cast("date").alias("date"),
            F.lit("Web Panel").alias("data_source"),
            F.col("event_type").alias("metric_type"),
            F.when(even, "avg value").otherwise("Net Value").alias("metric_name"),
            F.when(even, "all users").alias("user_segment"),
            F.col("value").alias("metric_value"),
        )

    # mapping tables

    def dictionary(self) -> DataFrame:
        rows = [
            (v, v.replace("_", " "), v.split("_")[0], "group " + v.split("_")[0], p, y, lo, hi, s)
            for v, p, y, lo, hi, s in METRICS
        ]
        schema = (
            "var string, metric_name string, data_source string, vendor_group string, "
            "pillar string, select_flag string, min double, max double, expected_sign string"
        )
        category, var = NOT_SELECTED
        return (
            self.small(rows, schema)
            .withColumn("category", F.explode(F.array(*[F.lit(c) for c in CATEGORIES])))
            .withColumn(
                "select_flag",
                F.when((F.col("category") == category) & (F.col("var") == var), "N").otherwise(
                    F.col("select_flag")
                ),
            )
        )

    def brand_list(self) -> DataFrame:
        return (
            self.table("part")
            .where(~F.col("p_brand").isin(*OUT_OF_SCOPE))
            .select(F.col("p_brand").alias("brand"), F.col("p_type").alias("category"))
            .distinct()
        )

    def small(self, rows: Sequence[tuple], schema: str) -> DataFrame:
        """A table of configured rows; through Arrow it becomes a local relation of known size."""
        fields = StructType.fromDDL(schema)
        return self.spark.createDataFrame(pd.DataFrame(rows, columns=fields.names), fields)

    def renames(self) -> DataFrame:
        return self.small(RENAMES, schemas.METRIC_RENAME)

    def rules(self) -> DataFrame:
        return self.small(INVERSES, schemas.INVERSE_RULES)

    def moves(self) -> DataFrame:
        return self.small(MOVES, schemas.CATEGORY_MOVE)

    def parents(self) -> DataFrame:
        return self.small(PARENTS, schemas.CATEGORY_PARENT)

    def dashboard(self) -> DataFrame:
        return self.small(DASHBOARD, schemas.DASHBOARD_NAMES)

    def prices(self) -> DataFrame:
        """Price class per brand and category from its largest pack; one brand is not mapped."""
        size = F.max("p_size")
        return (
            self.table("part")
            .where(F.col("p_brand") != "Brand#1")
            .groupBy(F.col("p_brand").alias("brand"), F.col("p_type").alias("category"))
            .agg(
                F.when(size == 50, "Premium").when(size != 49, "Mainstream").alias("price_class")
            )
        )

    def maps(self) -> Mappings:
        return Mappings(
            self.dictionary(), self.brand_list(), self.rules(), self.moves(), self.parents(),
            self.prices(), self.dashboard(),
        )

    # preparation and learning

    def selected(self) -> DataFrame:
        rows = prepare.keep_listed_brands(self.panel, self.brand_list())
        return prepare.select_metrics(rows, self.dictionary())

    @property
    def scaled(self) -> DataFrame:
        return self.staged(
            "scaled",
            lambda: prepare.scaled_panel(self.panel, self.dictionary(), self.brand_list(), self.spec),
        )

    def modelling(self) -> DataFrame:
        return prepare.attach_dv(self.scaled, self.dv)

    def brand_rows(self) -> DataFrame:
        """Brand-level rows with pillar and dependent variable."""
        return stats.by_pillar(stats.present_in_pool(self.modelling()), self.dictionary())

    def pool_metrics(self) -> DataFrame:
        """Pool-level rows with their pillar."""
        return stats.by_pillar(self.scaled.where(F.col("scope") == "category"), self.dictionary())

    def pool_rows(self) -> DataFrame:
        """The same with the dependent variable."""
        return stats.by_pillar(
            self.modelling().where(F.col("scope") == "category"), self.dictionary()
        )

    @property
    def model_rows(self) -> DataFrame:
        """Rows of the keys that can be modelled, split and folded."""
        def build() -> DataFrame:
            rows = stats.eligible(self.brand_rows(), self.spec, drivers.MODEL_KEY)
            return drivers.learning_rows(rows, drivers.MODEL_KEY, self.spec.weights_model, self.spec)

        return self.staged("samples", build)

    @property
    def attributions(self) -> DataFrame:
        """Attribution table of a finished learning run: |corr| of a metric with the sales share."""
        def build() -> DataFrame:
            found = stats.dv_correlation(self.brand_rows(), drivers.MODEL_KEY)
            return found.where(F.col("corr_abs").isNotNull()).select(
                *drivers.MODEL_KEY, "var", half_up("corr_abs", 6).alias("attribution")
            )

        return self.staged("attributions", build)

    def _loadings(self, keys: list[str], category: Column) -> DataFrame:
        seeds = F.explode(F.array(F.lit(2), F.lit(3)))
        ops = F.explode(F.array(F.lit("=~"), F.lit("~~")))
        found = self.pool_rows().groupBy(*keys, "var").agg(
            half_up(stats.correlation("value", "dv"), 6).alias("corr")
        )
        return (
            found.where(F.col("corr").isNotNull())
            .withColumn("seed", seeds)
            .withColumn("op", ops)
            .select(
                category.alias("category"),
                with_suffix("pillar").alias("pillar"),
                "seed",
                "op",
                "var",
                F.when(F.col("op") == "=~", F.col("corr"))
                .otherwise(1 - F.col("corr") * F.col("corr"))
                .alias("est_std"),
            )
        )

    @property
    def pooled_loadings(self) -> DataFrame:
        """Loading table of a finished factor run over all categories."""
        return self.staged(
            "pooled-loadings", lambda: self._loadings(["pillar"], F.lit("ALL CATEGORY"))
        )

    @property
    def category_loadings(self) -> DataFrame:
        return self.staged(
            "category-loadings", lambda: self._loadings(["category", "pillar"], F.col("category"))
        )

    # scoring

    @property
    def sheet(self) -> DataFrame:
        return self.staged(
            "sheet",
            lambda: weights.create_weights(
                self.attributions, self.pooled_loadings, self.category_loadings, self.dv, self.spec
            ),
        )

    def pooled(self) -> DataFrame:
        return scores.pooled_rows(self.scaled)

    @property
    def scores(self) -> DataFrame:
        return self.staged("scores", lambda: scores.pillar_scores(self.pooled(), self.sheet))

    @property
    def index(self) -> DataFrame:
        return self.staged(
            "index", lambda: scores.long_index(self.pooled(), self.scores, self.dictionary())
        )

    def trended(self) -> DataFrame:
        return scores.trends(self.scores, self.spec.trend_window)


