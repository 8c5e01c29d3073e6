"""Settings of one refresh: grain, dates, pillars, thresholds and model grids."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Published names and settings that results depend on.
PILLARS_POOLED = ("awareness", "loyalty", "advocacy", "consideration")
PILLARS_BY_CATEGORY = ("brand_perceptions", "product_feedback")
PILLAR_SUFFIX = "_pillar"
PILLAR_LABELS = {
    "brand_perceptions_pillar": "Brand Perceptions",
    "loyalty_pillar": "Loyalty",
    "advocacy_pillar": "Advocacy",
    "awareness_pillar": "Awareness",
    "consideration_pillar": "Consideration",
    "product_feedback_pillar": "Product Feedback",
}
SAMPLE_SEEDS = (2, 3, 5, 7, 11, 13, 17, 19)
SOURCE_NAMES = {"neilsen": "neilsen_panel", "ratings": "ratings_reviews"}
SALES_SOURCE = "RMS"
SALES_METRICS = (
    "rms_acv_selling_rt",
    "total_sales_rt",
    "equalized_volume_rt",
    "total_units_rt",
    "average_price_rt",
    "market_share_total_sales_rt",
)
SALES_MEASURES = (
    "total_sales",
    "s_base_dollars",
    "eq_volume",
    "s_base_pounds",
    "total_units",
    "s_base_units",
)
CATEGORY_SUFFIXES = (" TREATS ONLY", " LITTER", " FOOD")
METRIC_TYPES = (("_mean", "mean"), ("_rank_1st", "rank_1st"), ("_net", "net"))
SCORECARD_COLUMNS = (
    "brand",
    "category",
    "price_class",
    "equity_pillar",
    "metric_type",
    "metric_name",
    "date",
    "metric_raw_value",
    "weight",
    "scaled_scores",
)
ROUNDING = {"metric_raw_value": 5, "weight": 5, "scaled_scores": 2}

# Model ids: one spelling, used by every producer and every reader.
RIDGE = "ridge"
FOREST = "random_forest"
BOOSTED = "boosted_trees"


@dataclass(frozen=True)
class TreeGrid:
    """Candidate settings of a tree ensemble."""

    max_depth: tuple[int, ...]
    n_trees: tuple[int, ...]
    max_features: tuple[int, ...] = ()
    learning_rate: tuple[float, ...] = ()


@dataclass(frozen=True)
class ModelSpec:
    """One driver-model stage: which models run, their grids, and how rows are split."""

    run: tuple[str, ...] = (RIDGE,)
    alphas: tuple[float, ...] = (0.001, 0.01, 0.1, 1.0, 5.0, 10.0)
    positive: bool = False
    folds: int = 4
    time_split: bool = False
    log_dv: bool = False
    lags: bool = False
    price_and_distribution: bool = False
    standardize: bool = False
    selection: str = "all"
    forest: TreeGrid = TreeGrid((2, 3, 4), (15, 50, 100, 300, 500), (2, 4, 10))
    boosted: TreeGrid = TreeGrid((2, 3), (100, 500, 1000, 1500), (), (0.01, 0.02))

    @property
    def published(self) -> str:
        """The model whose results are published: ridge where it runs, else the first."""
        return RIDGE if RIDGE in self.run or not self.run else self.run[0]


@dataclass(frozen=True)
class RefreshSpec:
    """Everything a refresh needs to know besides its input tables."""

    grain: str = "weekly"
    mode: str = "model_refresh"
    start_date: dt.date = dt.date(2022, 1, 8)
    end_date: dt.date = dt.date(2023, 9, 30)
    dv: str = "market_share_total_sales"
    rollup_vendor: str | None = None
    market: str | None = None
    pooled_pillars: tuple[str, ...] = PILLARS_POOLED
    category_pillars: tuple[str, ...] = PILLARS_BY_CATEGORY
    categories: tuple[str, ...] = ()
    high_null_categories: tuple[str, ...] = ()
    null_pct: int = 50
    high_null_pct: int = 90
    scaling: str = "bounds"
    cap: bool = True
    equal_weight_pillars: tuple[str, ...] = ("awareness",)
    loading_excluded_pillars: tuple[str, ...] = ("advocacy",)
    loading_seed: int = 2
    sample_seeds: tuple[int, ...] = SAMPLE_SEEDS
    sample_pct: int = 95
    weight_by_dv: bool = True
    dv_lookback_months: int = 12
    min_rows: int = 20
    excluded_categories: tuple[str, ...] = ("CORPORATE",)
    dropped_patterns: tuple[str, ...] = ()
    forced_metrics: tuple[str, ...] = ()
    train_rows: int = 42
    holdout_rows: int = 6
    holdout_seed: int = 2
    counter_intuitive_cutoff: float = 0.30
    check_expected_sign: bool = False
    correlation_cutoff: float = 0.4
    top_features: int = 20
    deviation_pct: float = 5.0
    only_pillar_scores: bool = False
    weights_model: ModelSpec = ModelSpec()
    importance_model: ModelSpec = field(
        default_factory=lambda: ModelSpec(
            positive=True,
            folds=5,
            standardize=True,
            forest=TreeGrid((2, 3, 4, 5, 6), (15, 50, 100, 500), (2, 4, 10)),
            boosted=TreeGrid((2, 3), (500, 1000, 1500), (), (0.01, 0.005)),
        )
    )

    @property
    def trend_window(self) -> int:
        return 3 if self.grain == "monthly" else 13

    @property
    def pillars(self) -> tuple[str, ...]:
        return self.pooled_pillars + self.category_pillars
