"""Schemas of the tables that pass between operators."""

SALES_FACT = (
    "market_key bigint, product_key bigint, period_key bigint, dollars double, base_dollars double, "
    "pounds double, base_pounds double, units double, base_units double, pct_acv double"
)
PERIODS = "period_key bigint, period_weeks int, week_ending date"
MARKETS = "market_key bigint, market_description string"
PRODUCTS = "product_key bigint, vendor string, brand string, category string"
HARMONISED_LONG = (
    "brand string, category string, date date, data_source string, metric_type string, "
    "metric_name string, user_segment string, metric_value double"
)
PANEL_LONG = "brand string, category string, date date, var string, value double"
METRIC_DICTIONARY = (
    "category string, var string, metric_name string, data_source string, vendor_group string, "
    "pillar string, select_flag string, min double, max double, expected_sign string"
)
BRAND_LIST = "brand string, category string"
METRIC_RENAME = "old_name string, new_name string"
INVERSE_RULES = "operation string, raw_cols string, `values` string, new_name string"
DASHBOARD_NAMES = "scorecard_attribute string, scorecard_attribute_updated string"
PRICE_CLASS = "brand string, category string, price_class string"
CATEGORY_MOVE = "brand string, from_category string, to_category string"
CATEGORY_PARENT = "category_new string, category string"
WEIGHTS_SHEET = "category string, pillar string, metric string, weight double"
FACTOR_FIT = (
    "category string, pillar string, seed int, op string, var string, est_std double, cfi double, "
    "tli double, rmsea double, n_rows bigint, status string"
)
ATTRIBUTIONS = (
    "brand string, category string, pillar string, var string, model string, attribution double"
)
