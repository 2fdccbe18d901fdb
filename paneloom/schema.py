"""Column names and fixed vocabularies of the daily store-by-product sales panel."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

DATE = "date"
STORE = "store_id"
PRODUCT = "product_id"
UNITS = "units_sold"
PRICE = "price"

# Keys and columns of a panel.
SERIES = (STORE, PRODUCT)
PANEL_KEY = (DATE, STORE, PRODUCT)
BASE_COLUMNS = (DATE, STORE, PRODUCT, UNITS, PRICE)
NUMERIC_REQUIRED = (UNITS, PRICE)
NUMERIC_OPTIONAL = ("competitor_price", "discount", "inventory_level", "demand_forecast")
BOOLEAN_OPTIONAL = ("promotion", "holiday")
OPTIONAL_COLUMNS = (
    "competitor_price",
    "promotion",
    "discount",
    "holiday",
    "weather",
    "inventory_level",
    "demand_forecast",
)
PRICE_PLAN_COLUMNS = (DATE, STORE, PRODUCT, PRICE)

SPLITS = ("train", "validation", "test")

# Source column names accepted for each canonical column.
ALIASES = {
    DATE: ("date", "sale_date", "sales_date", "transaction_date", "date_sold"),
    STORE: ("store_id", "store", "branch", "branch_id"),
    PRODUCT: ("product_id", "sku", "item_id", "item", "product", "product_code"),
    UNITS: ("sales", "quantity_sold", "quantity", "qty", "units", "units_sold"),
    PRICE: ("price", "unit_price", "selling_price"),
    "competitor_price": ("competitorprice", "competitor_price"),
    "promotion": ("promo", "promotion", "is_promotion"),
    "holiday": ("is_holiday", "holiday"),
    "discount": ("discount_pct", "discount"),
    "weather": ("weather",),
    "inventory_level": ("inventory", "inventory_level"),
    "demand_forecast": ("forecast", "demand_forecast"),
}

# Texts read as true and as false.
TRUE_TEXTS = ("1", "true", "t", "yes", "y")
FALSE_TEXTS = ("0", "false", "f", "no", "n")

# Generated feature names.
CALENDAR_FEATURES = (
    "day_of_week",
    "day_of_month",
    "day_of_year",
    "week_of_year",
    "month",
    "quarter",
    "is_weekend",
    "is_month_start",
    "is_month_end",
)
DEMAND_LAGS = (1, 7, 14, 28)
DEMAND_ROLLINGS = {7: ("mean", "std", "min", "max"), 14: ("mean", "std"), 28: ("mean", "std")}
DEMAND_FEATURES = tuple(f"units_sold_lag_{k}" for k in DEMAND_LAGS) + tuple(
    f"units_sold_roll_{stat}_{window}" for window, stats in DEMAND_ROLLINGS.items() for stat in stats
)
PRICE_LAGS = (1, 7)
PRICE_FEATURES = (
    "price_lag_1",
    "price_lag_7",
    "price_change_1d",
    "price_change_7d",
    "price_roll_mean_7",
    "price_roll_std_7",
    "price_momentum_7",
    "price_momentum_28",
)
WARMUP_COLUMNS = (
    "units_sold_lag_28",
    "units_sold_roll_mean_28",
    "units_sold_roll_std_28",
    "price_lag_7",
    "price_roll_mean_7",
    "price_roll_std_7",
    "price_momentum_7",
    "price_momentum_28",
)
CORE_FEATURES = CALENDAR_FEATURES + DEMAND_FEATURES + PRICE_FEATURES


class PanelError(ValueError):
    """Input that breaks the panel contract."""


def require_columns(df: DataFrame, required: Iterable[str], what: str = "Dataset") -> None:
    """Fail with the sorted list of absent columns."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise PanelError(f"{what} is missing required columns: {', '.join(missing)}")
