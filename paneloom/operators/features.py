"""Calendar, demand, price, inventory and exogenous features of a sales panel.

Look-back features go through `add_lookbacks`: they read earlier rows of the series only, and all
of them together share one exchange and one sort. `split` is passed on to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from paneloom.functions.scalars import as_date, as_double, calendar_part, clean_binary, safe_ratio, stripped
from paneloom.operators.quantiles import exact_medians
from paneloom.operators.scaling import dense_codes, join_same, settle
from paneloom.operators.windows import (
    Lookback,
    add_lookbacks,
    lag_features,
    lag_of,
    rolling_features,
    rolling_of,
)
from paneloom.schema import (
    BASE_COLUMNS,
    CALENDAR_FEATURES,
    CORE_FEATURES,
    DATE,
    DEMAND_LAGS,
    DEMAND_ROLLINGS,
    OPTIONAL_COLUMNS,
    PRICE,
    PRICE_LAGS,
    PRODUCT,
    STORE,
    UNITS,
    WARMUP_COLUMNS,
    PanelError,
    require_columns,
)

_PRIOR_PRICE_28 = "__price_mean_28"
_PRIOR_STOCK_28 = "__stock_median_28"


def calendar_features(df: DataFrame) -> DataFrame:
    return df.withColumns({part: calendar_part(part, F.col(DATE)) for part in CALENDAR_FEATURES})


def _demand_lookbacks() -> dict[str, Lookback]:
    return lag_features(UNITS, DEMAND_LAGS, UNITS) | rolling_features(UNITS, DEMAND_ROLLINGS, UNITS)


def demand_features(df: DataFrame) -> DataFrame:
    return add_lookbacks(df, _demand_lookbacks())


def _price_lookbacks() -> dict[str, Lookback]:
    return (
        lag_features(PRICE, PRICE_LAGS, PRICE)
        | rolling_features(PRICE, {7: ("mean", "std")}, PRICE)
        | {_PRIOR_PRICE_28: rolling_of(PRICE, 28, "mean")}
    )


def _price_derived() -> dict[str, Column]:
    price = F.col(PRICE)
    return {
        "price_change_1d": price - F.col("price_lag_1"),
        "price_change_7d": price - F.col("price_lag_7"),
        "price_momentum_7": safe_ratio(price, F.col("price_roll_mean_7")),
        "price_momentum_28": safe_ratio(price, F.col(_PRIOR_PRICE_28)),
    }


def price_features(df: DataFrame) -> DataFrame:
    return add_lookbacks(df, _price_lookbacks()).withColumns(_price_derived()).drop(_PRIOR_PRICE_28)


def _passed_on(df: DataFrame) -> list[str]:
    return [c for c in ("discount", "demand_forecast") if c in df.columns]


def _check_numeric(df: DataFrame, columns: Sequence[str]) -> None:
    if not columns:
        return
    _raise_missing(columns, df.agg(*_missing_numbers(df, columns)).first().asDict())


def _missing_numbers(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [F.count_if(as_double(df, c).isNull()).alias(c) for c in columns]


def _raise_missing(columns: Sequence[str], bad: dict) -> None:
    for name in columns:
        if bad[name]:
            raise PanelError(f"Column '{name}' contains {bad[name]} values that are missing or no numbers")


def passthrough_features(df: DataFrame, check: bool = True) -> DataFrame:
    """Carry discount and demand_forecast as doubles; a NULL in either is an error."""
    names = _passed_on(df)
    if check:
        _check_numeric(df, names)
    return df.withColumns({c: as_double(df, c) for c in names}) if names else df


def _inventory_lookbacks() -> dict[str, Lookback]:
    return {_PRIOR_STOCK_28: rolling_of("inventory_level", 28, "median", min_rows=7)}


def _inventory_derived(fallback: Column) -> dict[str, Column]:
    stock = F.col("inventory_level")
    threshold = F.greatest(F.lit(0.0), F.coalesce(F.col(_PRIOR_STOCK_28), fallback) * 0.5)
    return {
        "low_inventory_flag": F.coalesce((stock <= threshold).cast("int"), F.lit(0)),
        "stockout_proxy": F.coalesce(((stock <= 0) & (F.col(UNITS) <= 0)).cast("int"), F.lit(0)),
    }


def inventory_features(
    df: DataFrame, fallback_from: DataFrame | None = None, check: bool = True
) -> DataFrame:
    """Low-stock flag and stock-out proxy; with `check`, a missing stock level is an error.

    Where fewer than 7 of the prior 28 rows are known the threshold is half the median over the
    whole table, later dates included; pass the training rows as `fallback_from` to avoid that.
    """
    if check:
        _check_numeric(df, ["inventory_level"])
    source = df if fallback_from is None else fallback_from
    median = exact_medians(source, ["inventory_level"]).scalar()
    return (
        add_lookbacks(df, _inventory_lookbacks())
        .withColumns(_inventory_derived(median))
        .drop(_PRIOR_STOCK_28)
    )


def exogenous_features(df: DataFrame, check: bool = True) -> DataFrame:
    """Price against the competitor, and promotion and holiday as 1.0 / 0.0 / NULL.

    With `check`, a missing competitor price is an error.
    """
    if "competitor_price" in df.columns:
        if check:
            _check_numeric(df, ["competitor_price"])
        rival = as_double(df, "competitor_price")
        gap = F.col(PRICE) - rival
        df = df.withColumns(
            {
                "competitor_price": rival,
                "price_vs_competitor_abs": gap,
                "price_vs_competitor_pct": safe_ratio(gap, rival),
            }
        )
    flags = {c: clean_binary(F.col(c)) for c in ("promotion", "holiday") if c in df.columns}
    return df.withColumns(flags) if flags else df


def weather_code(df: DataFrame) -> DataFrame:
    """Rank of the trimmed lower-case weather text among all texts; NULL counts as `missing`."""
    text = F.coalesce(F.lower(stripped(F.col("weather"))), F.lit("missing"))
    keyed = df.withColumn("__weather", text)
    return join_same(keyed, dense_codes(keyed, "__weather", "weather_code"), ["__weather"], "left").drop(
        "__weather"
    )


def trim_warmup(df: DataFrame, required: Sequence[str] = WARMUP_COLUMNS) -> DataFrame:
    require_columns(df, required, "Feature table")
    return df.dropna(subset=list(required))


def generated_columns(df: DataFrame) -> list[str]:
    """Names `manual_features` generates for the columns present in `df`."""
    optional = {
        "inventory_level": ["inventory_level", "low_inventory_flag", "stockout_proxy"],
        "competitor_price": ["competitor_price", "price_vs_competitor_abs", "price_vs_competitor_pct"],
        "promotion": ["promotion"],
        "holiday": ["holiday"],
        "weather": ["weather_code"],
    }
    names = [*CORE_FEATURES, *_passed_on(df)]
    for source, features in optional.items():
        if source in df.columns:
            names += features
    return names


def manual_features(
    df: DataFrame, drop_warmup: bool = True, check: bool = True
) -> DataFrame:
    """Base columns and every feature the present columns allow, without warm-up rows.

    With `check`, the features are written once; missing numbers, counted in that pass, and a table too short for 28-row
    history are errors.
    """
    require_columns(df, BASE_COLUMNS, "Feature input")
    numeric = [UNITS, PRICE, *_passed_on(df)] + [
        c for c in ("inventory_level", "competitor_price") if c in df.columns
    ]
    seen = Observation()
    source = df.observe(seen, *_missing_numbers(df, numeric)) if check else df
    frame = source.withColumns(
        {DATE: as_date(df, DATE), STORE: stripped(F.col(STORE)), PRODUCT: stripped(F.col(PRODUCT))}
        | {c: as_double(df, c) for c in numeric}
    )
    stocked = "inventory_level" in df.columns
    lookbacks = _demand_lookbacks() | _price_lookbacks() | (_inventory_lookbacks() if stocked else {})
    result = calendar_features(add_lookbacks(frame, lookbacks)).withColumns(_price_derived())
    if stocked:
        median = exact_medians(df.select(as_double(df, "inventory_level").alias("inventory_level")), ["inventory_level"]).scalar()
        result = result.withColumns(_inventory_derived(median))
    result = exogenous_features(result, check=False)
    if "weather" in df.columns:
        result = weather_code(result)
    features = result.select(*dict.fromkeys([*BASE_COLUMNS, *generated_columns(df)]))
    if drop_warmup:
        features = trim_warmup(features)
    if check:
        features = settle(features)
        _raise_missing(numeric, seen.get)
        if features.isEmpty():
            raise PanelError("No feature rows remain: there is not enough history for 28-row lags.")
    return features


def create_features_compat(
    df: DataFrame, lags: Sequence[int] = (1, 7, 14), rolling_window: int = 7
) -> DataFrame:
    """Small feature set: demand lags, a rolling mean from one row on, logs, weekday and month."""
    if rolling_window <= 0:
        raise PanelError("rolling_window has to be 1 or more")
    lookbacks = {f"units_lag_{k}": lag_of(UNITS, k) for k in sorted({int(k) for k in lags if int(k) > 0})}
    lookbacks[f"units_roll_mean_{rolling_window}"] = rolling_of(UNITS, rolling_window, "mean", min_rows=1)
    return add_lookbacks(df, lookbacks).withColumns(
        {
            "log_units": F.log(F.col(UNITS) + 1.0),
            "log_price": F.log(PRICE),
            "day_of_week": calendar_part("day_of_week", F.col(DATE)),
            "month": calendar_part("month", F.col(DATE)),
        }
    )


def feature_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before and after warm-up, features made, optional columns used and skipped."""
    used = [c for c in OPTIONAL_COLUMNS if c in before.columns]
    skipped = [c for c in OPTIONAL_COLUMNS if c not in before.columns]
    kept = after.agg(F.count(F.lit(1))).scalar()
    return before.agg(F.count(F.lit(1)).alias("rows_before")).select(
        "rows_before",
        kept.alias("rows_after"),
        (F.col("rows_before") - kept).alias("rows_dropped"),
        F.lit(len(generated_columns(before))).cast("long").alias("feature_count"),
        F.lit(",".join(used)).alias("optional_columns_used"),
        F.lit(",".join(skipped)).alias("columns_skipped"),
    )
