"""One-step-ahead naive forecasts.

A target row sees every earlier actual of its series, earlier target rows included. Where a series
has no history yet, the forecast is the median target over the history splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.functions.scalars import as_double
from paneloom.operators.expanding import add_expanding_median
from paneloom.operators.quantiles import exact_medians
from paneloom.operators.windows import Lookback, add_lookbacks, lag_of, rolling_of
from paneloom.schema import PANEL_KEY, UNITS, PanelError, require_columns

BASELINES = ("naive_last", "seasonal_naive_7", "rolling_mean_7", "rolling_mean_28", "median_expanding")

_ROLLING = {"rolling_mean_7": 7, "rolling_mean_28": 28}
_EXPANDING = "median_expanding"


def _with_forecasts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    lookbacks: dict[str, Lookback] = {}
    if {"naive_last", "seasonal_naive_7"} & set(names):
        lookbacks["__lag_1"] = lag_of("actual", 1)
    if "seasonal_naive_7" in names:
        lookbacks["__lag_7"] = lag_of("actual", 7)
    for name in names:
        if name in _ROLLING:
            lookbacks[f"__{name}"] = rolling_of("actual", _ROLLING[name], "mean", min_rows=1)
    frame = add_lookbacks(df, lookbacks)
    # Last, so that it follows the exchange and sort of the windows.
    return add_expanding_median(frame, "actual", "__median") if _EXPANDING in names else frame


def _forecast(name: str) -> Column:
    if name == "naive_last":
        return F.col("__lag_1")
    if name == "seasonal_naive_7":
        return F.coalesce("__lag_7", "__lag_1")
    return F.col("__median") if name == _EXPANDING else F.col(f"__{name}")


def baseline_suite(
    df: DataFrame, target: str = UNITS, names: Sequence[str] = BASELINES
) -> DataFrame:
    """All baselines for the validation and test rows of a split-tagged panel, in long form.

    Every forecast is computed once over the whole panel: the rows before a validation row are
    train and validation rows, and those before a test row may be from all three splits.
    """
    unknown = [n for n in names if n not in BASELINES]
    if unknown:
        raise PanelError(f"Unsupported baseline '{unknown[0]}'. Allowed values: {', '.join(BASELINES)}")
    require_columns(df, (*PANEL_KEY, "split", target), "Baseline input")
    panel = df.select(*PANEL_KEY, "split", as_double(df, target).alias("actual"))
    known = {
        "validation": F.when(F.col("split") == "train", F.col("actual")),
        "test": F.when(F.col("split").isin("train", "validation"), F.col("actual")),
    }
    medians = exact_medians(panel.select(*[c.alias(n) for n, c in known.items()]), list(known))
    fallback = F.when(F.col("split") == "validation", medians.select("validation").scalar()).otherwise(
        medians.select("test").scalar()
    )
    scored = _with_forecasts(panel, names).where(F.col("split").isin("validation", "test"))
    wide = scored.select(
        *PANEL_KEY, "split", "actual", *[F.coalesce(_forecast(n), fallback, F.lit(0.0)).alias(n) for n in names]
    )
    return wide.unpivot([*PANEL_KEY, "split", "actual"], list(names), "model_name", "prediction").withColumn(
        "model_family", F.lit("baseline")
    )


def baseline(df: DataFrame, name: str, target: str = UNITS) -> DataFrame:
    """One baseline, in the same long form."""
    return baseline_suite(df, target, [name])
