"""Row-wise column expressions; all stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.schema import FALSE_TEXTS, TRUE_TEXTS, PanelError

WHITESPACE = " \t\n\r\x0b\x0c"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity)$"


def stripped(column: Column) -> Column:
    return F.btrim(column.cast("string"), F.lit(WHITESPACE))


def as_double(df: DataFrame, name: str) -> Column:
    """The column as double; text that is no number and NaN both become NULL."""
    kind = df.schema[name].dataType
    value = F.col(name)
    if isinstance(kind, T.StringType):
        text = stripped(value)
        # The pattern keeps out Java suffixes such as "1d", and spares an exception per bad text.
        value = F.when(text.rlike(NUMBER), text.try_cast("double"))
    elif not isinstance(kind, T.DoubleType):
        value = value.cast("double")
    if isinstance(kind, (T.StringType, T.FloatType, T.DoubleType)):
        value = F.nanvl(value, F.lit(None).cast("double"))
    return value


def as_date(df: DataFrame, name: str, formats: Iterable[str] = ()) -> Column:
    """The column as a calendar day; text is tried as ISO first, then in the given formats."""
    kind = df.schema[name].dataType
    if not isinstance(kind, T.StringType):
        return F.to_date(F.col(name))
    text = stripped(F.col(name))
    parsed = [F.try_to_timestamp(text)]
    parsed += [F.try_to_timestamp(text, F.lit(pattern)) for pattern in formats]
    return F.to_date(F.coalesce(*parsed))


def as_boolean(column: Column) -> Column:
    text = F.lower(stripped(column))
    return F.when(text.isin(*TRUE_TEXTS), True).when(text.isin(*FALSE_TEXTS), False)


def clean_binary(column: Column) -> Column:
    """1.0 for a true text, 0.0 for a false text, otherwise NULL."""
    text = F.lower(stripped(column))
    return F.when(text.isin(*TRUE_TEXTS), 1.0).when(text.isin(*FALSE_TEXTS), 0.0)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, or NULL where the denominator is missing or not positive."""
    return F.when(denominator > 0, numerator / denominator)


def log_offset(column: Column, epsilon: float) -> Column:
    """ln(x + epsilon). `check_log_domain` rejects values below -epsilon beforehand."""
    if epsilon <= 0:
        raise PanelError("epsilon must be strictly positive")
    shifted = column + F.lit(float(epsilon))
    # Exactly -epsilon passes the domain check; its logarithm is minus infinity.
    return F.when(shifted == 0, F.lit(float("-inf"))).otherwise(F.log(shifted))


def check_log_domain(df: DataFrame, columns: Iterable[str], epsilon: float) -> None:
    """One aggregate over all columns; fails if a value makes ln(x + epsilon) undefined."""
    if epsilon <= 0:
        raise PanelError("epsilon must be strictly positive")
    names = list(columns)
    bad = df.agg(*[F.count_if(F.col(c) < -epsilon).alias(c) for c in names]).first()
    for name in names:
        if bad[name]:
            raise PanelError(f"safe_log received {bad[name]} values of '{name}' below -epsilon")


def segment_label(keys: Iterable[str]) -> Column:
    """Text key such as `store_id=S1|product_id=P1`."""
    return F.concat_ws("|", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys])


def calendar_part(part: str, date: Column) -> Column:
    """One integer calendar feature of a date."""
    expressions = {
        "day_of_week": lambda: F.weekday(date),
        "day_of_month": lambda: F.dayofmonth(date),
        "day_of_year": lambda: F.dayofyear(date),
        "week_of_year": lambda: F.weekofyear(date),
        "month": lambda: F.month(date),
        "quarter": lambda: F.quarter(date),
        "is_weekend": lambda: (F.weekday(date) >= 5).cast("int"),
        "is_month_start": lambda: (F.dayofmonth(date) == 1).cast("int"),
        "is_month_end": lambda: (date == F.last_day(date)).cast("int"),
    }
    return expressions[part]()
