"""Column names, types, value checks and duplicates of a raw sales table."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.functions.scalars import as_boolean, as_date, as_double, check_log_domain, log_offset, stripped
from paneloom.operators.scaling import settle_observed
from paneloom.schema import (
    ALIASES,
    BASE_COLUMNS,
    BOOLEAN_OPTIONAL,
    DATE,
    NUMERIC_OPTIONAL,
    NUMERIC_REQUIRED,
    OPTIONAL_COLUMNS,
    PRICE,
    PRODUCT,
    STORE,
    UNITS,
    PanelError,
    require_columns,
)

_CANONICAL = {alias: name for name, aliases in ALIASES.items() for alias in aliases}


def snake_case(name: str) -> str:
    """Words of a header in lower case; a word ends at other signs and before a capital after a small letter or digit."""
    runs = re.findall("[0-9A-Za-z]+", name)
    return "_".join(word for run in runs for word in re.split("(?<=[a-z0-9])(?=[A-Z])", run)).lower()


def canonical_name(name: str) -> str:
    """Canonical column for a raw header, or its snake_case form when there is none."""
    plain = snake_case(name)
    return _CANONICAL.get(plain, plain)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename to canonical names; two source columns for one name are an error."""
    sources = defaultdict(list)
    for name in df.columns:
        sources[canonical_name(name)].append(name)
    clashes = [f"{target} <- {', '.join(names)}" for target, names in sources.items() if len(names) > 1]
    if clashes:
        raise PanelError("Several source columns map to the same canonical name: " + "; ".join(clashes))
    return df.toDF(*[canonical_name(name) for name in df.columns])


def _typed(df: DataFrame, date_formats: Sequence[str]) -> DataFrame:
    typed: dict[str, Column] = {DATE: as_date(df, DATE, date_formats)}
    for name in (*NUMERIC_REQUIRED, *NUMERIC_OPTIONAL):
        if name in df.columns:
            typed[name] = as_double(df, name)
    for name in BOOLEAN_OPTIONAL:
        if name in df.columns:
            typed[name] = as_boolean(F.col(name))
    for name in (STORE, PRODUCT):
        typed[name] = stripped(F.col(name))
    return df.withColumns(typed)


def _canonical(df: DataFrame, date_formats: Sequence[str]) -> DataFrame:
    named = normalize_columns(df)
    require_columns(named, BASE_COLUMNS)
    return _typed(named, date_formats)


def _check_columns() -> list[Column]:
    """One count per check, in the order in which the checks are reported."""
    checks = {
        "invalid_dates": F.col(DATE).isNull(),
        "non_numeric_units_sold": F.col(UNITS).isNull(),
        "non_numeric_price": F.col(PRICE).isNull(),
        "empty_store_id": F.col(STORE).isNull() | (F.col(STORE) == ""),
        "empty_product_id": F.col(PRODUCT).isNull() | (F.col(PRODUCT) == ""),
        "negative_units_sold": F.col(UNITS) < 0,
        "non_positive_price": F.col(PRICE) <= 0,
    }
    return [F.count_if(test).alias(name) for name, test in checks.items()]


_MESSAGES = {
    "invalid_dates": "Column 'date' contains {} invalid date values.",
    "non_numeric_units_sold": "Column 'units_sold' has {} values that cannot be parsed as numeric.",
    "non_numeric_price": "Column 'price' has {} values that cannot be parsed as numeric.",
    "empty_store_id": "Column 'store_id' has {} missing or empty values.",
    "empty_product_id": "Column 'product_id' has {} missing or empty values.",
    "negative_units_sold": "Column 'units_sold' has {} negative values.",
    "non_positive_price": "Column 'price' has {} non-positive values.",
}


def validation_report(df: DataFrame, date_formats: Sequence[str] = ()) -> DataFrame:
    """Counts of rule violations in a raw table, from one pass."""
    return _canonical(df, date_formats).agg(*_check_columns())


def _raise_first(found: dict) -> None:
    for name, message in _MESSAGES.items():
        if found[name]:
            raise PanelError(message.format(found[name]))


def standardize(df: DataFrame, date_formats: Sequence[str] = (), check: bool = True) -> DataFrame:
    """Canonical names and types. With `check`, the table is written once, and the first rule found broken on the way is raised."""
    typed = _canonical(df, date_formats)
    if not check:
        return typed
    settled, found = settle_observed(typed, _check_columns())
    _raise_first(found)
    return settled


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each set of fully equal rows; the copies are combined before the shuffle."""
    return df.dropDuplicates()


def canonical_sort(df: DataFrame) -> DataFrame:
    """Order by store, product and date, for output only: windows order their own rows."""
    return df.orderBy(STORE, PRODUCT, DATE)


def data_summary(df: DataFrame, raw: DataFrame | None = None, distinct: bool = False) -> DataFrame:
    """One row: size, date range, distinct ids, zero-demand rate and NULL count per column.

    Figures are first combined per series and then over the series, so the distinct counts run on
    one row per series and the table is read once. `raw` is the table before duplicate removal; its
    surplus rows are the duplicates removed. With `distinct`, `df` itself may hold duplicates: the figures are those of its
    distinct rows, and copies are counted as they are combined.
    """
    nulls = {f"missing_{c}": F.count_if(F.col(c).isNull()) for c in df.columns}
    source, copies = df, F.lit(1)
    if distinct:
        source, copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies")), F.col("__copies")
    per_series = source.groupBy(STORE, PRODUCT).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(copies).alias("all"),
        F.min(DATE).alias("first"),
        F.max(DATE).alias("last"),
        F.count_if(F.col(UNITS) == 0).alias("zeros"),
        *[count.alias(name) for name, count in nulls.items()],
    )
    rows = F.coalesce(F.sum("n"), F.lit(0))
    before = F.coalesce(F.sum("all"), F.lit(0)) if raw is None else raw.agg(F.count(F.lit(1))).scalar()
    return per_series.agg(
        rows.alias("total_row_count"),
        F.lit(len(df.columns)).cast("long").alias("total_column_count"),
        F.min("first").alias("min_date"),
        F.max("last").alias("max_date"),
        F.coalesce(F.sum("zeros") / F.sum("n"), F.lit(0.0)).alias("zero_demand_rate"),
        F.count_distinct(STORE).alias("number_of_stores"),
        F.count_distinct(PRODUCT).alias("number_of_products"),
        F.lit(",".join(sorted(set(OPTIONAL_COLUMNS) & set(df.columns)))).alias("optional_columns_detected"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in nulls],
        (before - rows).alias("duplicate_row_count_removed"),
    )


def clean_sales(df: DataFrame, date_formats: Sequence[str] = (), check: bool = True) -> DataFrame:
    """Standardized rows without exact duplicates. Use `canonical_sort` before writing in order.

    With `check`, typing, rules and the removal of copies are one pass that writes the result.
    """
    typed = _canonical(df, date_formats)
    if not check:
        return drop_exact_duplicates(typed)
    settled, found = settle_observed(typed, _check_columns(), drop_exact_duplicates)
    _raise_first(found)
    return settled


def safe_log(df: DataFrame, columns: dict[str, str], epsilon: float) -> DataFrame:
    """Add `ln(x + epsilon)` for each {output: input}; values below -epsilon are an error."""
    check_log_domain(df, columns.values(), epsilon)
    return df.withColumns({out: log_offset(F.col(source), epsilon) for out, source in columns.items()})
