"""Sales and price-plan readers, and table writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom.functions.scalars import as_date
from paneloom.schema import DATE, PRODUCT, STORE, PanelError, require_columns

_FORMATS = {".csv": "csv", ".parquet": "parquet", ".pq": "parquet"}


def _format_of(path: str) -> str:
    lowered = path.rstrip("/").lower()
    for extension, fmt in _FORMATS.items():
        if lowered.endswith(extension):
            return fmt
    raise PanelError(f"'{path}' ends neither in .csv nor in .parquet")


def _read(spark: SparkSession, path: str, fmt: str | None) -> DataFrame:
    fmt = fmt or _format_of(path)
    if fmt == "csv":
        # Text columns only: no extra pass over the file to guess types, `standardize` casts them.
        return spark.read.csv(path, header=True, escape='"')
    if fmt == "parquet":
        return spark.read.parquet(path)
    raise PanelError(f"Unsupported table format '{fmt}'. Use csv or parquet.")


def read_sales(
    spark: SparkSession, path: str, fmt: str | None = None, date_formats: Sequence[str] = ()
) -> DataFrame:
    """Read a sales table by extension; an unparseable `date` becomes NULL."""
    df = _read(spark, path, fmt)
    return df.withColumn(DATE, as_date(df, DATE, date_formats)) if DATE in df.columns else df


def read_price_plan(
    spark: SparkSession, path: str, fmt: str | None = None, date_formats: Sequence[str] = ()
) -> DataFrame:
    """Read a future price table; an unparseable `date` becomes NULL."""
    return read_sales(spark, path, fmt, date_formats)


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None
) -> str:
    """Write a folder of parquet or CSV files; `partition_by="split"` lets later reads prune splits."""
    if fmt not in ("parquet", "csv"):
        raise PanelError(f"Unsupported table format '{fmt}'. Use csv or parquet.")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if fmt == "csv":
        writer.csv(path, header=True, escape='"')
    else:
        writer.parquet(path)
    return path


def export_forecasts(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write scored rows as CSV (if a path is given) and return their row and column counts."""
    require_columns(df, (DATE, STORE, PRODUCT, "forecast_units"), "Forecast table")
    if path:
        write_table(df, path, "csv")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.lit(",".join(df.columns)).alias("columns"),
    )
