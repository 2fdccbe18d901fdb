"""First-look aggregates and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.operators.quantiles import exact_quantiles
from paneloom.schema import DATE, PRODUCT, STORE, UNITS


def coverage(df: DataFrame) -> DataFrame:
    """One row: date range, distinct days, stores and products, zero-demand rate.

    Stores and products are counted over one row per series; the days need a second, narrow pass.
    """
    per_series = df.groupBy(STORE, PRODUCT).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(DATE).alias("first"),
        F.max(DATE).alias("last"),
        F.count_if(F.col(UNITS) == 0).alias("zeros"),
    )
    days = df.select(DATE).distinct().agg(F.count(DATE)).scalar()
    return per_series.agg(
        F.min("first").alias("min_date"),
        F.max("last").alias("max_date"),
        F.coalesce(F.sum("zeros") / F.sum("n"), F.lit(0.0)).alias("zero_demand_rate"),
        F.count_distinct(STORE).alias("n_stores"),
        F.count_distinct(PRODUCT).alias("n_products"),
    ).withColumn("n_days", days)


def rows_per_key(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The n ids with most rows; ties go to the first id."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), key).limit(n)


def column_histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts in equal-width bins from the minimum to the maximum, empty bins included.

    The last bin is closed. If all values are equal the range is widened by half on both sides.
    """
    values = df.select(F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull())
    limits = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    pad = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    limits = limits.select((F.col("lo") - pad).alias("lo"), (F.col("hi") + pad).alias("hi"))
    lo, hi = limits.select("lo").scalar(), limits.select("hi").scalar()
    width = (hi - lo) / float(bins)
    binned = values.select(F.least(F.lit(bins - 1), F.floor((F.col("x") - lo) / width)).cast("int").alias("bin"))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    edges = limits.where(F.col("lo").isNotNull()).select(
        "lo", ((F.col("hi") - F.col("lo")) / float(bins)).alias("width"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("lower_edge"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("upper_edge"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def error_histogram(
    predictions: DataFrame, model: str, split: str = "validation", bins: int = 30
) -> DataFrame:
    """Histogram of one model's absolute errors in one split."""
    rows = predictions.where((F.col("model_name") == model) & (F.col("split") == split))
    return column_histogram(rows, "prediction_abs_error", bins)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column."""
    columns = list(columns)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])
    long = df.select(F.explode(pairs).alias("pair")).select("pair.column", "pair.x")
    moments = long.groupBy("column").agg(
        F.count("x").alias("count"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    shares = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    row = exact_quantiles(df, {f"{c}_{name}": (c, q) for c in columns for name, q in shares.items()})
    cells = [F.struct(F.lit(c).alias("column"), *[F.col(f"{c}_{name}").alias(name) for name in shares]) for c in columns]
    quartiles = row.select(F.inline(F.array(*cells)))
    return moments.join(quartiles, "column", "left")
