"""Helpers that keep work split when one group holds a large share of the rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`, which the driver and all executors must share."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder


def _delete_at_end(spark: SparkSession, folder: str) -> None:
    """Have the driver's JVM delete a folder when it ends, whether the session was stopped before or not."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)


def settle(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage: Parquet in the shared folder, deleted when the driver ends.

    Later reads scan the columns they use only, and the planner knows the size.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/paneloom-settled/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    _delete_at_end(spark, folder)
    return spark.read.schema(df.schema).parquet(folder)


def settle_observed(df: DataFrame, counts: Sequence[Column], rest: Callable[[DataFrame], DataFrame] = lambda d: d) -> tuple[DataFrame, dict]:
    """`settle(rest(df))`, and aggregates over the rows of `df` taken in the same pass."""
    seen = Observation()
    settled = settle(rest(df.observe(seen, *counts)))
    return settled, seen.get


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which two NULL keys count as equal; the left key columns are kept."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    condition = reduce(
        Column.__and__, [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"__right_{k}" for k in keys])


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tiebreak: Sequence[str] = (),
    name: str = "position",
    total: str | None = None,
) -> DataFrame:
    """Zero-based row number within `keys` by `order` then `tiebreak`, without one task per key.

    Rows are sorted over ranges of all these columns and written with a number; the rows of each key in each range are
    counted, and a prefix sum over a key's ranges gives where its rows start. A range ends anywhere in a
    key, so only rows equal in all the columns stay together. `total` also adds the number of rows of the key.
    """
    keys, by = list(keys), [*keys, *order, *tiebreak]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by) if by else df
    numbered = settle(ranged.withColumn("__id", F.monotonically_increasing_id()))
    placed = numbered.withColumn("__slot", F.shiftright("__id", 33))  # the range; the lower bits count in it
    counts = placed.groupBy(*keys, "__slot").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    columns = [F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")]
    if total:
        columns.append(F.sum("__n").over(Window.partitionBy(*keys)).alias(total))
    starts = counts.select(*keys, "__slot", "__first", *columns)
    joined = join_same(placed, starts, [*keys, "__slot"]).withColumn(name, F.col("__start") + F.col("__id") - F.col("__first"))
    return joined.drop("__id", "__slot", "__first", "__start")


def dense_codes(df: DataFrame, column: str, code: str) -> DataFrame:
    """Distinct non-null values with their 0-based rank in ascending order, from a distributed sort."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    # The sorted ids carry their partition in the upper 31 bits and the offset in the lower 33.
    ordered = settle(values.orderBy(column).withColumn("__id", F.monotonically_increasing_id()))
    slot = F.shiftright("__id", 33)
    sizes = ordered.groupBy(slot.alias("__slot")).agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition of the sort.
    before = Window.partitionBy(F.lit(0)).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__slot", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    offset = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ordered.withColumn("__slot", slot)
        .join(starts, "__slot")
        .select(column, (F.col("__start") + offset).cast("double").alias(code))
    )
