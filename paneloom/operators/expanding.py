"""Median of all earlier rows of a series."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.operators.scaling import join_same, settle, with_position
from paneloom.operators.windows import CHUNK_ROWS, is_series
from paneloom.schema import DATE, SERIES

_PIVOTS = 256


def add_expanding_median(
    df: DataFrame,
    column: str,
    name: str,
    keys: Sequence[str] = SERIES,
    order: Sequence[str] = (DATE,),
    tiebreak: Sequence[str] = (),
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add the median of the non-null values in all earlier rows of the group; NULL if there are none.

    Such a median has no bounded look-back, and a window would recompute it per row. A series by
    day is one group of a task. Other groups (see `add_lookbacks` for `chunk_rows`) are cut into
    chunks of consecutive rows, which need only the earlier values near the middle.
    """
    if chunk_rows is not None or not is_series(keys, order):
        return _chunked(df, column, name, list(keys), list(order), list(tiebreak), chunk_rows or CHUNK_ROWS)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])
    by = [*order, *tiebreak]

    def running(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(by, kind="stable")
        rows[name] = rows[column].astype("float64").expanding().median().shift(1)
        return rows

    return df.groupBy(*keys).applyInPandas(running, schema)


def _value_blocks(values: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Number the value ranges of each group; a range has about `size` distinct values at most."""
    blocks = values.withColumn("block", F.lit(0).cast("long"))
    full = lambda: blocks.groupBy(*keys, "block").count().where(F.col("count") > size)
    while not full().isEmpty():
        blocks = settle(blocks)
        cell = [*keys, "block"]
        shares = [i / _PIVOTS for i in range(1, _PIVOTS)]
        pivots = blocks.groupBy(*cell).agg(
            F.percentile_approx("value", shares, 10_000).alias("pivots"), F.count(F.lit(1)).alias("distinct")
        )
        part = F.when(F.col("distinct") > size, F.size(F.filter("pivots", lambda p: p < F.col("value")))).otherwise(0)
        blocks = (
            join_same(blocks, pivots, cell)
            .withColumn("block", F.col("block") * _PIVOTS + part)
            .drop("pivots", "distinct")
        )
    return blocks


def _chunked(
    df: DataFrame, column: str, name: str, keys: list[str], order: list[str], tiebreak: list[str], chunk_rows: int
) -> DataFrame:
    """Exact medians from chunks of rows.

    Within a chunk of m rows the median can only move m/2 ranks from where the earlier rows left it.
    So each chunk receives the earlier values (with counts) of that rank band, found from counts per
    value range, and the number of values below the band.
    """
    placed = with_position(df, keys, order, tiebreak, "__position")
    placed = settle(placed.withColumn("__chunk", F.floor(F.col("__position") / chunk_rows)))
    known = placed.where(F.col(column).isNotNull())
    tallies = settle(
        known.groupBy(*keys, "__chunk", F.col(column).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    )
    blocks = settle(_value_blocks(tallies.select(*keys, "value").distinct(), keys, chunk_rows))
    tallies = settle(join_same(tallies, blocks, [*keys, "value"]))

    # Rows per chunk, and values known before it.
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*keys, "__chunk").agg(F.count(column).alias("m"))
    sizes = sizes.withColumn("earlier", F.coalesce(F.sum("m").over(before), F.lit(0)))

    # Earlier values per chunk and block: every chunk of a series meets every block of it.
    per_block = tallies.groupBy(*keys, "block", "__chunk").agg(F.sum("n").alias("n"))
    block_ids = per_block.groupBy(*keys).agg(F.collect_set("block").alias("blocks"))
    grid = join_same(sizes, block_ids, keys).withColumn("block", F.explode("blocks")).drop("blocks")
    counted = join_same(grid, per_block, [*keys, "__chunk", "block"], "left")
    so_far = Window.partitionBy(*keys, "block").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy(*keys, "__chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counted.withColumn("inside", F.coalesce(F.sum("n").over(so_far), F.lit(0))).withColumn(
        "start", F.coalesce(F.sum("inside").over(below), F.lit(0))
    )
    low = F.floor((F.col("earlier") - F.col("m") - 1) / 2)
    high = F.floor((F.col("earlier") + F.col("m")) / 2)
    band = ranks.where(
        (F.col("inside") > 0) & (F.col("start") <= high) & (F.col("start") + F.col("inside") > low)
    ).select(*keys, F.col("__chunk").alias("__target"), "block", "start")

    marks = band.groupBy(*keys, F.col("__target").alias("__chunk")).agg(F.min("start").alias("__below"))
    marks = join_same(sizes.select(*keys, "__chunk", "earlier"), marks, [*keys, "__chunk"], "left")
    values = (
        join_same(tallies, band.drop("start"), [*keys, "block"])
        .where(F.col("__chunk") < F.col("__target"))
        .groupBy(*keys, "__target", "value")
        .agg(F.sum("n").alias("__copies"))
        .withColumnRenamed("__target", "__chunk")
    )
    rows = join_same(placed, marks, [*keys, "__chunk"])
    input_rows = rows.withColumn("__copies", F.lit(None).cast("long")).unionByName(
        values.withColumnRenamed("value", "__value"), allowMissingColumns=True
    )
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])
    wanted = df.columns

    def medians(group: pd.DataFrame) -> pd.DataFrame:
        is_row = group["__position"].notna().to_numpy()
        chunk = group[is_row].sort_values("__position")
        earlier = group[~is_row].sort_values("__value")
        under = 0 if pd.isna(chunk["__below"].iloc[0]) else int(chunk["__below"].iloc[0])
        new = chunk[column].to_numpy(dtype="float64", na_value=np.nan)
        before = _stand_in(
            earlier["__value"].to_numpy(dtype="float64"), earlier["__copies"].to_numpy(dtype="int64"), under,
            int(chunk["earlier"].iloc[0]), int((~np.isnan(new)).sum()),
        )
        found = pd.Series(np.concatenate([before, new])).expanding().median().shift(1).to_numpy()[len(before) :]
        result = chunk[wanted].copy()
        result[name] = pd.array(found, dtype="Float64")
        return result

    return input_rows.groupBy(*keys, "__chunk").applyInPandas(medians, schema)


def _stand_in(values: np.ndarray, copies: np.ndarray, under: int, known: int, new: int) -> np.ndarray:
    """Few values with the same median as `known` earlier ones, now and after up to `new` more.

    `values` are those around the middle with their copies, `under` earlier ones are below all of them. Such a median
    moves at most new / 2 ranks, so only the ranks within `new` of the middle are kept, and an equal number of
    values is left out on both sides. What one side has more is stood in for by a value beyond all.
    """
    if not known:
        return np.zeros(0)
    low, high = max(0, known // 2 - new - 2), min(known, known // 2 + new + 3)
    ends = under + np.cumsum(copies)
    kept = np.clip(ends, low, high) - np.clip(ends - copies, low, high)
    inner = np.repeat(values, kept)
    first = max(low, under)
    below, above = first, known - first - len(inner)
    both = min(below, above)
    return np.concatenate([np.full(below - both, -np.finfo(float).max), inner, np.full(above - both, np.finfo(float).max)])
