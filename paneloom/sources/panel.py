"""Sales panel derived from order lines and their dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _cents(column: str) -> Column:
    """Whole hundredths of a non-negative amount; unlike `round` this needs no decimal objects."""
    return F.floor(F.col(column) * 100 + 0.5)


def sales_panel(spark: SparkSession, folder: str) -> DataFrame:
    """One row per ship date, supplier region (the store) and part brand (the product).

    Money is summed in whole cents, so totals do not depend on the order of addition. Supplier and
    part grow with the data: each joins as a bare table, so the planner sees its size and picks the
    join (and adaptive execution splits a hot part key). Nation and region are fixed at 25 and 5
    rows. The closing aggregate combines before its shuffle, and leaves at most one row per day in
    each series.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    regions = (
        table("nation")
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.col("r_name").alias("store_id"))
    )
    suppliers = table("supplier").select("s_suppkey", "s_nationkey")
    parts = table("part").select(
        "p_partkey", F.col("p_brand").alias("product_id"), "p_size", _cents("p_retailprice").alias("list_cents")
    )
    lines = table("lineitem").select(
        F.to_date("l_shipdate").alias("date"),
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        _cents("l_extendedprice").alias("sales_cents"),
        _cents("l_discount").alias("discount_pct"),
        "l_linestatus",
        "l_returnflag",
    )
    rows = F.count(F.lit(1)).cast("double")
    discount = F.sum("discount_pct").cast("double") / (100.0 * rows)
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(regions, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("date", "store_id", "product_id")
        .agg(
            F.sum("l_quantity").alias("units_sold"),
            (F.sum("sales_cents").cast("double") / (100.0 * F.sum("l_quantity"))).alias("price"),
            discount.alias("discount"),
            (F.sum("list_cents").cast("double") / (100.0 * rows)).alias("competitor_price"),
            F.sum("p_size").cast("double").alias("inventory_level"),
            F.when(F.sum("discount_pct") >= 5 * F.count(F.lit(1)), "yes").otherwise("no").alias("promotion"),
            # Flags rather than greatest texts: a text in the buffer would force a sorting aggregate.
            F.when(F.bool_or(F.col("l_returnflag") == "R"), "true")
            .when(F.bool_or(F.col("l_returnflag") == "N"), "false")
            .alias("holiday"),
            F.when(F.bool_or(F.col("l_linestatus") == "O"), "O").otherwise("F").alias("weather"),
            (F.sum("l_quantity") + F.sum("p_size")).cast("double").alias("demand_forecast"),
        )
    )
