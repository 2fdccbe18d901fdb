"""A sample of the registered queries against their SQL, and the plans they make."""

from pathlib import Path

import duckdb
import pytest

from checks.oracles import all_oracles
from checks.queries import all_queries
from checks.verify import compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are absent")
SAMPLE = (
    "clean_sales", "data_summary", "backtest_frame", "price_features", "inventory_features", "manual_features", "audit_plan",
    "materialize_plan", "baseline_suite", "segment_metrics", "best_model_registry", "model_matrix", "train_per_product", "train_gbt",
    "evaluate_models", "forecast_next", "price_plan_forecast", "residuals_random_forest", "dml_elasticity", "elasticity_estimates",
    "elasticity_estimates_linear", "describe", "column_histogram",
)


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, database, name):
    found = all_queries()[name](spark, FOLDER).toPandas()
    assert compare(found, database.execute(all_oracles()[name]).fetch_df()) == ""


def test_every_oracle_has_a_query():
    assert set(all_oracles()) <= set(all_queries())


def test_plan_reads_needed_columns_and_broadcasts_small_tables_only(spark):
    plan = all_queries()["group_lag"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    lines = next(part for part in plan.splitlines() if "lineitem.parquet" in part)
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in lines
    assert "IsNotNull(l_partkey)" in lines
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_the_settled_panel_is_scanned_for_the_columns_used_only(spark):
    from checks.queries import panel
    from paneloom.operators import explore

    plan = explore.coverage(panel(spark, FOLDER))._jdf.queryExecution().executedPlan().toString()
    schemas = [part for part in plan.splitlines() if "paneloom-settled" in part and "ReadSchema" in part]
    assert schemas and all("units_sold" in s or "struct<date:date>" in s for s in schemas)
    assert not any(c in s for s in schemas for c in ("price", "discount", "inventory_level", "weather"))


def test_checks_write_what_they_return(spark):
    """The pass that cleans also counts broken rules; what is returned reads the written table."""
    from checks.queries import raw_sales
    from paneloom.operators import clean

    plan = clean.clean_sales(raw_sales(spark, FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "paneloom-settled" in plan
