import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneloom.operators import dml, elasticity
from paneloom.schema import PanelError

from helpers import day, rows

SALES = "date date, store_id string, product_id string, units_sold double, price double"


def _history(spark, product, prices, units):
    return spark.createDataFrame([(day(i), "S", product, u, p) for i, (p, u) in enumerate(zip(prices, units))], SALES)


def test_loglog_recovers_the_slope(spark):
    prices = [1.0 + 0.5 * i for i in range(10)]
    curve = _history(spark, "curve", prices, [1000 * p**-2 for p in prices])
    flat_price = _history(spark, "flat_price", [3.0] * 10, [float(i) for i in range(10)])
    flat_units = _history(spark, "flat_units", prices, [7.0] * 10)
    short = _history(spark, "short", prices[:7], prices[:7])
    fits = {r["product_id"]: r for r in elasticity.loglog_elasticity(curve.union(flat_price).union(flat_units).union(short)).collect()}
    assert set(fits) == {"curve", "flat_price", "flat_units"}
    assert fits["curve"]["price_elasticity"] == pytest.approx(-2) and fits["curve"]["r_squared"] == pytest.approx(1)
    assert fits["curve"]["intercept"] == pytest.approx(math.log(1000)) and fits["curve"]["n_observations"] == 10
    y = np.log(np.arange(1, 10))
    design = np.column_stack([np.ones(9), np.full(9, math.log(3.0))])
    shortest = np.linalg.lstsq(design, y, rcond=None)[0]
    assert [fits["flat_price"]["intercept"], fits["flat_price"]["price_elasticity"]] == pytest.approx(shortest)
    assert fits["flat_price"]["n_observations"] == 9 and fits["flat_price"]["r_squared"] == 0.0
    assert fits["flat_units"]["r_squared"] == 0.0 and fits["flat_units"]["price_elasticity"] == pytest.approx(0, abs=1e-12)


def test_scenario(spark):
    history = _history(spark, "A", [9.0] * 30 + [4.0, 6.0], [1.0] * 30 + [10.0, 20.0]).union(_history(spark, "B", [2.0], [8.0]))
    slopes = spark.createDataFrame([("S", "A", -2.0)], "store_id string, product_id string, price_elasticity double")
    plan = spark.createDataFrame([("2024-02-03", "S", "A", "10.0"), (str(day(1)), "S", "B", "2.0")], "date string, store_id string, product_id string, price string")
    made = elasticity.price_plan_forecast(history, slopes, 2, 2, plan)
    assert rows(made, "product_id", "date") == [
        ("S", "A", day(32), 15.0, 15.0, 5.0, 5.0, -2.0),
        ("S", "A", day(33), 3.75, 15.0, 10.0, 5.0, -2.0),
        ("S", "B", day(1), 8.0, 8.0, 2.0, 2.0, -1.0),
        ("S", "B", day(2), 8.0, 8.0, 2.0, 2.0, -1.0),
    ]
    assert "WindowGroupLimit" in made._jdf.queryExecution().executedPlan().toString()
    assert elasticity.price_plan_forecast(history, slopes, 1).count() == 2
    with pytest.raises(PanelError, match="horizon_days"):
        elasticity.price_plan_forecast(history, slopes, 0)
    for column, value, message in (("date", "never", "dates"), ("price", "-1", "prices")):
        with pytest.raises(PanelError, match=message):
            elasticity.validate_price_plan(plan.withColumn(column, F.lit(value)))


def test_guardrail_order(spark):
    rng = np.random.default_rng(1)
    parts = {
        "ok": (8 + rng.normal(0, 0.4, 60), 10 + rng.normal(0, 2, 60)),
        "short": ([5.0] * 10, [1.0] * 10),
        "flat_price": ([7.5] * 60, list(range(60))),
        "flat_units": (8 + rng.normal(0, 0.4, 60), [4.0] * 60),
        "calm_price": (8 + rng.normal(0, 1e-3, 60), list(range(60))),
        "calm_units": (8 + rng.normal(0, 0.4, 60), 100 + rng.normal(0, 1e-2, 60)),
    }
    df = None
    for name, (prices, units) in parts.items():
        part = _history(spark, name, [float(p) for p in prices], [float(u) for u in units])
        df = part if df is None else df.union(part)
    gaps = _history(spark, "gaps", [5.0 + i / 10 for i in range(60)], [float(i) for i in range(60)]).withColumn("units_sold", F.when(F.col("units_sold") > 30, F.col("units_sold")))
    keyed = elasticity.segment_key(elasticity.log_treatment(df.union(gaps)))
    found = {r["segment_key"][11:]: r for r in elasticity.segment_guardrails(keyed, min_samples=40).collect()}
    reason = {k: r["reason"] for k, r in found.items()}
    assert reason["ok"] is None and found["ok"]["is_valid"]
    assert reason["short"] == "sample_size_below_threshold (10 < 40)" and found["short"]["log_price_std"] == 0.0
    assert reason["gaps"] == "non_null_pair_count_below_threshold (29 < 40) for y_log/t_log"
    assert reason["flat_price"] == "unique_price_values_below_threshold (1 < 8)"
    assert reason["flat_units"] == "insufficient_outcome_variation"
    assert reason["calm_price"].startswith("log_price_std_below_threshold (0.000") and reason["calm_price"].endswith("< 0.010000)")
    assert reason["calm_units"].startswith("log_units_std_below_threshold")
    assert found["ok"]["log_price_std"] == pytest.approx(np.std(np.log(np.asarray(parts["ok"][0]) + 1e-3)))
    with pytest.raises(PanelError, match="greater than 1"):
        elasticity.segment_guardrails(keyed, min_samples=1)


def test_control_selection(spark):
    names = [
        "date date", "store_id string", "day_of_week int", "discount double", "promotion boolean", "price double", "price_lag_1 double",
        "price_roll_mean_7 double", "competitor_price double", "demand_forecast double", "units_sold_lag_7 double", "units_sold_lag_1 double",
        "store_id_encoded double", "store_indicator_9 int", "llm_gap double", "future_units double", "target_x double", "weather string", "y_log double",
    ]
    df = spark.createDataFrame([], ", ".join(names))
    lean = ["day_of_week", "discount", "promotion", "competitor_price", "units_sold_lag_7", "store_id_encoded", "store_indicator_9"]
    assert dml.select_controls(df) == lean
    assert dml.select_controls(df, include_store_indicators=False) == lean[:5]
    assert dml.select_controls(df, "full", include_planned=True, allow_demand_forecast=True) == [
        "day_of_week", "discount", "promotion", "competitor_price", "demand_forecast", "units_sold_lag_7", "units_sold_lag_1",
        "store_id_encoded", "store_indicator_9", "llm_gap",
    ]
    with pytest.raises(PanelError, match="feature profile"):
        dml.select_controls(df, "broad")


@pytest.fixture(scope="module")
def market(spark):
    """Two fitted segments and one constant one; true elasticity -1.35."""
    rng = np.random.default_rng(42)
    data = []
    for product, n in (("GOOD", 121), ("OTHER", 200)):
        stock, discount = rng.normal(100, 10, n), rng.choice([0.0, 0.1, 0.2], n)
        price = 8 + rng.normal(0, 0.4, n) + discount
        log_units = 3.2 - 1.35 * np.log(price + 1e-3) + 0.5 * discount + 0.002 * stock + rng.normal(0, 0.05, n)
        data += [(day(i), "S", product, float(np.exp(log_units[i])), float(price[i]), float(discount[i]), float(stock[i]) if i % 9 else None) for i in range(n)]
    data += [(day(i), "S", "BAD", 5.0, 7.5, 0.0, 50.0) for i in range(20)]
    return spark.createDataFrame(data, SALES + ", discount double, inventory_level double")


def _by_hand(frame, controls):
    """Two-fold double ML of one segment in NumPy."""
    x = frame[controls].fillna(frame[controls].median()).to_numpy()
    y, t = np.log(frame["units_sold"] + 1e-3).to_numpy(), np.log(frame["price"] + 1e-3).to_numpy()
    n, half = len(y), -(-len(y) // 2)
    design = np.column_stack([np.ones(n), x])
    y_res, t_res = np.empty(n), np.empty(n)
    folds = (np.arange(half), np.arange(half, n))
    for use, fit in (folds, folds[::-1]):
        for target, residual in ((y, y_res), (t, t_res)):
            weights = np.linalg.lstsq(design[fit], target[fit], rcond=None)[0]
            residual[use] = target[use] - design[use] @ weights
    phi = design * t_res[:, None]
    inverse = np.linalg.inv(phi.T @ phi)
    beta = inverse @ phi.T @ y_res
    error = y_res - phi @ beta
    covariance = inverse @ (phi * error[:, None] ** 2).T @ phi @ inverse * n / (n - phi.shape[1])
    spread = np.sqrt(np.einsum("ij,jk,ik->i", design, covariance, design)).mean()
    estimate = (design @ beta).mean()
    return estimate, estimate - 1.959963984540054 * spread, estimate + 1.959963984540054 * spread


def test_double_ml_equals_numpy(market):
    config = dml.ElasticityConfig(nuisance="linear", min_samples=40)
    found = {r["segment_key"]: r for r in dml.elasticity_estimates(market, config).collect()}
    assert len(found) == 3 and len(found["product_id=GOOD"]) == 21
    for product in ("GOOD", "OTHER"):
        row = found[f"product_id={product}"]
        frame = market.where(F.col("product_id") == product).orderBy("date").toPandas()
        hand = _by_hand(frame, ["discount", "inventory_level"])
        assert [row["elasticity_estimate"], row["lower_ci"], row["upper_ci"]] == pytest.approx(hand, abs=1e-8)
        assert row["fit_status"] == "success" and row["quality_status"] == "ok" and row["feature_count_used"] == 2
        assert row["elasticity_estimate"] < 0
    assert found["product_id=BAD"]["fit_status"] == "skipped"
    assert found["product_id=BAD"]["skip_reason"] == "sample_size_below_threshold (20 < 40)"


def test_segments_that_cannot_be_fitted_stay(market):
    holes = market.withColumn("units_sold", F.when((F.col("product_id") != "OTHER") | (F.dayofmonth("date") > 1), F.col("units_sold")))
    plain = holes.withColumns({"discount": F.when(F.col("product_id") == "GOOD", 0.1).otherwise(F.col("discount")), "inventory_level": F.when(F.col("product_id") == "GOOD", 1.0).otherwise(F.col("inventory_level"))})
    config = dml.ElasticityConfig(nuisance="linear", min_samples=40, min_pairs=30)
    found = {r["segment_key"][11:]: (r["fit_status"], r["skip_reason"]) for r in dml.elasticity_estimates(plain, config).collect()}
    assert found["OTHER"][0] == "failed" and found["OTHER"][1].startswith("fit_failed")
    assert found["GOOD"] == ("skipped", "no_usable_controls_after_segment_filtering")


def test_collinear_controls_are_flagged(market):
    double = market.withColumn("competitor_price", F.col("inventory_level") * 2)
    row = [r for r in dml.elasticity_estimates(double, dml.ElasticityConfig(nuisance="linear", min_samples=150)).collect() if r["fit_status"] == "success"]
    assert len(row) == 1 and row[0]["quality_status"] == "warning_inference_unstable" and row[0]["ci_caution_flag"]
    reference = [r for r in dml.elasticity_estimates(market, dml.ElasticityConfig(nuisance="linear", min_samples=150)).collect() if r["fit_status"] == "success"]
    assert row[0]["elasticity_estimate"] == pytest.approx(reference[0]["elasticity_estimate"], abs=1e-6)


def test_trees_give_residuals(market):
    keyed = elasticity.segment_key(elasticity.log_treatment(market.where("product_id <> 'BAD'")))
    ready = dml.segment_controls(keyed, ["segment_key"], ["discount", "inventory_level"])
    for nuisance, params in (("random-forest", {"trees": 5}), ("gradient-boosting", {"rounds": 3})):
        made = dml.cross_fit_residuals(ready, ["segment_key"], ["discount", "inventory_level"], nuisance, params=params)
        assert made.count() == ready.count() and made.where("y_res is null or t_res is null").isEmpty()
        assert rows(made.groupBy("segment_key", "fold").count(), "segment_key", "fold") == [
            ("product_id=GOOD", 0, 61), ("product_id=GOOD", 1, 60), ("product_id=OTHER", 0, 100), ("product_id=OTHER", 1, 100),
        ]
    with pytest.raises(PanelError, match="nuisance"):
        dml.cross_fit_residuals(ready, ["segment_key"], ["discount"], "oracle")


@pytest.mark.parametrize("nuisance, params", [("random-forest", {"trees": 20}), ("gradient-boosting", {"rounds": 20})])
def test_trees_find_the_sign_at_any_segment_level(market, nuisance, params):
    """Segments far apart in units and price keep their own negative elasticity."""
    far = market.where("product_id <> 'BAD'").withColumns(
        {"units_sold": F.col("units_sold") * F.when(F.col("product_id") == "GOOD", 50).otherwise(1), "price": F.col("price") * F.when(F.col("product_id") == "GOOD", 20).otherwise(1)}
    )
    keyed = elasticity.segment_key(elasticity.log_treatment(far))
    controls = ["discount", "inventory_level"]
    ready = dml.segment_controls(keyed, ["segment_key"], controls, scaled=True)
    made = dml.cross_fit_residuals(ready, ["segment_key"], controls, nuisance, params=params)
    found = {r["segment_key"]: r["elasticity_estimate"] for r in dml.dml_elasticity(made, ["segment_key"], controls).collect()}
    assert all(-2.2 < value < -0.5 for value in found.values()), found


def test_report_tables(spark):
    data = [
        ("a", "success", -2.0, -3.0, -1.0, "", "", 0),
        ("b", "success", -1.0, None, 0.0, "", "", 0),
        ("c", "success", 0.5, 0.0, 1.0, "", "Co-variance matrix is underdetermined", 0),
        ("d", "success", 0.7, 0.0, 1.0, "", "", 2),
        ("e", "skipped", None, None, None, "too few", "", 0),
        ("f", "failed", None, None, None, None, "", 0),
    ]
    df = spark.createDataFrame(data, "segment_key string, fit_status string, elasticity_estimate double, lower_ci double, upper_ci double, skip_reason string, warnings_text string, inference_warning_count long")
    judged = elasticity.elasticity_quality(df)
    unstable = "warning_inference_unstable"
    assert [r["quality_status"] for r in judged.orderBy("segment_key").collect()] == ["ok", unstable, unstable, unstable, "skipped", "failed"]
    assert [r["ci_caution_flag"] for r in judged.orderBy("segment_key").collect()] == [False, True, True, True, True, True]
    summary = elasticity.elasticity_run_summary(judged).first()
    assert (summary["successful_fits"], summary["quality_unstable"], summary["inference_warning_count"], summary["ci_caution_present"]) == (4, 3, 3, True)
    assert rows(elasticity.skip_reason_counts(df), "skip_reason") == [("too few", 1), ("unknown", 1)]
    top = elasticity.elasticity_top_segments(df, 2)
    assert rows(top.select("elasticity_rank_group", "segment_key"), "elasticity_rank_group", "segment_key") == [("least_elastic", "c"), ("least_elastic", "d"), ("most_elastic", "a"), ("most_elastic", "b")]
    assert rows(elasticity.elasticity_ci_table(df).select("segment_key", "lower_error", "upper_error"), "segment_key")[0] == ("a", 1.0, 1.0)
    assert sum(r["n"] for r in elasticity.elasticity_histogram(df, 5).collect()) == 4
