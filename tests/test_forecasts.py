import pytest
from pyspark.sql import functions as F

from paneloom.operators import baselines, explore, metrics, split
from paneloom.schema import PanelError

from helpers import day, panel, rows


@pytest.fixture(scope="module")
def tagged(spark):
    df = spark.createDataFrame([(day(d), "S1", "P1", d + 1.0, 10.0) for d in range(30)], "date date, store_id string, product_id string, units_sold double, price double")
    return split.chronological_split(df, validation_start=str(day(20)), test_start=str(day(25)))


def test_baseline_values(tagged):
    suite = baselines.baseline_suite(tagged)
    assert suite.count() == 50 and suite.where("prediction is null").isEmpty()
    first = {r["model_name"]: r["prediction"] for r in suite.where(F.col("date") == F.lit(day(20))).collect()}
    assert first == {"naive_last": 20.0, "seasonal_naive_7": 14.0, "rolling_mean_7": 17.0, "rolling_mean_28": 10.5, "median_expanding": 10.5}
    last = {r["model_name"]: r["prediction"] for r in suite.where(F.col("date") == F.lit(day(29))).collect()}
    assert last["naive_last"] == 29.0 and last["median_expanding"] == 15.0 and last["rolling_mean_28"] == 15.5


def test_a_new_series_takes_the_history_median(spark, tagged):
    new = spark.createDataFrame([(day(d), "S1", "NEW", 500.0, 1.0) for d in (22, 26)], "date date, store_id string, product_id string, units_sold double, price double")
    both = split.chronological_split(tagged.drop("split").unionByName(new), validation_start=str(day(20)), test_start=str(day(25)))
    made = baselines.baseline(both, "naive_last").where("product_id = 'NEW'")
    assert rows(made.select("date", "prediction"), "date") == [(day(22), 10.5), (day(26), 500.0)]
    with pytest.raises(PanelError, match="Unsupported baseline"):
        baselines.baseline(both, "crystal_ball")


def test_expanding_median_matches_the_window_percentile(spark):
    from pyspark.sql import Window

    df = panel(spark, 60, 2).withColumn("units_sold", F.when(F.dayofmonth("date") != 5, F.pmod(F.hash("date", "product_id"), F.lit(50)).cast("double")))
    tagged = split.chronological_split(df)
    before = Window.partitionBy("store_id", "product_id").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    expected = tagged.withColumn("m", F.percentile("units_sold", 0.5).over(before)).where("split <> 'train'").select("date", "product_id", "m")
    made = baselines.baseline(tagged, "median_expanding").select("date", "product_id", "prediction")
    assert rows(made, "date", "product_id") == rows(expected, "date", "product_id")


def _predictions(spark, pairs, model="m", split_name="validation"):
    data = [(day(i), "S", "P1", a, p, model, "f", split_name) for i, (a, p) in enumerate(pairs)]
    return spark.createDataFrame(data, "date date, store_id string, product_id string, actual double, prediction double, model_name string, model_family string, split string")


def test_metrics_with_zero_actuals(spark):
    found = metrics.forecast_metrics(_predictions(spark, [(0.0, 1.0), (0.0, 0.0), (10.0, 8.0)])).first()
    assert found["wmape"] == pytest.approx(30.0) and found["mape"] == pytest.approx(20.0)
    assert found["mae"] == 1.0 and found["rmse"] == pytest.approx((5 / 3) ** 0.5) and found["n_obs"] == 3
    zeros = _predictions(spark, [(0.0, 1.0), (0.0, 0.0)])
    assert metrics.metric_value(zeros, "wMAPE") == pytest.approx(50.0) and metrics.metric_value(zeros, "mape") is None
    with pytest.raises(PanelError, match="Unsupported metric"):
        metrics.metric_value(zeros, "r2")


HEAD = "split string, model_name string, model_family string, n_obs long, mape double, wmape double, mae double, rmse double"


@pytest.fixture(scope="module")
def tables(spark):
    row = lambda s, name, w: (s, name, "f", 10, w + 1, w, 1.0, 2.0)
    validation = spark.createDataFrame([row("validation", "naive_last", 35.0), row("validation", "xgboost", 6.0), row("validation", "lightgbm", 5.5), ("validation", "broken", "f", 0, None, None, None, None)], HEAD)
    test = spark.createDataFrame([row("test", "xgboost", 5.9), row("test", "lightgbm", 5.4)], HEAD)
    segments = spark.createDataFrame(
        [("product_id=P1", *row("validation", "lightgbm", 5.0)), ("product_id=P1", *row("validation", "xgboost", 5.3)), ("product_id=P2", *row("validation", "xgboost", 4.0)), ("product_id=P2", *row("test", "lightgbm", 1.0))],
        "segment_key string, " + HEAD,
    )
    return validation, test, segments


def test_rankings(tables):
    validation, test, segments = tables
    assert metrics.best_model(validation).first()["model_name"] == "lightgbm"
    board = metrics.forecast_leaderboard(validation, test).orderBy("validation_rank").collect()
    assert [(r["model_name"], r["test_wmape"], r["is_best_overall"]) for r in board] == [("lightgbm", 5.4, True), ("xgboost", 5.9, False), ("naive_last", None, False)]
    registry = metrics.best_model_registry(validation, test, segments)
    assert rows(registry.select("segment_key", "scope", "model_name", "test_wmape"), "segment_key") == [
        ("all", "overall", "lightgbm", 5.4), ("product_id=P1", "per-product", "lightgbm", None), ("product_id=P2", "per-product", "xgboost", None),
    ]
    with pytest.raises(PanelError, match="missing required columns: wmape"):
        metrics.best_model(validation.drop("wmape"))


def test_latest_models(spark):
    runs = spark.createDataFrame(
        [("a", "success", "global", "2024-01-01", "p1"), ("a", "success", "global", "2024-01-02", "p2"), ("a", "failed", "global", "2024-01-03", ""), ("b", "success", "per-product", "2024-01-01", "p3"), ("c", "success", "global", "2024-01-01", "p4")],
        "model_name string, status string, segment_mode string, trained_at_utc string, model_path string",
    )
    assert rows(metrics.latest_models(runs, ["a", "b"]).select("model_name", "model_path"), "model_name") == [("a", "p2"), ("b", "p3")]
    assert rows(metrics.latest_models(runs, ["a", "b"], "global").select("model_name", "model_path")) == [("a", "p2")]


def test_extremes_overlap_and_comparison_keeps_both_sides(spark, tables):
    validation, test, segments = tables
    extremes = metrics.segment_extremes(segments, "xgboost", n=10)
    assert rows(extremes.select("rank_group", "segment_key"), "rank_group", "segment_key") == [("best", "product_id=P1"), ("best", "product_id=P2"), ("worst", "product_id=P1"), ("worst", "product_id=P2")]
    only_test = test.withColumn("model_name", F.lit("new"))
    compared = metrics.model_comparison(validation.unionByName(only_test))
    assert {r["model_name"]: (r["validation_wmape"], r["test_wmape"] is None) for r in compared.collect()}["new"] == (None, False)


def test_histogram_and_busiest_series(spark):
    made = metrics.prediction_frame(_predictions(spark, [(float(i), 0.0) for i in range(11)]))
    bins = explore.error_histogram(made, "m", bins=5).orderBy("bin").collect()
    assert [r["n"] for r in bins] == [2, 2, 2, 2, 3] and bins[0]["lower_edge"] == 0.0 and bins[-1]["upper_edge"] == 10.0
    flat = explore.column_histogram(made.withColumn("x", F.lit(3.0)), "x", 4).orderBy("bin").collect()
    assert [r["n"] for r in flat] == [0, 0, 11, 0] and flat[0]["lower_edge"] == 2.5
    assert explore.column_histogram(made.where("false"), "actual").isEmpty()
    more = made.unionByName(made.limit(3).withColumn("product_id", F.lit("P0")))
    assert metrics.busiest_segment_series(more, "m").count() == 11


def test_exploration(spark):
    df = panel(spark, 8, 2).withColumn("units_sold", F.when(F.dayofmonth("date") == 1, 0.0).otherwise(F.col("units_sold")))
    seen = explore.coverage(df).first()
    assert (seen["n_days"], seen["n_stores"], seen["n_products"], seen["zero_demand_rate"]) == (8, 2, 2, 0.125)
    assert rows(explore.rows_per_key(df, "store_id", 1)) == [("S0", 8)]
    row = explore.describe(df.where("product_id = 'P0'"), ["inventory_level"]).first()
    assert (row["count"], row["min"], row["q25"], row["q50"], row["q75"], row["max"]) == (8, 143.0, 144.75, 146.5, 148.25, 150.0)
