import pytest
from pyspark.sql import functions as F

from paneloom.operators import features, windows
from paneloom.schema import CORE_FEATURES, PanelError

from helpers import PANEL_SCHEMA, day, panel, panel_rows, rows


def test_lag_stays_within_the_series(spark):
    df = spark.createDataFrame(
        [(day(d), "S", p, base + d) for p, base in (("A", 10.0), ("B", 100.0)) for d in (0, 1)],
        "date date, store_id string, product_id string, units_sold double",
    )
    made = windows.group_lag(df, "units_sold", [1, 1, 0, -2], "units_sold")
    assert made.columns[-1] == "units_sold_lag_1"
    assert [r["units_sold_lag_1"] for r in made.orderBy("product_id", "date").collect()] == [None, 10.0, None, 100.0]


def test_shifted_rolling_mean(spark):
    df = spark.createDataFrame([(day(i), "S", "P", v) for i, v in enumerate((1.0, 2.0, 100.0, 4.0))], "date date, store_id string, product_id string, x double")
    made = windows.shifted_rolling(df, "x", {2: ["mean"]}, "x")
    assert [r["x_roll_mean_2"] for r in made.orderBy("date").collect()] == [None, None, 1.5, 51.0]
    for bad in ({"shift": 0}, {"windows": {0: ["mean"]}}, {"windows": {2: ["mode"]}}):
        with pytest.raises(PanelError):
            windows.shifted_rolling(df, "x", bad.get("windows", {2: ["mean"]}), "x", shift=bad.get("shift", 1))


def test_warm_up_and_names(spark):
    made = features.manual_features(panel(spark, 40))
    assert made.count() == 12
    assert made.agg(F.min("date")).first()[0] == day(28)
    assert set(CORE_FEATURES) | {"discount", "demand_forecast", "inventory_level", "low_inventory_flag", "stockout_proxy"} == set(made.columns[5:])
    summary = features.feature_summary(panel(spark, 40), made).first()
    assert (summary["rows_before"], summary["rows_after"], summary["rows_dropped"], summary["feature_count"]) == (40, 12, 28, 34)
    assert summary["columns_skipped"] == "competitor_price,promotion,holiday,weather"
    with pytest.raises(PanelError, match="not enough history"):
        features.manual_features(panel(spark, 20))


def test_no_feature_sees_its_own_or_a_later_day(spark):
    source = panel_rows(40)
    changed = [list(r) for r in source]
    changed[30][3], changed[30][4], changed[30][7] = 5000.0, 99.0, 1.0
    before, after = (
        {r["date"]: r for r in features.manual_features(spark.createDataFrame(data, PANEL_SCHEMA), drop_warmup=False).collect()}
        for data in (source, [tuple(r) for r in changed])
    )
    past = [c for c in CORE_FEATURES if "lag" in c or "roll" in c]
    for d in range(31):
        assert all(before[day(d)][c] == after[day(d)][c] for c in past)
    assert before[day(31)]["units_sold_roll_mean_7"] != after[day(31)]["units_sold_roll_mean_7"]
    assert after[day(31)]["price_lag_1"] == 99.0


def test_zero_prices_give_no_ratio(spark):
    made = features.price_features(panel(spark, 40).withColumn("price", F.lit(0.0)))
    assert made.where("price_momentum_7 is not null or price_momentum_28 is not null").isEmpty()


def test_calendar_parts(spark):
    df = spark.createDataFrame([(d,) for d in ("2024-02-29", "2023-01-01", "2024-12-30")], "t string").select(F.to_date("t").alias("date"))
    assert rows(features.calendar_features(df), "date") == [
        (day(-365), 6, 1, 1, 52, 1, 1, 1, 1, 0),
        (day(59), 3, 29, 60, 9, 2, 1, 0, 0, 1),
        (day(364), 0, 30, 365, 1, 12, 4, 0, 0, 0),
    ]


def test_inventory_uses_the_global_median_until_seven_rows(spark):
    stock = [10.0] * 6 + [4.0, 4.0, 40.0, 0.0]
    data = [(day(i), "S", "P", 0.0 if i == 9 else 5.0, 1.0, v) for i, v in enumerate(stock)]
    df = spark.createDataFrame(data, "date date, store_id string, product_id string, units_sold double, price double, inventory_level double")
    made = features.inventory_features(df).orderBy("date").collect()
    assert [r["low_inventory_flag"] for r in made] == [0, 0, 0, 0, 0, 0, 1, 1, 0, 1]
    assert [r["stockout_proxy"] for r in made] == [0] * 9 + [1]
    cautious = features.inventory_features(df, fallback_from=df.where("inventory_level > 30")).orderBy("date").collect()
    assert [r["low_inventory_flag"] for r in cautious][:7] == [1] * 7


def test_exogenous_and_weather(spark):
    df = spark.createDataFrame(
        [(4.0, 2.0, "yes", "0", " Sunny"), (4.0, 0.0, "maybe", None, None), (4.0, 5.0, "no", "t", "cloudy")],
        "price double, competitor_price double, promotion string, holiday string, weather string",
    )
    made = features.weather_code(features.exogenous_features(df, check=False)).orderBy("competitor_price").collect()
    assert [r["price_vs_competitor_pct"] for r in made] == [None, 1.0, -0.2]
    assert [(r["promotion"], r["holiday"]) for r in made] == [(None, None), (1.0, 0.0), (0.0, 1.0)]
    assert [r["weather_code"] for r in made] == [1.0, 2.0, 0.0]


def test_missing_numbers_are_refused(spark):
    df = panel(spark, 5).withColumn("discount", F.when(F.dayofmonth("date") > 1, F.col("discount")))
    with pytest.raises(PanelError, match="'discount' contains 1"):
        features.passthrough_features(df)
    with pytest.raises(PanelError, match="'discount' contains 1"):
        features.manual_features(df)


def test_compat_features(spark):
    made = features.create_features_compat(panel(spark, 10)).orderBy("date").collect()
    assert made[0]["units_roll_mean_7"] is None and made[1]["units_roll_mean_7"] == 20.0
    assert made[9]["units_roll_mean_7"] == pytest.approx(25.0) and made[9]["units_lag_7"] == 22.0
    assert made[0]["day_of_week"] == 0 and made[0]["month"] == 1


def test_cut_series_give_the_same_features(spark):
    df = panel(spark, 45, 2)
    lookbacks = {**features._demand_lookbacks(), **features._price_lookbacks(), **features._inventory_lookbacks()}
    plain, cut = (windows.add_lookbacks(df, lookbacks, chunk_rows=rows) for rows in (None, 40))
    assert plain.columns == cut.columns and plain.count() == cut.count() == 90
    assert plain.exceptAll(cut).isEmpty() and cut.exceptAll(plain).isEmpty()
