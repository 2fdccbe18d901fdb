import json

import pytest
from pyspark.sql import functions as F

from paneloom.plans.audit import audit_plan, plan_specs
from paneloom.plans.materialize import materialize_plan, merge_planned_features
from paneloom.plans.specs import (
    BinaryFlagSpec,
    CalendarSpec,
    DifferenceSpec,
    InteractionSpec,
    LagSpec,
    RatioSpec,
    RollingSpec,
)
from paneloom.schema import BASE_COLUMNS, CORE_FEATURES, PanelError

from helpers import PANEL_SCHEMA, day


@pytest.fixture(scope="module")
def source(spark):
    rows = [
        (day(d), "S1", "P1", 10.0 + d, 5 + 0.1 * (d % 3), 0.1 if d % 2 == 0 else 0.0, 11.0 + d, 100.0 - d) for d in range(14)
    ]
    return spark.createDataFrame(rows, PANEL_SCHEMA)


def test_every_kind_of_spec(source):
    specs = [
        LagSpec("lagged", "units_sold", 1),
        RollingSpec("mean_3", "units_sold", 3, "mean", 1),
        RatioSpec("per_stock", "price", "inventory_level"),
        DifferenceSpec("gap", "price", "discount"),
        InteractionSpec("cut", "price", "discount"),
        BinaryFlagSpec("promo", "discount", "gt", 0.0),
        CalendarSpec("weekend_cut", "is_weekend", "discount"),
        CalendarSpec("weekday", "day_of_week"),
    ]
    made, rejected = materialize_plan(source, specs)
    assert rejected.isEmpty()
    assert made.columns == [*BASE_COLUMNS, *[s.name for s in specs]]
    last = made.orderBy(F.desc("date")).first()
    assert last["lagged"] == 22.0 and last["mean_3"] == pytest.approx(21.0) and last["weekday"] == 6.0
    assert last["per_stock"] == pytest.approx(5.1 / 87) and last["gap"] == pytest.approx(5.1) and last["promo"] == 0.0
    assert made.where("weekend_cut > 0").count() == 2


def test_collisions_and_empty_sources_are_left_out(source):
    df = source.withColumns({"discount": F.lit(None).cast("double"), "shelf": F.lit(1)})
    specs = [LagSpec("shelf", "price", 1), DifferenceSpec("gap", "price", "discount"), LagSpec("fine", "price", 1), LagSpec("fine", "price", 2)]
    made, rejected = materialize_plan(df, specs)
    assert made.columns == [*BASE_COLUMNS, "fine"]
    assert [(r["feature_name"], r["reason"].split()[0]) for r in rejected.collect()] == [("shelf", "feature"), ("gap", "Column"), ("fine", "feature")]


def test_planned_features_do_not_look_ahead(source):
    specs = [LagSpec("lagged", "units_sold", 1), RollingSpec("std_4", "units_sold", 4, "std", 2)]
    later = source.withColumn("units_sold", F.when(F.col("date") >= F.lit(day(9)), 999.0).otherwise(F.col("units_sold")))
    a, b = (materialize_plan(df, specs)[0].where(F.col("date") <= F.lit(day(9))).drop("units_sold") for df in (source, later))
    assert a.exceptAll(b).isEmpty()


def test_partial_group_order(spark):
    rows = [(day(d), s, "P", base + d, 1.0, 0.0, 0.0, 0.0) for s, base in (("A", 0.0), ("B", 100.0)) for d in (0, 1)]
    df = spark.createDataFrame(rows, PANEL_SCHEMA)
    spec = LagSpec("before", "units_sold", 1, ("product_id",))
    value = lambda made: [r["before"] for r in made.orderBy("store_id", "date").collect()]
    assert value(materialize_plan(df, [spec])[0]) == [None, 0.0, 1.0, 100.0]
    assert value(materialize_plan(df, [spec], date_first=True)[0]) == [None, 100.0, 0.0, 1.0]
    assert value(materialize_plan(df, [spec])[0]) == [None, 0.0, 1.0, 100.0]


def test_spec_bounds():
    for make in (
        lambda: LagSpec("x", "units_sold", 1),
        lambda: LagSpec("price_lag_1", "units_sold", 1),
        lambda: LagSpec("xyz", "units_sold", 0),
        lambda: LagSpec("xyz", "weather", 1),
        lambda: LagSpec("xyz", "price", 1, ()),
        lambda: RollingSpec("xyz", "price", 1, "mean", 1),
        lambda: RollingSpec("xyz", "price", 7, "median", 1),
        lambda: RatioSpec("xyz", "price", "price"),
        lambda: DifferenceSpec("xyz", "units_sold", "price"),
        lambda: BinaryFlagSpec("xyz", "price", "gt", 1.0, 2.0, 2.0),
        lambda: CalendarSpec("xyz", "season"),
    ):
        with pytest.raises(PanelError):
            make()


def _audit(spark, specs, available=(*BASE_COLUMNS, "discount", "inventory_level"), **kwargs):
    df = spark.createDataFrame([(i + 1, s if isinstance(s, str) else json.dumps(s)) for i, s in enumerate(specs)], "index int, spec string")
    return {r["index"]: (r["feature_name"], r["accepted"], r["reason"]) for r in audit_plan(df, available, kwargs.get("existing", ()), kwargs.get("blocked", ())).collect()}


def test_audit_reasons(spark):
    lag = {"operation": "lag_feature", "source_column": "units_sold", "lag": 3}
    specs = [
        {**lag, "feature_name": " Units_Three "},
        {**lag, "feature_name": "units_three"},
        {"operation": "magic", "feature_name": "abc"},
        {**lag, "feature_name": "too_far", "lag": -1},
        {**lag, "feature_name": "price"},
        {**lag, "feature_name": "units_sold_roll_mean_7"},
        {"operation": "ratio_feature", "feature_name": "vs_rival", "numerator_column": "price", "denominator_column": "competitor_price"},
        {**lag, "feature_name": "units_four", "colour": "red"},
        {**lag, "feature_name": "own_group", "group_by": []},
        {**lag, "feature_name": "needs_more", "required_columns": ["holiday", "weather"]},
        {**lag, "feature_name": "taken_name"},
        {**lag, "feature_name": "blocked_name"},
        '"just text"',
        {"operation": "calendar_feature", "feature_name": "weekend_cut", "calendar_component": "is_weekend", "interact_with_column": "discount"},
        {"operation": "binary_flag_feature", "feature_name": "cheap", "source_column": "price", "comparator": "lt", "threshold": 5},
        {"operation": "binary_flag_feature", "feature_name": "flat", "source_column": "price", "comparator": "lt", "threshold": 5, "true_value": 0},
    ]
    found = _audit(spark, specs, existing=["taken_name"], blocked=["blocked_name"])
    assert [i for i, v in found.items() if v[1]] and {i for i, v in found.items() if v[1]} == {1, 14, 15}
    assert found[1][0] == "units_three"
    assert found[2][2].startswith("Feature name duplicates")
    expect = {3: "'operation'", 4: "'lag'", 5: "reserved", 6: "reserved", 8: "unexpected key", 9: "'group_by'", 16: "'true_value'"}
    for index, text in expect.items():
        assert text in found[index][2] and found[index][2].startswith("Schema validation failed"), found[index]
    assert found[7][2] == "Missing required columns in source data: competitor_price"
    assert found[10][2] == "Missing required columns in source data: holiday, weather"
    assert found[11][2].startswith("Feature name duplicates") and found[12][2].startswith("Feature name overlaps")
    assert found[13] == ("spec_13", False, "Spec item is not a JSON object")


def test_manual_names_are_blocked_and_either_key_is_read(spark):
    spec = {"operation": "lag_feature", "source_column": "price", "lag": 2, "feature_name": "price_two"}
    plans = spark.createDataFrame([(1, json.dumps({"specs": [spec]})), (2, json.dumps({"features": [spec, spec]}))], "plan int, payload string")
    listed = plan_specs(plans)
    assert sorted((r["plan"], r["index"]) for r in listed.collect()) == [(1, 1), (2, 1), (2, 2)]
    assert audit_plan(listed.where("plan = 1"), BASE_COLUMNS, [], CORE_FEATURES).first()["accepted"]
    assert not audit_plan(listed.where("plan = 1"), BASE_COLUMNS, [], ["price_two"]).first()["accepted"]


def test_merge_keeps_rows_and_takes_the_newest(spark, source):
    planned = source.select("date", "store_id", "product_id", F.lit(1.0).alias("a"), F.lit(None).cast("double").alias("b"), F.lit(9.0).alias("price"), F.lit(1).alias("run"))
    planned = planned.unionByName(planned.withColumns({"a": F.lit(2.0), "run": F.lit(2)}).where(F.dayofmonth("date") > 10))
    merged = merge_planned_features(source, planned, newest="run")
    assert merged.columns == [*source.columns, "a"] and merged.count() == 14
    assert merged.where("a = 2").count() == 4 and merged.where("price = 9").isEmpty()
    assert merge_planned_features(source, planned, validated=["c"]).columns == source.columns
    assert merge_planned_features(source, planned, drop_empty=False, newest="run").columns[-2:] == ["a", "b"]
