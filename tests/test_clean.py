import pytest
from pyspark.sql import functions as F

from paneloom.functions.scalars import clean_binary, safe_ratio
from paneloom.operators import clean
from paneloom.schema import PanelError
from paneloom.sources.tables import export_forecasts, read_price_plan, read_sales, write_table

from helpers import day, panel


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(str(day(d)), "S1", "P1", 10 + d, 5.0 + d, "yes" if d % 2 else "no") for d in range(12)]
    rows = rows[::-1] + [rows[11]]
    return spark.createDataFrame(rows, "sale_date string, store string, sku string, sales int, unit_price double, promotion string")


def test_header_names():
    expected = {
        "Sale Date": "date",
        "store": "store_id",
        "sku": "product_id",
        "Quantity Sold": "units_sold",
        "unit_price": "price",
        "Competitor Price": "competitor_price",
        "Store-ID": "store_id",
        "DemandForecast": "demand_forecast",
        "Shelf  Colour": "shelf_colour",
    }
    assert {name: clean.canonical_name(name) for name in expected} == expected


def test_two_sources_for_one_name(spark):
    df = spark.createDataFrame([("a", "b")], "store string, branch string")
    with pytest.raises(PanelError, match="store_id <- store, branch"):
        clean.normalize_columns(df)


def test_clean_drops_the_duplicate_and_sorts(raw):
    cleaned = clean.clean_sales(raw)
    ordered = clean.canonical_sort(cleaned).collect()
    assert len(ordered) == 12
    assert [r["date"] for r in ordered] == [day(d) for d in range(12)]
    assert ordered[1]["promotion"] is True
    summary = clean.data_summary(cleaned, raw=raw).first()
    assert summary["total_row_count"] == 12 and summary["duplicate_row_count_removed"] == 1
    assert (summary["min_date"], summary["max_date"]) == (day(0), day(11))
    assert summary["number_of_stores"] == summary["number_of_products"] == 1
    assert summary["missing_promotion"] == 0 and summary["zero_demand_rate"] == 0.0


def test_text_columns_are_coerced(spark):
    df = spark.createDataFrame(
        [("2024-01-01", " B1 ", "1", "10", "9.5", "yes", "0.10", "sunny"), ("2024-01-02 17:30:00", "B1", "1", "0", "9.0", "No", "n/a", "rain")],
        "sale_date string, branch string, item_id string, quantity_sold string, unit_price string, promotion string, discount string, weather string",
    )
    typed = clean.standardize(df)
    assert dict(typed.dtypes) == {
        "date": "date", "store_id": "string", "product_id": "string", "units_sold": "double", "price": "double",
        "promotion": "boolean", "discount": "double", "weather": "string",
    }
    first, second = typed.orderBy("date").collect()
    assert first["store_id"] == "B1" and first["promotion"] is True and first["discount"] == 0.1
    assert second["date"] == day(1) and second["promotion"] is False and second["discount"] is None


def test_missing_column_and_broken_rules(spark):
    base = "date string, store_id string, product_id string, units_sold string"
    with pytest.raises(PanelError, match="missing required columns: price"):
        clean.standardize(spark.createDataFrame([("2024-01-01", "S", "P", "1")], base))

    def table(*rows):
        return spark.createDataFrame(rows, base + ", price string")

    good = ("2024-01-01", "S", "P", "1", "2")
    cases = [
        (("soon", "", "P", "-1", "0"), "1 invalid date"),
        (("2024-01-01", "", "P", "1d", "0"), "'units_sold' has 1 values that cannot"),
        (("2024-01-01", "", "P", "-1", "NaN"), "'price' has 1 values that cannot"),
        (("2024-01-01", " \t", "P", "-1", "0"), "'store_id' has 1 missing"),
        (("2024-01-01", "S", None, "-1", "0"), "'product_id' has 1 missing"),
        (("2024-01-01", "S", "P", "-1", "0"), "1 negative values"),
        (("2024-01-01", "S", "P", "1", "0"), "1 non-positive values"),
    ]
    for bad, message in cases:
        with pytest.raises(PanelError, match=message):
            clean.standardize(table(good, bad))
    report = clean.validation_report(table(*[bad for bad, _ in cases])).first().asDict()
    assert report == {
        "invalid_dates": 1, "non_numeric_units_sold": 1, "non_numeric_price": 1, "empty_store_id": 4,
        "empty_product_id": 1, "negative_units_sold": 5, "non_positive_price": 6,
    }


def test_row_functions(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 0.0), (3.0, None), (4.0, -2.0)], "n double, d double")
    assert [r[0] for r in df.select(safe_ratio(F.col("n"), F.col("d"))).collect()] == [1.0, None, None, None]
    texts = spark.createDataFrame([(t,) for t in (" Yes ", "1", "1.0", "F", None)], "t string")
    assert [r[0] for r in texts.select(clean_binary(F.col("t"))).collect()] == [1.0, 1.0, None, 0.0, None]
    flag = spark.createDataFrame([(True,), (False,)], "b boolean")
    assert [r[0] for r in flag.select(clean_binary(F.col("b"))).collect()] == [1.0, 0.0]


def test_safe_log(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.0,)], "x double")
    logs = [r["l"] for r in clean.safe_log(df, {"l": "x"}, 1e-3).collect()]
    assert logs == sorted(logs) and all(abs(v) < 10 for v in logs)
    with pytest.raises(PanelError, match="below -epsilon"):
        clean.safe_log(spark.createDataFrame([(-1.0,)], "x double"), {"l": "x"}, 1e-3)
    with pytest.raises(PanelError, match="strictly positive"):
        clean.safe_log(df, {"l": "x"}, 0.0)


def test_files_round_trip(spark, tmp_path):
    df = panel(spark, 5)
    csv = write_table(df, f"{tmp_path}/sales.csv", "csv")
    back = clean.standardize(read_sales(spark, csv))
    assert back.select(df.columns).exceptAll(df).isEmpty() and back.count() == 5
    split = write_table(df.withColumn("split", F.lit("train")), f"{tmp_path}/panel.parquet", partition_by="split")
    assert read_price_plan(spark, split).where("split = 'train'").count() == 5
    with pytest.raises(PanelError, match="neither in .csv"):
        read_sales(spark, "sales.xlsx")
    with pytest.raises(PanelError, match="forecast_units"):
        export_forecasts(df)
    out = export_forecasts(df.withColumn("forecast_units", F.lit(1.0)), f"{tmp_path}/out.csv").first()
    assert out["row_count"] == 5 and out["column_count"] == 9
    assert read_sales(spark, f"{tmp_path}/out.csv").count() == 5
