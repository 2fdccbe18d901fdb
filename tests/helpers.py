"""Small inline frames shared by the tests."""

from datetime import date, timedelta

DAY0 = date(2024, 1, 1)


def day(k):
    return DAY0 + timedelta(days=k)


def panel_rows(days, groups=1):
    """Daily series: units grow with the day and the group, prices repeat every five days."""
    return [
        (day(d), f"S{g}", f"P{g}", 20.0 + 100 * g + d, 10 + 2 * g + 0.1 * (d % 5), 0.05 * (d % 4), 21.0 + 100 * g + d, max(0.0, 150.0 - d))
        for g in range(groups)
        for d in range(days)
    ]


PANEL_SCHEMA = (
    "date date, store_id string, product_id string, units_sold double, price double, "
    "discount double, demand_forecast double, inventory_level double"
)


def panel(spark, days=40, groups=1):
    return spark.createDataFrame(panel_rows(days, groups), PANEL_SCHEMA)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
