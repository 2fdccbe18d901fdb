import random

import pytest
from pyspark.sql import functions as F

from paneloom.operators.quantiles import exact_quantiles
from paneloom.operators.scaling import dense_codes, with_position
from paneloom.operators.windows import add_lookbacks, lag_of, rolling_of

from helpers import day, panel


@pytest.fixture(scope="module")
def skewed(spark):
    """One series holds most rows and several rows per day; another has gaps and NULLs."""
    rng = random.Random(7)
    rows = [(day(i // 3), "S", "hot", float(rng.randint(0, 50)), i) for i in range(900)]
    rows += [(day(2 * i), "S", "cold", None if i % 7 == 0 else float(i), i) for i in range(40)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "date date, store_id string, product_id string, x double, seq int")


def test_chunked_windows_equal_plain_windows(skewed):
    features = {
        "lag_1": lag_of("x", 1),
        "lag_28": lag_of("x", 28),
        "mean_7": rolling_of("x", 7, "mean"),
        "std_14": rolling_of("x", 14, "std", shift=3),
        "median_28": rolling_of("x", 28, "median", min_rows=7),
    }
    plain = add_lookbacks(skewed, features, tiebreak=["seq"])
    cut = add_lookbacks(skewed, features, tiebreak=["seq"], chunk_rows=40)
    assert cut.columns == plain.columns
    assert plain.count() == cut.count() == skewed.count()
    assert plain.exceptAll(cut).isEmpty() and cut.exceptAll(plain).isEmpty()


def test_groups_of_many_series_are_cut(skewed):
    made = add_lookbacks(skewed, {"lag_2": lag_of("x", 2)}, ["store_id"], ["product_id", "date"], ["seq"])
    rows = sorted(made.collect(), key=lambda r: (r["product_id"], r["date"], r["seq"]))
    assert [r["lag_2"] for r in rows] == [None, None, *[r["x"] for r in rows[:-2]]]
    assert "__chunk" in made._jdf.queryExecution().analyzed().toString()


def test_position_matches_row_order(skewed):
    placed = with_position(skewed, ["store_id"], ["product_id", "date"], ["seq"], total="n")
    found = [(r["product_id"], r["date"], r["seq"]) for r in placed.orderBy("position").collect()]
    expected = sorted((r["product_id"], r["date"], r["seq"]) for r in skewed.collect())
    assert found == expected
    assert {r["n"] for r in placed.select("n").collect()} == {len(expected)}


def test_bracketed_quantiles_equal_percentile(spark):
    rng = random.Random(3)
    rows = [("hot", rng.gauss(0, 1) ** 3, float(rng.randint(0, 3))) for _ in range(20_000)]
    rows += [("cold", float(i), None) for i in range(6)] + [("none", None, None)]
    df = spark.createDataFrame(rows, "k string, a double, b double")
    targets = {"a25": ("a", 0.25), "a50": ("a", 0.5), "b50": ("b", 0.5), "b99": ("b", 0.99)}
    for keys in (["k"], []):
        picked = [F.percentile(column, q).alias(name) for name, (column, q) in targets.items()]
        known = {tuple(r[k] for k in keys): r for r in df.groupBy(*keys).agg(*picked).collect()}
        whole = {tuple(r[k] for k in keys): r for r in exact_quantiles(df, targets, keys).collect()}
        cut = {tuple(r[k] for k in keys): r for r in exact_quantiles(df, targets, keys, limit=50).collect()}
        assert cut == whole  # to the last digit, however small the last step
        assert known.keys() == cut.keys()
        for key, row in known.items():
            for name in targets:
                assert cut[key][name] == (row[name] if row[name] is None else pytest.approx(row[name], abs=1e-12))


def test_quantiles_beside_a_value_of_most_rows(spark):
    """Ranks just below, in and above a value with 98% of the rows."""
    df = spark.range(5000).select(F.when(F.col("id") < 50, -F.col("id")).when(F.col("id") < 4950, 7).otherwise(F.col("id")).alias("x"))
    ordered = sorted(r["x"] for r in df.collect())
    ranks = (0, 49, 50, 2500, 4949, 4950, 4999)
    found = exact_quantiles(df, {f"r{k}": ("x", k / 4999) for k in ranks}, limit=10).first()
    assert [found[f"r{k}"] for k in ranks] == pytest.approx([ordered[k] for k in ranks])


def test_quantiles_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "column string, x double")
    assert exact_quantiles(empty, {"m": ("x", 0.5)}).first()["m"] is None
    assert exact_quantiles(empty, {"m": ("x", 0.5)}, ["column"]).count() == 0


def test_dense_codes_are_ranks(spark):
    df = spark.range(500).select(F.concat(F.lit("p"), (F.col("id") * 37 % 211).cast("string")).alias("p"))
    ids = sorted({r["p"] for r in df.collect()})
    assert {r["p"]: r["c"] for r in dense_codes(df, "p", "c").collect()} == {p: float(i) for i, p in enumerate(ids)}


def test_split_features_in_one_exchange(spark):
    from paneloom.operators.features import demand_features, price_features

    df = price_features(demand_features(panel(spark)))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    executed = df._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange") == 1, executed
    assert executed.count("Sort ") <= 1, plan


@pytest.mark.parametrize("chunk_rows", [37, 400])
def test_chunked_expanding_median_equals_the_plain_one(skewed, chunk_rows):
    from paneloom.operators.expanding import add_expanding_median

    wide = skewed.withColumn("x", F.when(F.col("seq") % 11 == 3, F.col("x") * 1000 + F.col("seq")).otherwise(F.col("x")))
    plain = add_expanding_median(wide, "x", "m", tiebreak=["seq"])
    cut = add_expanding_median(wide, "x", "m", tiebreak=["seq"], chunk_rows=chunk_rows)
    assert cut.columns == plain.columns and cut.count() == skewed.count()
    assert plain.exceptAll(cut).isEmpty() and cut.exceptAll(plain).isEmpty()
