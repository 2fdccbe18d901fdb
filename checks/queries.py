"""One query per operator, over the whole of the given tables.

`lazy_panel` keeps the panel in the query's own plan; `panel` writes it once through the checkpoint
folder, for queries that read it several times.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom.functions import scalars
from paneloom.operators import baselines, clean, dml, elasticity, evaluate, explore, features, matrix, metrics, models, saved, split, windows
from paneloom.operators.scaling import settle, shared_folder
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
from paneloom.schema import BASE_COLUMNS, CALENDAR_FEATURES, DEMAND_FEATURES, PANEL_KEY, PRICE_FEATURES, WARMUP_COLUMNS
from paneloom.sources.panel import sales_panel
from paneloom.sources.tables import export_forecasts, read_price_plan, read_sales, write_table

Query = Callable[[SparkSession, str], DataFrame]
KEY = list(PANEL_KEY)


def lazy_panel(spark: SparkSession, folder: str) -> DataFrame:
    return sales_panel(spark, folder)


def panel(spark: SparkSession, folder: str) -> DataFrame:
    return settle(sales_panel(spark, folder))


def split_panel(spark: SparkSession, folder: str) -> DataFrame:
    return split.chronological_split(panel(spark, folder))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals, without negative zero, for values whose last digits depend on summing order."""
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in columns})


def rounded_metrics(df: DataFrame) -> DataFrame:
    """The root to six decimals; the other metrics are quotients of exact sums and stay as they are."""
    return rounded(df, "rmse")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def output_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one the session names."""
    return f"{shared_folder(spark).rstrip('/')}/paneloom-{uuid.uuid4().hex}/{name}"


# ---------------------------------------------------------------- raw sales texts


def raw_sales(spark: SparkSession, folder: str, flawed: bool = False) -> DataFrame:
    """Order lines as an untidy export: odd headers, texts for everything, returned lines repeated."""
    lines = table(spark, folder, "lineitem")
    text = lambda value: value.cast("string")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    quantity, branch = text(F.col("l_quantity").cast("long")), F.concat(F.lit(" B"), text(F.col("l_suppkey")))
    price = text(F.round(F.col("l_extendedprice") * 100).cast("long"))
    if flawed:
        day = F.when(F.col("l_linenumber") == 7, "soon").otherwise(day)
        quantity = F.when(F.col("l_linenumber") == 6, "many").when(F.col("l_linenumber") == 5, F.concat(F.lit("-"), quantity)).otherwise(quantity)
        branch = F.when(F.col("l_discount") == 0, "  ").otherwise(branch)
        price = F.when(F.col("l_tax") == 0, F.concat(F.lit("-"), price)).otherwise(price)
    one_each = lines.select(
        day.alias("Sale Date"),
        branch.alias("Branch"),
        F.concat(text(F.col("l_partkey")), F.lit(" ")).alias("sku"),
        quantity.alias("QuantitySold"),
        price.alias("unit-price"),
        F.when(F.col("l_returnflag") == "A", "Yes").when(F.col("l_returnflag") == "N", " no ").otherwise("maybe").alias("Promo"),
        F.when(F.col("l_linestatus") == "O", text(F.round(F.col("l_discount") * 100).cast("long"))).otherwise("n/a").alias("discount_pct"),
        F.col("l_linestatus").alias("Weather"),
        "l_returnflag",
    )
    repeated = one_each.where(F.col("l_returnflag") == "R")
    return one_each.unionByName(repeated).drop("l_returnflag")


def q_normalize_columns(spark, folder):
    return clean.normalize_columns(raw_sales(spark, folder))


def q_standardize(spark, folder):
    return clean.standardize(raw_sales(spark, folder))


def q_validation_report(spark, folder):
    return clean.validation_report(raw_sales(spark, folder, flawed=True))


def q_drop_exact_duplicates(spark, folder):
    return clean.drop_exact_duplicates(raw_sales(spark, folder))


def q_canonical_sort(spark, folder):
    return clean.canonical_sort(lazy_panel(spark, folder).select(*BASE_COLUMNS))


def q_data_summary(spark, folder):
    return rounded(clean.data_summary(clean.standardize(raw_sales(spark, folder)), distinct=True), "zero_demand_rate")


def q_clean_sales(spark, folder):
    return clean.clean_sales(raw_sales(spark, folder))


def q_clean_binary(spark, folder):
    raw = raw_sales(spark, folder)
    return raw.groupBy("Promo", scalars.clean_binary(F.col("Promo")).alias("promotion")).agg(F.count(F.lit(1)).alias("n"))


def q_safe_ratio(spark, folder):
    lines = table(spark, folder, "lineitem")
    ratio = scalars.safe_ratio(F.col("l_extendedprice"), F.col("l_discount") - 0.05)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ratio.alias("ratio"))


def q_safe_log(spark, folder):
    logged = clean.safe_log(lazy_panel(spark, folder), {"log_units": "units_sold", "log_discount": "discount"}, 1e-3)
    return rounded(logged.select(*KEY, "log_units", "log_discount"), "log_units", "log_discount")


# ---------------------------------------------------------------- sources and sinks


def q_read_sales(spark, folder):
    base = lazy_panel(spark, folder).select(
        F.col("date").alias("sale_date"), F.col("store_id").alias("store"), F.col("product_id").alias("item"),
        F.col("units_sold").alias("qty"), F.col("price").alias("selling_price"), F.col("promotion").alias("is_promotion"),
    )
    path = write_table(base, output_folder(spark, "sales.csv"), "csv")
    return clean.standardize(read_sales(spark, path))


def future_prices(df: DataFrame) -> DataFrame:
    """Planned prices: a quarter off, ten days after each panel row."""
    return df.select(
        F.date_add("date", 10).alias("date"), "store_id", "product_id", (F.col("price") * 0.75).alias("price")
    )


def q_read_price_plan(spark, folder):
    path = write_table(future_prices(lazy_panel(spark, folder)), output_folder(spark, "plan.parquet"))
    return read_price_plan(spark, path)


def q_write_table(spark, folder):
    tagged = split_panel(spark, folder)
    path = write_table(tagged.select(*BASE_COLUMNS, "split"), output_folder(spark, "panel.parquet"), partition_by="split")
    return read_sales(spark, path)


def q_export_forecasts(spark, folder):
    scored = baselines.baseline(split_panel(spark, folder), "naive_last")
    forecasts = scored.where(F.col("split") == "test").select(*KEY, F.col("prediction").alias("forecast_units"))
    return export_forecasts(forecasts, output_folder(spark, "forecasts.csv"))


# ---------------------------------------------------------------- chronological split


def q_split_cutoffs(spark, folder):
    return split.split_cutoffs(lazy_panel(spark, folder))


def q_chronological_split(spark, folder):
    return split_panel(spark, folder).select(*KEY, "split")


def q_split_summary(spark, folder):
    return rounded(split.split_summary(split_panel(spark, folder)), "share_of_total_rows")


def q_split_integrity(spark, folder):
    return split.split_integrity(split_panel(spark, folder))


def q_features_for_split(spark, folder):
    tagged = split_panel(spark, folder)
    made = windows.group_lag(tagged.drop("split"), "units_sold", [1], "units_sold")
    kept = split.features_for_split(made, tagged.where(F.col("split") == "validation"))
    return kept.select(*KEY, "units_sold_lag_1")


def q_backtest_cutoffs(spark, folder):
    return split.backtest_cutoffs(lazy_panel(spark, folder), 1200, 90, 180)


def q_backtest_frame(spark, folder):
    base = panel(spark, folder)
    folds = split.backtest_frame(base, split.backtest_cutoffs(base, 1200, 90, 180))
    return folds.groupBy("fold", "split", "store_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.sum("units_sold").alias("units"),
    )


# ---------------------------------------------------------------- window features


def q_calendar_features(spark, folder):
    return features.calendar_features(lazy_panel(spark, folder)).select(*KEY, *CALENDAR_FEATURES)


def q_group_lag(spark, folder):
    made = windows.group_lag(lazy_panel(spark, folder), "units_sold", [1, 7, 14, 28], "units_sold")
    return made.select(*KEY, *[f"units_sold_lag_{k}" for k in (1, 7, 14, 28)])


def q_shifted_rolling(spark, folder):
    stats = {7: ("mean", "std", "min", "max"), 14: ("mean",)}
    made = windows.shifted_rolling(lazy_panel(spark, folder), "price", stats, "price", shift=2)
    names = [f"price_roll_{s}_{w}" for w, ss in stats.items() for s in ss]
    return rounded(made.select(*KEY, *names), *[n for n in names if "mean" in n or "std" in n])


def _rounded_features(df: DataFrame) -> DataFrame:
    inexact = ("_mean_", "_std_", "_momentum_")
    return rounded(df, *[c for c in df.columns if any(part in c for part in inexact)])


def q_demand_features(spark, folder):
    return _rounded_features(features.demand_features(lazy_panel(spark, folder)).select(*KEY, *DEMAND_FEATURES))


def q_price_features(spark, folder):
    return _rounded_features(features.price_features(lazy_panel(spark, folder)).select(*KEY, *PRICE_FEATURES))


def q_passthrough_features(spark, folder):
    return features.passthrough_features(panel(spark, folder)).select(*KEY, "discount", "demand_forecast")


def q_inventory_features(spark, folder):
    made = features.inventory_features(panel(spark, folder))
    return made.select(*KEY, "inventory_level", "low_inventory_flag", "stockout_proxy")


def q_exogenous_features(spark, folder):
    made = features.exogenous_features(panel(spark, folder))
    return made.select(
        *KEY, "competitor_price", "price_vs_competitor_abs", "price_vs_competitor_pct", "promotion", "holiday"
    )


def q_weather_code(spark, folder):
    return features.weather_code(panel(spark, folder)).select(*KEY, "weather_code")


def q_trim_warmup(spark, folder):
    made = features.price_features(features.demand_features(lazy_panel(spark, folder)))
    return features.trim_warmup(made, WARMUP_COLUMNS).select(*KEY, "units_sold")


def q_manual_features(spark, folder):
    return _rounded_features(features.manual_features(panel(spark, folder)))


def q_create_features_compat(spark, folder):
    made = features.create_features_compat(lazy_panel(spark, folder))
    names = ["units_lag_1", "units_lag_7", "units_lag_14", "units_roll_mean_7", "log_units", "log_price", "day_of_week", "month"]
    return rounded(made.select(*KEY, *names), "units_roll_mean_7", "log_units", "log_price")


def q_feature_summary(spark, folder):
    base = panel(spark, folder)
    return features.feature_summary(base, features.manual_features(base))


# ---------------------------------------------------------------- declared features


def _spec_query(spec, inexact: bool = False) -> Query:
    def query(spark, folder):
        made, _ = materialize_plan(panel(spark, folder), [spec])
        kept = made.select(*KEY, spec.name)
        return rounded(kept, spec.name) if inexact else kept

    return query


LAG = LagSpec("stock_three_rows_ago", "inventory_level", 3)
ROLLING = RollingSpec("price_mean_5", "price", 5, "mean", 2)
RATIO = RatioSpec("price_per_stock", "price", "inventory_level")
DIFFERENCE = DifferenceSpec("price_gap", "price", "competitor_price")
INTERACTION = InteractionSpec("price_times_discount", "price", "discount")
FLAG = BinaryFlagSpec("deep_discount", "discount", "ge", 0.06, 1.0, -1.0)
CALENDAR = CalendarSpec("weekend_discount", "is_weekend", "discount")
PRODUCT_LAG = LagSpec("product_lag_2", "units_sold", 2, ("product_id",))
PLAN = [LAG, ROLLING, RATIO, DIFFERENCE, INTERACTION, FLAG, CALENDAR, PRODUCT_LAG]


def q_materialize_plan(spark, folder):
    made, _ = materialize_plan(panel(spark, folder), [*PLAN, LagSpec(LAG.name, "price", 1)])
    return rounded(made, ROLLING.name)


def proposed_specs(spark: SparkSession, folder: str) -> DataFrame:
    """A feature spec per event, good or bad depending on the event's type, user and value."""
    events = table(spark, folder, "events")
    kind, user, whole = F.col("event_type"), F.col("user_id").cast("string"), F.floor("value").cast("int")
    is_kind = lambda *names: kind.isin(*names)
    spec = F.struct(
        F.when(is_kind("view"), "lag_feature").when(is_kind("click"), "binary_flag_feature")
        .when(is_kind("purchase"), "ratio_feature").when(is_kind("signup"), "rolling_feature").otherwise("cube_feature").alias("operation"),
        F.when(is_kind("view", "click"), F.concat(F.lit("user_"), user))
        .when(is_kind("purchase"), F.concat(F.lit("ratio_"), user))
        .when(F.col("value") > 80, F.concat(F.lit("Roll "), user)).otherwise(F.concat(F.lit("roll_"), user)).alias("feature_name"),
        F.when(is_kind("view"), F.when(F.col("value") < 20, "units_sold").when(F.col("value") < 60, "inventory_level").otherwise("weather"))
        .when(is_kind("click"), "price").when(is_kind("signup"), "units_sold").alias("source_column"),
        F.when(is_kind("view"), whole).alias("lag"),
        F.when(is_kind("signup"), whole).alias("window"),
        F.when(is_kind("signup"), "mean").alias("aggregation"),
        F.when(is_kind("signup"), 1).alias("shift"),
        F.when(is_kind("click"), "gt").alias("comparator"),
        F.when(is_kind("click"), F.col("value")).alias("threshold"),
        F.when(is_kind("purchase"), "price").alias("numerator_column"),
        F.when(is_kind("purchase"), F.when(F.col("value") < 30, "discount").when(F.col("value") < 50, "competitor_price").otherwise("price"))
        .alias("denominator_column"),
    )
    return events.select(F.col("event_id").alias("index"), F.to_json(spec).alias("spec"))


def q_plan_specs(spark, folder):
    """A plan of two specs per event."""
    name = lambda text: F.struct(text.alias("feature_name"))
    listed = F.array(name(F.col("event_type")), name(F.concat(F.lit("user_"), F.col("user_id").cast("string"))))
    plans = table(spark, folder, "events").select("event_id", F.to_json(F.struct(listed.alias("specs"))).alias("payload"))
    return plan_specs(plans)


def q_audit_plan(spark, folder):
    return audit_plan(
        proposed_specs(spark, folder), [*BASE_COLUMNS, "discount", "inventory_level"], ["roll_7", "user_9"], ["roll_8", "ratio_3"]
    )


def q_merge_planned_features(spark, folder):
    base = panel(spark, folder)
    made, _ = materialize_plan(base, [LAG, RATIO])
    reruns = made.withColumn("run", F.lit(1)).unionByName(
        made.withColumn("run", F.lit(2)).withColumn(RATIO.name, F.col(RATIO.name) * 2.0).where(F.col("units_sold") > 50)
    )
    return merge_planned_features(base.select(*BASE_COLUMNS), reruns, [RATIO.name], newest="run")


# ---------------------------------------------------------------- baselines and metrics


def _baseline_query(name: str) -> Query:
    def query(spark, folder):
        return rounded(baselines.baseline(split_panel(spark, folder), name), "prediction")

    return query


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    suite = baselines.baseline_suite(split_panel(spark, folder))
    return metrics.prediction_frame(rounded(suite, "prediction"))


def q_baseline_suite(spark, folder):
    return rounded(baselines.baseline_suite(split_panel(spark, folder)), "prediction")


def q_prediction_frame(spark, folder):
    return rounded(predictions(spark, folder), "prediction_error", "prediction_abs_error")


def q_forecast_metrics(spark, folder):
    return rounded_metrics(metrics.forecast_metrics(predictions(spark, folder)))


def q_segment_metrics(spark, folder):
    return rounded_metrics(metrics.segment_metrics(predictions(spark, folder)))


def _split_metrics(spark, folder) -> tuple[DataFrame, DataFrame]:
    found = settle(rounded_metrics(metrics.forecast_metrics(predictions(spark, folder))))
    return found.where(F.col("split") == "validation"), found.where(F.col("split") == "test")


def q_best_model(spark, folder):
    validation, _ = _split_metrics(spark, folder)
    return metrics.best_model(validation)


def q_best_model_registry(spark, folder):
    predicted = settle(predictions(spark, folder))
    overall = rounded_metrics(metrics.forecast_metrics(predicted))
    segments = rounded_metrics(metrics.segment_metrics(predicted))
    return metrics.best_model_registry(
        overall.where(F.col("split") == "validation"), overall.where(F.col("split") == "test"), segments
    )


def q_forecast_leaderboard(spark, folder):
    validation, test = _split_metrics(spark, folder)
    return metrics.forecast_leaderboard(validation, test)


def q_segment_extremes(spark, folder):
    segments = rounded_metrics(metrics.segment_metrics(predictions(spark, folder)))
    return metrics.segment_extremes(segments, "median_expanding")


def q_error_histogram(spark, folder):
    return rounded(explore.error_histogram(predictions(spark, folder), "naive_last"), "lower_edge", "upper_edge")


def q_model_comparison(spark, folder):
    found = rounded_metrics(metrics.forecast_metrics(predictions(spark, folder)))
    return metrics.model_comparison(found)


def q_busiest_segment_series(spark, folder):
    return metrics.busiest_segment_series(predictions(spark, folder), "rolling_mean_28")


def q_latest_models(spark, folder):
    """Training runs read off the orders: priority as model name, status as outcome."""
    runs = table(spark, folder, "orders").select(
        F.lower(F.substring("o_orderpriority", 3, 20)).alias("model_name"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("success").alias("status"),
        F.when(F.col("o_totalprice") < 250000, "global").otherwise("per-product").alias("segment_mode"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("trained_at_utc"),
        F.concat(F.lit("models/"), F.lpad(F.col("o_orderkey").cast("string"), 20, "0")).alias("model_path"),
    )
    return metrics.latest_models(runs, ["urgent", "high", "medium"], "global")


# ---------------------------------------------------------------- model matrix and models


def model_frame(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table, computed once."""
    return split.chronological_split(features.manual_features(panel(spark, folder)))


def q_encode_identifiers(spark, folder):
    tagged = split_panel(spark, folder)
    # The test rows once more under a store that training doesn't know, so that unseen ids occur.
    unseen = tagged.where(F.col("split") == "test").withColumn("store_id", F.lit("UNSEEN"))
    coded = matrix.encode_identifiers(tagged.unionByName(unseen))
    return coded.select(*KEY, "store_id_encoded", "product_id_encoded")


def _oddities(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "price_future": F.col("price"),
            "target_mean": F.col("units_sold"),
            "constant": F.lit(3.0),
            "never_known": F.lit(None).cast("double"),
        }
    )


def q_select_features(spark, folder):
    frame = _oddities(split_panel(spark, folder))
    _, reasons = matrix.select_features(frame, include_price=False)
    return reasons


def _gappy(df: DataFrame) -> DataFrame:
    """Values missing where the day of the month is 1, so that imputation has work to do."""
    first = F.dayofmonth("date") == 1
    return df.withColumns({c: F.when(~first, F.col(c)) for c in ("discount", "inventory_level")})


def q_impute_medians(spark, folder):
    filled = matrix.impute_medians(_gappy(split_panel(spark, folder)), ["discount", "inventory_level"])
    return filled.select(*KEY, "split", "discount", "inventory_level")


def q_model_matrix(spark, folder):
    """All features of the feature table, with gaps."""
    made = matrix.model_matrix(_gappy(model_frame(spark, folder)))
    values = vector_to_array("features")
    return _rounded_features(made.frame.select(*KEY, *[values[i].alias(f"feature_{c}") for i, c in enumerate(made.columns)]))


def _judged(predicted: DataFrame, frame: DataFrame) -> DataFrame:
    """Keys, actuals, whether the model has a number, the naive forecast's wMAPE and whether the model's is lower."""
    naive = metrics.forecast_metrics(metrics.prediction_frame(rounded(baselines.baseline(frame, "naive_last"), "prediction")))
    model = metrics.forecast_metrics(predicted)
    figures = naive.select("split", F.col("wmape").alias("naive_wmape")).join(model.select("split", F.col("wmape").alias("own")), "split")
    known = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < 1e9)
    joined = predicted.withColumn("has_prediction", known).join(figures, "split")
    return joined.select(*KEY, "split", "actual", "model_name", "has_prediction", "naive_wmape", (F.col("own") < F.col("naive_wmape")).alias("beats_naive"))


def _tree_query(train: Callable, name: str) -> Query:
    def query(spark, folder):
        frame = model_frame(spark, folder)
        made = models.matrix_of(frame)
        predicted = settle(models.score(made, train(made), name, "trees"))
        return _judged(predicted, frame)

    return query


def per_product_fits(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """The feature table with ids as codes, the models of all products on all selected columns, and these columns."""
    frame = settle(matrix.encode_identifiers(model_frame(spark, folder)))
    columns, _ = matrix.select_features(frame)
    return frame, settle(models.train_per_product(frame, columns)), columns


def q_train_per_product(spark, folder):
    """Rows of each product's model, how many weights it has, and the training error it leaves against the best constant."""
    frame, fits, columns = per_product_fits(spark, folder)
    train = frame.where(F.col("split") == "train")
    scored = models.score_per_product(train, fits, columns, matrix.training_medians(frame, columns))
    error = F.col("prediction") - F.col("units_sold")
    left = scored.groupBy("product_id").agg(
        F.avg(error).alias("mean_error"), (F.avg(error * error) < F.var_pop("units_sold")).alias("beats_constant"),
        F.round(F.var_pop("units_sold"), 6).alias("variance"),
    )
    own = fits.where("product_id is not null").select("product_id", "n_rows", F.size("coefficients").alias("n_weights"))
    return rounded(own.join(left, "product_id").withColumn("mean_error", F.round("mean_error", 3)), "mean_error", "variance")


def q_score_per_product(spark, folder):
    """One column and no penalty, which SQL can fit as well; all columns run in `train_per_product` and `evaluate_models`."""
    tagged = split_panel(spark, folder)
    fits = settle(models.train_per_product(tagged, ["price"], ridge=0.0))
    scored = models.score_per_product(tagged, fits, ["price"], matrix.training_medians(tagged, ["price"]))
    return rounded(scored.select(*KEY, "prediction"), "prediction")


def q_tune_models(spark, folder):
    """The full search: each trial with whether its parameters lie in the family's ranges and whether it beats the best constant error."""
    found = models.tune_models(models.matrix_of(model_frame(spark, folder)))
    params = F.from_json("params_json", "rounds double, rate double, depth double, least double, rows double, columns double")
    inside = F.lit(False)
    for family, ranges in models.SEARCH.items():
        held = F.col("model_name") == family
        for name, (low, high, _) in ranges.items():
            held &= params[name].between(low, high)
        inside |= held
    lowest = found.groupBy("model_name").agg(F.min("objective_value").alias("lowest"), F.count_if("is_best").alias("n_best"))
    judged = found.join(lowest, "model_name").withColumn("is_lowest", ~F.col("is_best") | (F.col("objective_value") == F.col("lowest")))
    return judged.select(
        "model_name", "trial_number", "state", inside.alias("in_ranges"), (F.col("objective_value") < 100).alias("useful"), "n_best", "is_lowest"
    )


def q_evaluate_models(spark, folder):
    """All candidates: figures of the baselines, and for trained models that they have all rows and beat the naive forecast."""
    found = evaluate.evaluate_models(model_frame(spark, folder))
    measured = settle(metrics.forecast_metrics(rounded(found.predictions, "prediction")))
    naive = measured.where("model_name = 'naive_last'").select("split", F.col("wmape").alias("naive_wmape"))
    judged = measured.join(naive, "split").withColumn("beats_naive", F.col("wmape") < F.col("naive_wmape"))
    hidden = F.col("model_family") != "baseline"
    kept = judged.withColumns({m: F.when(~hidden, F.col(m)) for m in metrics.METRICS})
    return rounded_metrics(kept).select("split", "model_name", "model_family", "n_obs", *metrics.METRICS, F.when(hidden, F.col("beats_naive")).alias("beats_naive"))


def q_forecast_next(spark, folder):
    """Each product's test rows by its winner among eight candidates; the winner is found again from the persisted predictions."""
    found = evaluate.evaluate_models(model_frame(spark, folder))
    forecast = evaluate.forecast_by_segment(found.predictions, found.registry)
    found.predictions.createOrReplaceTempView("candidate_predictions")
    again = spark.sql("""
        WITH errors AS (
          SELECT product_id, model_name, sum(cast(round(abs(prediction - actual) * 1000000) AS decimal(38,0))) AS error
          FROM candidate_predictions WHERE split = 'validation' GROUP BY product_id, model_name
        )
        SELECT product_id, min_by(model_name, struct(error, model_name)) AS winner, count(*) AS n_candidates FROM errors GROUP BY product_id""")
    joined = forecast.join(again, "product_id", "left")
    known = F.col("forecast_units").isNotNull() & ~F.isnan("forecast_units")
    own = F.col("winner").isNull() | (F.col("winner") == F.col("model_name"))
    return joined.select(*KEY, "actual_units", "source_split", "n_candidates", known.alias("has_forecast"), own.alias("by_winner"))


def q_saved_forecast(spark, folder):
    """Train, save, register, then forecast with the overall winner read back: equal to the model that was saved."""
    frame = model_frame(spark, folder)
    made = models.matrix_of(frame)
    fitted = models.train_gbt(made)
    scored = settle(models.score(made, fitted, "gbt", "trees"))
    found = settle(metrics.forecast_metrics(scored))
    of = lambda name: found.where(F.col("split") == name)
    registry = metrics.best_model_registry(of("validation"), of("test"), metrics.segment_metrics(scored))
    runs = saved.save_model(made, fitted, "gbt", "trees", output_folder(spark, "gbt"), "2024-01-01T00:00:00")
    again = saved.forecast_registered(frame, registry, runs)
    joined = again.join(scored.select(*KEY, "prediction"), KEY)
    return joined.select(*KEY, "actual_units", "model_name", "source_split", (F.col("forecast_units") == F.col("prediction")).alias("as_saved"))


# ---------------------------------------------------------------- elasticity and scenarios


def q_loglog_elasticity(spark, folder):
    fits = elasticity.loglog_elasticity(lazy_panel(spark, folder))
    return rounded(fits, "intercept", "price_elasticity", "r_squared")


def q_price_plan_forecast(spark, folder):
    base = panel(spark, folder)
    fits = elasticity.loglog_elasticity(base)
    forecast = elasticity.price_plan_forecast(base, fits, 14, plan=future_prices(base))
    return rounded(forecast, "forecast_units", "baseline_units", "planned_price", "reference_price", "applied_elasticity")


def q_validate_price_plan(spark, folder):
    plan = future_prices(lazy_panel(spark, folder)).withColumns(
        {
            "date": F.when(F.col("store_id") == "ASIA", "someday").otherwise(F.col("date").cast("string")),
            "price": F.when(F.col("product_id") == "Brand#11", -F.col("price")).otherwise(F.col("price")),
        }
    )
    return elasticity.price_plan_report(plan)


def q_log_treatment(spark, folder):
    return rounded(elasticity.log_treatment(lazy_panel(spark, folder)).select(*KEY, "y_log", "t_log"), "y_log", "t_log")


def q_segment_key(spark, folder):
    keyed = elasticity.segment_key(lazy_panel(spark, folder), "store_product")
    return keyed.groupBy("segment_key").agg(F.count(F.lit(1)).alias("n_rows"))


def logged_panel(spark: SparkSession, folder: str, level: str = "product") -> DataFrame:
    return elasticity.segment_key(elasticity.log_treatment(panel(spark, folder)), level)


GUARD_FIGURES = ("log_price_std", "log_units_std", "treatment_variance", "outcome_variance")


def q_segment_guardrails(spark, folder):
    found = elasticity.segment_guardrails(logged_panel(spark, folder, "store_product"))
    return rounded(found, *GUARD_FIGURES)


CONTROLS = ["discount", "inventory_level"]


def q_segment_controls(spark, folder):
    gappy = _gappy(logged_panel(spark, folder)).withColumn(
        "inventory_level", F.when(F.col("product_id") == "Brand#11", 5.0).otherwise(F.col("inventory_level"))
    )
    return dml.segment_controls(gappy, ["segment_key"], CONTROLS).select(*KEY, *CONTROLS, "controls_used")


def _residuals(spark, folder) -> DataFrame:
    keyed = logged_panel(spark, folder)
    return dml.cross_fit_residuals(keyed, ["segment_key"], ["discount"], "linear")


def q_cross_fit_residuals(spark, folder):
    return rounded(_residuals(spark, folder).select(*KEY, "fold", "y_res", "t_res"), "y_res", "t_res")


def _tree_residuals(nuisance: str) -> Query:
    """Residuals of each row by the trees of its segment, on all controls: whether the trees' values are known and, for means
    of training values, lie among the other fold's, and whether they leave less than the other fold's mean does."""

    def query(spark, folder):
        frame = model_frame(spark, folder)
        controls = dml.select_controls(frame)
        keyed = elasticity.segment_key(elasticity.log_treatment(frame), "product")
        filled = dml.segment_controls(keyed, ["segment_key"], controls, scaled=True)
        made = settle(dml.cross_fit_residuals(filled, ["segment_key"], controls, nuisance))
        other = made.groupBy("segment_key", (1 - F.col("fold")).alias("fold")).agg(
            *[f(c).alias(f"{n}_{c}") for c in ("y_log", "t_log") for n, f in (("low", F.min), ("high", F.max))]
        )
        joined = made.join(other, ["segment_key", "fold"])
        inside = [((F.col(c) - F.col(r)).between(F.col(f"low_{c}") - 1e-6, F.col(f"high_{c}") + 1e-6)) for c, r in dml.TARGETS.items()]
        known = F.col("y_res").isNotNull() & F.col("t_res").isNotNull()
        if nuisance == "random-forest":
            known = known & inside[0] & inside[1]
        return rounded(joined.select(*KEY, "segment_key", "fold", "y_log", "t_log", known.alias("has_residuals")), "y_log", "t_log")

    return query


def q_dml_elasticity(spark, folder):
    found = dml.dml_elasticity(settle(_residuals(spark, folder)), ["segment_key"], ["discount"])
    kept = found.select("segment_key", "n_rows", "elasticity_estimate", "lower_ci", "upper_ci", "inference_warning_count")
    return rounded(kept, "elasticity_estimate", "lower_ci", "upper_ci")


def q_elasticity_estimates_linear(spark, folder):
    """One control and straight lines, which SQL can fit as well."""
    base = lazy_panel(spark, folder).select(*BASE_COLUMNS, "discount")
    config = dml.ElasticityConfig(level="store_product", nuisance="linear")
    found = dml.elasticity_estimates(base, config)
    return rounded(found, "elasticity_estimate", "lower_ci", "upper_ci", *GUARD_FIGURES)


def q_elasticity_estimates(spark, folder):
    """The whole feature table, all controls and forests per segment: guards, statuses and controls, and whether bounds hold the estimate."""
    found = dml.elasticity_estimates(model_frame(spark, folder))
    bounds = F.col("lower_ci").isNull() | ((F.col("lower_ci") <= F.col("elasticity_estimate")) & (F.col("elasticity_estimate") <= F.col("upper_ci")))
    kept = found.select(
        "segmentation_level", "feature_profile_used", "segment_key", "sample_size", "non_null_pair_count", "unique_price_values", *GUARD_FIGURES,
        "fit_status", "skip_reason", "feature_count_used", F.col("elasticity_estimate").isNotNull().alias("has_estimate"), bounds.alias("in_bounds"),
    )
    return rounded(kept, *GUARD_FIGURES)


def loglog_estimates(spark: SparkSession, folder: str) -> DataFrame:
    """Log-log fits with normal bounds, in the form of an estimates table.

    Thin fits have no bounds and flat ones a warning text, so every quality status occurs.
    """
    base = panel(spark, folder)
    fits = elasticity.loglog_elasticity(base, 2)
    slope, r2, n = F.col("price_elasticity"), F.col("r_squared"), F.col("n_observations")
    spread = F.stddev_pop(F.log("units_sold")) / F.stddev_pop(F.log("price"))
    spreads = base.groupBy("store_id", "product_id").agg(spread.alias("spread"))
    error = F.col("spread") * F.sqrt((1 - r2) / (n - 2))
    status = F.when(n < 350, "skipped").when(F.col("product_id") == "Brand#11", "failed").otherwise("success")
    made = fits.join(spreads, ["store_id", "product_id"]).select(
        scalars.segment_label(["store_id", "product_id"]).alias("segment_key"),
        status.alias("fit_status"),
        F.round(slope, 6).alias("elasticity_estimate"),
        F.when(n < 430, F.round(slope - 1.96 * error, 6)).alias("lower_ci"),
        F.round(slope + 1.96 * error, 6).alias("upper_ci"),
        F.when(status == "skipped", "too few rows").when(status == "failed", "fit_failed: singular").otherwise("").alias("skip_reason"),
        F.when(F.col("store_id") == "ASIA", "Inference may be unstable").otherwise("").alias("warnings_text"),
        F.when(F.col("store_id") == "EUROPE", 1).otherwise(0).cast("long").alias("inference_warning_count"),
    )
    return settle(made)


def q_elasticity_quality(spark, folder):
    return elasticity.elasticity_quality(loglog_estimates(spark, folder))


def q_elasticity_run_summary(spark, folder):
    return elasticity.elasticity_run_summary(elasticity.elasticity_quality(loglog_estimates(spark, folder)))


def q_elasticity_skip_reasons(spark, folder):
    return elasticity.skip_reason_counts(loglog_estimates(spark, folder))


def q_elasticity_top_segments(spark, folder):
    return elasticity.elasticity_top_segments(loglog_estimates(spark, folder))


def q_elasticity_histogram(spark, folder):
    return rounded(elasticity.elasticity_histogram(loglog_estimates(spark, folder)), "lower_edge", "upper_edge")


def q_elasticity_ci_table(spark, folder):
    return rounded(elasticity.elasticity_ci_table(loglog_estimates(spark, folder)), "lower_error", "upper_error")


# ---------------------------------------------------------------- exploration


def q_coverage(spark, folder):
    return rounded(explore.coverage(panel(spark, folder)), "zero_demand_rate")


def q_rows_per_key(spark, folder):
    return explore.rows_per_key(lazy_panel(spark, folder), "product_id")


def q_column_histogram(spark, folder):
    return rounded(explore.column_histogram(panel(spark, folder), "units_sold"), "lower_edge", "upper_edge")


def q_describe(spark, folder):
    found = explore.describe(panel(spark, folder), ["units_sold", "price", "discount", "inventory_level"])
    return rounded(found, "mean", "std", "q25", "q50", "q75")


SPEC_QUERIES = {
    "spec_lag": _spec_query(LAG),
    "spec_rolling": _spec_query(ROLLING, inexact=True),
    "spec_ratio": _spec_query(RATIO),
    "spec_difference": _spec_query(DIFFERENCE),
    "spec_interaction": _spec_query(INTERACTION),
    "spec_binary_flag": _spec_query(FLAG),
    "spec_calendar": _spec_query(CALENDAR),
}
BASELINE_QUERIES = {f"baseline_{name}": _baseline_query(name) for name in baselines.BASELINES}
TREE_QUERIES = {
    "train_gbt": _tree_query(models.train_gbt, "gbt"),
    "train_gbt_deep": _tree_query(models.train_gbt_deep, "gbt_deep"),
}


NUISANCE_QUERIES = {
    "residuals_random_forest": _tree_residuals("random-forest"),
    "residuals_gradient_boosting": _tree_residuals("gradient-boosting"),
}


def all_queries() -> dict[str, Query]:
    named = {name[2:]: query for name, query in globals().items() if name.startswith("q_")}
    return {**named, **SPEC_QUERIES, **BASELINE_QUERIES, **TREE_QUERIES, **NUISANCE_QUERIES}
