"""Forecast errors, metrics and model rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.functions.scalars import segment_label
from paneloom.schema import DATE, PANEL_KEY, PRODUCT, PanelError, require_columns

METRICS = ("mape", "wmape", "mae", "rmse")


def metric_name(name: str) -> str:
    plain = name.strip().lower()
    if plain not in METRICS:
        raise PanelError(f"Unsupported metric '{name}'. Allowed values: {', '.join(sorted(METRICS))}")
    return plain


def prediction_frame(
    scored: DataFrame, model: str | None = None, family: str | None = None, target: str = "actual"
) -> DataFrame:
    """Long prediction table with errors. Model and family default to columns of `scored`."""
    error = F.col("prediction") - F.col(target)
    return scored.select(
        *PANEL_KEY,
        F.col(target).alias("actual"),
        "prediction",
        error.alias("prediction_error"),
        F.abs(error).alias("prediction_abs_error"),
        F.lit(model).alias("model_name") if model else F.col("model_name"),
        F.lit(family).alias("model_family") if family else F.col("model_family"),
        "split",
    )


def _whole(value: Column, unit: float, digits: int) -> Column:
    return F.round(value / unit).cast(f"decimal({digits},0)")


def _metric_columns(eps: float) -> dict[str, Column]:
    """Errors are summed as whole millionths and ratios as whole billionths, so that no order of
    summing, and no number of partitions, changes a metric."""
    actual = F.col("actual")
    size, magnitude = F.abs(F.col("prediction") - actual), F.abs(actual)
    millionths = _whole(size, 1e-6, 19)
    exact_sum = lambda units: F.sum(units).cast("double")
    sizes, total, n = exact_sum(millionths), exact_sum(_whole(magnitude, 1e-6, 19)), F.count(millionths)
    ratio = F.when(magnitude > eps, _whole(size / magnitude, 1e-9, 28))
    return {
        "mape": exact_sum(ratio) / F.count(ratio) / 1e9 * 100.0,
        "wmape": F.when(total > eps * 1e6, sizes / total).otherwise(sizes / n / 1e6) * 100.0,
        "mae": sizes / n / 1e6,
        "rmse": F.sqrt(exact_sum(millionths * millionths) / n) / 1e6,
    }


def _metrics_by(df: DataFrame, keys: list[str], eps: float) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_obs"), *[c.alias(n) for n, c in _metric_columns(eps).items()]
    )


def forecast_metrics(predictions: DataFrame, eps: float = 1e-8) -> DataFrame:
    """MAPE over non-zero actuals, wMAPE, MAE and RMSE per split and model."""
    return _metrics_by(predictions, ["split", "model_name", "model_family"], eps)


def segment_metrics(predictions: DataFrame, eps: float = 1e-8) -> DataFrame:
    """The same per product."""
    keyed = predictions.withColumn("segment_key", segment_label([PRODUCT]))
    return _metrics_by(keyed, ["split", "model_name", "model_family", "segment_key"], eps)


def metric_value(predictions: DataFrame, metric: str, eps: float = 1e-8) -> float | None:
    """One metric over all rows, as a number."""
    return predictions.agg(_metric_columns(eps)[metric_name(metric)].alias("value")).first()["value"]


def best_model(metrics: DataFrame, metric: str = "wmape") -> DataFrame:
    """The row with the lowest known metric; equal values go to the first name."""
    name = metric_name(metric)
    require_columns(metrics, [name], "Metrics table")
    return metrics.where(F.col(name).isNotNull()).orderBy(name, "model_name").limit(1)


def forecast_leaderboard(validation: DataFrame, test: DataFrame, metric: str = "wmape") -> DataFrame:
    """Validation and test metrics per model, ranked by the validation metric."""
    name = f"validation_{metric_name(metric)}"
    keys = ["model_name", "model_family"]
    require_columns(validation, (*keys, *METRICS), "Validation metrics")
    require_columns(test, (*keys, *METRICS), "Test metrics")
    left = validation.select(*keys, *[F.col(m).alias(f"validation_{m}") for m in METRICS])
    right = test.select(*keys, *[F.col(m).alias(f"test_{m}") for m in METRICS])
    models = Window.partitionBy(F.lit(0)).orderBy(name, "model_name")  # one row per model
    return (
        left.join(right, keys, "left")
        .where(F.col(name).isNotNull())
        .withColumn("validation_rank", F.row_number().over(models))
        .withColumn("is_best_overall", F.col("validation_rank") == 1)
    )


def best_model_registry(
    validation: DataFrame, test: DataFrame, segments: DataFrame, metric: str = "wmape"
) -> DataFrame:
    """The overall winner with its test metrics, and the winner of each segment without them."""
    name = metric_name(metric)
    validation_columns = [F.col(m).alias(f"validation_{m}") for m in METRICS]
    overall = (
        best_model(validation, name)
        .select("model_name", "model_family", *validation_columns)
        .join(test.select("model_name", *[F.col(m).alias(f"test_{m}") for m in METRICS]), "model_name", "left")
        .withColumns({"scope": F.lit("overall"), "segment_key": F.lit("all")})
    )
    # Lowest (metric, name) per segment as an aggregate, so models are compared before the shuffle.
    ranked = F.min(F.struct(F.col(name).alias("rank_value"), "model_name", "model_family", *METRICS)).alias("best")
    winners = (
        segments.where((F.col("split") == "validation") & F.col(name).isNotNull())
        .groupBy("segment_key")
        .agg(ranked)
        .select(
            "segment_key",
            "best.model_name",
            "best.model_family",
            *[F.col(f"best.{m}").alias(f"validation_{m}") for m in METRICS],
            *[F.lit(None).cast("double").alias(f"test_{m}") for m in METRICS],
            F.lit("per-product").alias("scope"),
        )
    )
    return overall.unionByName(winners).withColumn("optimize_metric", F.lit(name))


def latest_models(registry: DataFrame, names: list[str], mode: str | None = None) -> DataFrame:
    """Newest successful training per requested model; one time stamp twice goes to the larger path."""
    wanted = (F.col("status") == "success") & F.col("model_name").isin(*names)
    if mode is not None:
        wanted &= F.col("segment_mode") == mode
    others = [c for c in registry.columns if c != "model_name"]
    newest = F.max_by(F.struct(*others), F.struct("trained_at_utc", "model_path")).alias("newest")
    return registry.where(wanted).groupBy("model_name").agg(newest).select("model_name", "newest.*")


def segment_extremes(segments: DataFrame, model: str, metric: str = "wmape", n: int = 10) -> DataFrame:
    """The model's best and worst validation segments; unknown values count as worst."""
    name = metric_name(metric)
    rows = segments.where((F.col("split") == "validation") & (F.col("model_name") == model))
    best = rows.orderBy(F.asc_nulls_last(name), F.asc("segment_key")).limit(n)
    worst = rows.orderBy(F.desc_nulls_first(name), F.desc("segment_key")).limit(n)
    return best.withColumn("rank_group", F.lit("best")).unionByName(worst.withColumn("rank_group", F.lit("worst")))


def model_comparison(metrics: DataFrame, metric: str = "wmape") -> DataFrame:
    """Validation against test metric per model; a model in only one split is kept."""
    name = metric_name(metric)
    pivoted = metrics.groupBy("model_name").pivot("split", ["validation", "test"]).agg(F.first(name))
    return pivoted.withColumnsRenamed({s: f"{s}_{name}" for s in ("validation", "test")})


def busiest_segment_series(predictions: DataFrame, model: str, split: str = "validation") -> DataFrame:
    """Actual and prediction by date of the product with most rows; ties go to the first id."""
    rows = predictions.where((F.col("model_name") == model) & (F.col("split") == split))
    busiest = rows.groupBy(PRODUCT).count().orderBy(F.desc("count"), PRODUCT).limit(1).select(PRODUCT)
    return rows.join(busiest, PRODUCT, "left_semi").select(*PANEL_KEY, "actual", "prediction").orderBy(DATE)
