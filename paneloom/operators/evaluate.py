"""Baselines and trained models in one evaluation, and forecasts by each segment's winner."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.functions.scalars import segment_label
from paneloom.operators.baselines import baseline_suite
from paneloom.operators.matrix import Matrix, model_matrix
from paneloom.operators.metrics import best_model_registry, forecast_metrics, metric_name, prediction_frame, segment_metrics
from paneloom.operators.models import FAMILIES, TreeModel, at_a_time, prepare, score, score_per_product, train_gbt, train_gbt_deep, train_per_product
from paneloom.operators.scaling import join_same, settle
from paneloom.schema import PANEL_KEY, PRODUCT, UNITS, PanelError

PER_PRODUCT = "ridge_per_product"


@dataclass(frozen=True)
class Evaluation:
    """Trained candidates, every candidate's predictions for the validation and test rows, and the registry of winners."""

    matrix: Matrix
    trees: dict[str, TreeModel]
    per_product: DataFrame
    predictions: DataFrame
    metrics: DataFrame
    registry: DataFrame


def evaluate_models(
    df: DataFrame, target: str = UNITS, metric: str = "wmape", params: Mapping[str, Mapping[str, Any]] | None = None, seed: int = 42
) -> Evaluation:
    """Train both tree families and the models per product on the training rows of a split-tagged feature
    table, and score them and all baselines on the validation and test rows.

    `params` has parameters by family, e.g. those of `best_params`. Predictions are one long table, written once;
    metrics, the overall winner and the winners per product all come from it.
    """
    metric_name(metric)
    unknown = sorted(set(params or {}) - set(FAMILIES))
    if unknown:
        raise PanelError(f"Unsupported model family '{unknown[0]}'. Allowed values: {', '.join(FAMILIES)}")
    matrix = model_matrix(df, target)
    prepared = prepare(matrix)
    coded = matrix.frame.drop("features")  # the rows of `df` with their id codes, as the matrix has them written
    trained = {name: partial(train, prepared, (params or {}).get(name), seed) for name, train in (("gbt", train_gbt), ("gbt_deep", train_gbt_deep))}
    linear_fits = lambda: settle(train_per_product(coded, matrix.columns, target, medians=matrix.medians))
    # The three fits at a time: each of the first two keeps one task busy.
    *fitted, per_product = at_a_time(df.sparkSession, [*trained.values(), linear_fits], 3)
    fits = dict(zip(trained, fitted))
    held_out = coded.where(F.col("split").isin("validation", "test"))
    linear = score_per_product(held_out, per_product, matrix.columns, matrix.medians)
    parts = [
        prediction_frame(baseline_suite(df, target)),
        *[score(matrix, fitted, name, "trees") for name, fitted in fits.items()],
        prediction_frame(linear, PER_PRODUCT, "linear", target),
    ]
    joint = parts[0]
    for part in parts[1:]:
        joint = joint.unionByName(part)
    joint = settle(joint)
    found = settle(forecast_metrics(joint))
    of = lambda name: found.where(F.col("split") == name)
    registry = settle(best_model_registry(of("validation"), of("test"), segment_metrics(joint), metric))
    return Evaluation(matrix, fits, per_product, joint, found, registry)


def forecast_by_segment(predictions: DataFrame, registry: DataFrame) -> DataFrame:
    """The latest split's rows with the prediction of their product's winner, else of the overall winner.

    `predictions` is the long table of candidates, `registry` the table of winners; a product without an
    entry of its own, or whose winner has no prediction for a row, takes the overall one.
    """
    split = predictions.agg(F.max(F.when(F.col("split") == "test", "test").otherwise("another"))).first()[0]
    if split is None:
        raise PanelError("There is no prediction to choose from")
    latest = "test" if split == "test" else "validation"
    overall = registry.where(F.col("scope") == "overall").select("model_name").first()
    if overall is None:
        raise PanelError("The registry names no overall winner")
    own = registry.where(F.col("scope") == "per-product").select("segment_key", F.col("model_name").alias("__winner"))
    rows = predictions.where(F.col("split") == latest).withColumn("segment_key", segment_label([PRODUCT]))
    rows = join_same(rows, own, ["segment_key"], "left")
    # The product's winner first; candidates are compared before the shuffle.
    place = F.when(F.col("model_name") == F.col("__winner"), 0).when(F.col("model_name") == overall["model_name"], 1)
    chosen = F.min_by(F.struct("actual", "prediction", "model_name", "model_family"), place).alias("chosen")
    return rows.where(place.isNotNull()).groupBy(*PANEL_KEY).agg(chosen).select(
        *PANEL_KEY, F.col("chosen.actual").alias("actual_units"), F.col("chosen.prediction").alias("forecast_units"),
        "chosen.model_name", "chosen.model_family", F.lit(latest).alias("source_split"),
    )
