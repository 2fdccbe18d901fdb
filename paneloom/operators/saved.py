"""Trained tree models kept with all that scoring new rows needs, and forecasts by registry."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom.operators.matrix import Matrix, assemble, encode_with
from paneloom.operators.metrics import latest_models
from paneloom.operators import trees
from paneloom.operators.models import TreeModel, _latest_forecast
from paneloom.schema import PanelError

RUN_SCHEMA = "model_name string, status string, segment_mode string, trained_at_utc string, model_path string"


@dataclass(frozen=True)
class SavedModel:
    """A fitted model with its column order, training medians and id codes."""

    model: TreeModel
    columns: list[str]
    medians: dict[str, float]
    target: str
    codes: Mapping[str, DataFrame]
    name: str
    family: str

    def predict(self, df: DataFrame) -> DataFrame:
        """Add `prediction` to rows of any table: ids by the stored codes, gaps by the stored medians."""
        return self.model.transform(assemble(encode_with(df, self.codes), self.columns, self.medians)).drop("features")


def save_model(
    matrix: Matrix, model: TreeModel, name: str, family: str, path: str, trained_at_utc: str
) -> DataFrame:
    """Write the model below `path`, which all executors share; returns its row for a table of runs."""
    spark = matrix.frame.sparkSession
    parts = [tuple(r.values()) for r in trees.packed(model.fit).to_pylist()]
    spark.createDataFrame(parts, trees.TREE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    for column, codes in matrix.codes.items():
        codes.write.mode("overwrite").parquet(f"{path}/codes/{column}")
    facts = (matrix.columns, matrix.medians, matrix.target, list(matrix.codes), name, family, model.fit.edges.tolist(), model.fit.rate, model.family)
    schema = (
        "columns array<string>, medians map<string,double>, target string, ids array<string>, name string, family string, "
        "edges array<array<double>>, rate double, trees string"
    )
    spark.createDataFrame([facts], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")
    return spark.createDataFrame([(name, "success", "global", trained_at_utc, path)], RUN_SCHEMA)


def load_model(spark: SparkSession, path: str) -> SavedModel:
    """Read what `save_model` wrote."""
    facts = spark.read.parquet(f"{path}/facts").first()
    codes = {column: spark.read.parquet(f"{path}/codes/{column}") for column in facts["ids"]}
    fit = trees.unpacked(spark.read.parquet(f"{path}/model").collect(), np.array(facts["edges"]), facts["rate"])
    return SavedModel(
        TreeModel(fit, facts["trees"]), facts["columns"], facts["medians"], facts["target"], codes,
        facts["name"], facts["family"],
    )


def forecast_registered(df: DataFrame, registry: DataFrame, runs: DataFrame) -> DataFrame:
    """Forecast the latest non-empty split of `df` with the overall winner of `registry`.

    The model is the newest successful run of that name in `runs`.
    """
    winner = registry.where(F.col("scope") == "overall").select("model_name").first()
    if winner is None:
        raise PanelError("The registry names no overall winner")
    run = latest_models(runs, [winner["model_name"]], "global").select("model_path").first()
    if run is None:
        raise PanelError(f"No saved run of the winner '{winner['model_name']}'")
    saved = load_model(df.sparkSession, run["model_path"])
    return _latest_forecast(df, saved.predict, saved.target, saved.name, saved.family)
