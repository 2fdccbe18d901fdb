"""Forecast models on the assembled matrix: boosted trees, and a ridge model per product."""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import partial
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom.functions.scalars import as_double
from paneloom.operators import trees
from paneloom.operators.matrix import Matrix, model_matrix, training_medians
from paneloom.operators.metrics import metric_name, metric_value, prediction_frame
from paneloom.operators.scaling import join_same, settle
from paneloom.schema import DATE, PANEL_KEY, PRODUCT, STORE, UNITS, PanelError

HELD_ROWS = 2_000_000  # training rows that one task boosts on; more are boosted on by a job per level
ROUNDS_A_STAGE = 100

# Default rounds, rate and sampling of the two tree families.
FAMILIES: dict[str, dict[str, Any]] = {
    "gbt": {"rounds": 300, "rate": 0.05, "depth": 5, "least": 20, "rows": 0.9, "columns": 0.9},
    "gbt_deep": {"rounds": 320, "rate": 0.05, "depth": 6, "least": 1, "rows": 0.9, "columns": 0.9},
}


@dataclass(frozen=True)
class TreeModel:
    """A fitted ensemble for a `features` vector."""

    fit: trees.Fit
    family: str

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `prediction`."""
        return df.withColumn("prediction", trees.prediction(self.fit, vector_to_array("features")))


@dataclass(frozen=True)
class Prepared:
    """Training rows as bins (key, y, codes), written once for any number of fits."""

    rows: DataFrame
    edges: np.ndarray
    total: int


def prepare(matrix: Matrix) -> Prepared:
    """Bin the training rows of a matrix: edges from a bounded sample by key, one byte per column."""
    key, values = F.xxhash64(*PANEL_KEY), vector_to_array("features")
    train = matrix.frame.where(F.col("split") == "train")
    train = train.select(key.alias("key"), F.col(matrix.target).cast("double").alias("y"), values.alias("values"))
    total = train.count()
    if not total:
        raise PanelError("There is no training row")
    edges = trees.bin_edges(train, "values", "key", total)
    return Prepared(settle(trees.binned(train, "values", edges, ["key", "y"])), edges, total)


def boosting_of(family: str, params: Mapping[str, Any] | None = None, seed: int = 42) -> trees.Boosting:
    """The family's parameters with those of `params` in their place."""
    if seed < 0:
        raise PanelError("seed must be non-negative")
    if family not in FAMILIES:
        raise PanelError(f"Unsupported model family '{family}'. Allowed values: {', '.join(FAMILIES)}")
    chosen = {**FAMILIES[family], **(params or {})}
    unknown = sorted(set(chosen) - set(FAMILIES[family]))
    if unknown:
        raise PanelError(f"Unknown parameter '{unknown[0]}'. Allowed values: {', '.join(FAMILIES[family])}")
    ranges = {"rounds": (1, 100_000), "rate": (1e-9, 1), "depth": (1, 16), "least": (1, 1 << 40), "rows": (1e-9, 1), "columns": (1e-9, 1)}
    for name, (low, high) in ranges.items():
        if not low <= chosen[name] <= high:
            raise PanelError(f"Parameter '{name}' must be between {low} and {high}")
    return trees.Boosting(**chosen, seed=seed)


def _fit(prepared: Prepared, family: str, params: Mapping[str, Any] | None, seed: int, held_rows: int = HELD_ROWS) -> TreeModel:
    chosen = boosting_of(family, params, seed)
    return TreeModel(trees.boosted(prepared.rows, chosen, prepared.edges, prepared.total, held_rows, ROUNDS_A_STAGE), family)


def train_gbt(matrix: Matrix | Prepared, params: Mapping[str, Any] | None = None, seed: int = 42, held_rows: int = HELD_ROWS) -> TreeModel:
    """Boosted trees of depth 5 (about 31 leaves), 300 rounds unless `params` says otherwise.

    Each round samples rows by a hash of the panel key and the round, and takes exact sums, so
    neither partitions nor `held_rows`, the most rows that one task holds, change the model.
    """
    return _fit(matrix if isinstance(matrix, Prepared) else prepare(matrix), "gbt", params, seed, held_rows)


def train_gbt_deep(matrix: Matrix | Prepared, params: Mapping[str, Any] | None = None, seed: int = 42, held_rows: int = HELD_ROWS) -> TreeModel:
    """The second family: depth 6, 320 rounds."""
    return _fit(matrix if isinstance(matrix, Prepared) else prepare(matrix), "gbt_deep", params, seed, held_rows)


def score(matrix: Matrix, model: TreeModel, name: str, family: str) -> DataFrame:
    """Long prediction table of the validation and test rows."""
    held_out = matrix.frame.where(F.col("split").isin("validation", "test"))
    return prediction_frame(model.transform(held_out), name, family, matrix.target)


def forecast_next(matrix: Matrix, model: TreeModel, name: str, family: str) -> DataFrame:
    """Score the latest non-empty split: test, else validation, else train."""
    return _latest_forecast(matrix.frame, model.transform, matrix.target, name, family)


def _latest_forecast(df: DataFrame, predict: Callable[[DataFrame], DataFrame], target: str, name: str, family: str) -> DataFrame:
    present = {r["split"] for r in df.select("split").distinct().collect()}
    latest = next((s for s in ("test", "validation", "train") if s in present), None)
    if latest is None:
        raise PanelError("There is no row to forecast in the train, validation or test split")
    return predict(df.where(F.col("split") == latest)).select(
        DATE,
        STORE,
        PRODUCT,
        F.col(target).alias("actual_units"),
        F.col("prediction").alias("forecast_units"),
        F.lit(name).alias("model_name"),
        F.lit(family).alias("model_family"),
        F.lit(latest).alias("source_split"),
    )


_SUMS = f"{PRODUCT} string, n_rows long, sums array<double>"
_SUM_BYTES = 64 << 20  # cross products that a task holds before it passes them on


def _cross_products(rows: DataFrame, columns: Sequence[str], centre: np.ndarray, scale: np.ndarray) -> DataFrame:
    """(product, rows, upper triangle of the Gram matrix and right side) of [1, scaled columns] per product."""
    k = len(columns) + 1
    upper = np.triu_indices(k)
    most = max(1, _SUM_BYTES // (8 * k * (k + 1)))

    def run(batches):
        held: dict = {}

        def passed_on():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(held), pa.string()), pa.array([n for n, _, _ in held.values()], pa.int64()),
                    pa.array([np.r_[g[upper], r].tolist() for _, g, r in held.values()], pa.list_(pa.float64())),
                ],
                names=[PRODUCT, "n_rows", "sums"],
            )
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column("__y").to_numpy(zero_copy_only=False)
            z = np.column_stack([np.ones(len(y)), *[(batch.column(c).to_numpy(zero_copy_only=False) - m) / s for c, m, s in zip(columns, centre, scale)]])
            products = batch.column(PRODUCT).dictionary_encode()
            names = [*products.dictionary.to_pylist(), None]
            codes = products.indices.fill_null(len(names) - 1).to_numpy(zero_copy_only=False)
            for code in np.unique(codes):
                own, target = z[codes == code], y[codes == code]
                n, gram, right = held.get(names[code], (0, 0.0, 0.0))
                held[names[code]] = (n + len(own), gram + own.T @ own, right + own.T @ target)
            if len(held) > most:
                yield from passed_on()
        if held:
            yield from passed_on()

    return _summed(rows.select(PRODUCT, "__y", *columns).mapInArrow(run, _SUMS))


def _summed(parts: DataFrame) -> DataFrame:
    """Sums of the rows of each product; there are few, as tasks have added up theirs."""

    def run(table: pa.Table) -> pa.Table:
        sums = sorted(table.column("sums").to_pylist())  # in an order that doesn't depend on the tasks
        return pa.table(
            {
                PRODUCT: table.column(PRODUCT).slice(0, 1), "n_rows": pa.array([pc.sum(table.column("n_rows")).as_py()], pa.int64()),
                "sums": pa.array([np.sum(sums, axis=0).tolist()], pa.list_(pa.float64())),
            }
        )

    return parts.groupBy(PRODUCT).applyInArrow(run, _SUMS)


def train_per_product(
    df: DataFrame,
    columns: Sequence[str],
    target: str = UNITS,
    min_rows: int = 5,
    ridge: float = 1e-6,
    medians: Mapping[str, float] | None = None,
) -> DataFrame:
    """Linear model per product with at least `min_rows` training rows, and one over all rows.

    Each task sums the cross products of the centred features per product, so a product of any size
    arrives as one row per task; a small solve per product follows. The
    row with a NULL product is the model for all others. Columns: product_id, n_rows, intercept,
    coefficients (in the order of `columns`). `medians` are those of the training rows, if they are known.
    """
    columns = list(columns)
    train = df.where(F.col("split") == "train")
    medians = training_medians(df, columns) if medians is None else medians
    filled = train.select(
        PRODUCT,
        as_double(df, target).alias("__y"),
        *[F.coalesce(as_double(df, c), F.lit(medians[c])).alias(c) for c in columns],
    )
    # Centring and scaling with global constants keeps the sums well conditioned.
    moments = filled.agg(
        *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(columns)],
    ).first()
    centre = np.array([moments[f"m_{i}"] or 0.0 for i in range(len(columns))])
    scale = np.array([moments[f"s_{i}"] or 1.0 for i in range(len(columns))])
    k = len(columns) + 1
    per_product = settle(_cross_products(filled, columns, centre, scale))
    eligible = per_product.where((F.col("n_rows") >= min_rows) & F.col(PRODUCT).isNotNull())
    if eligible.isEmpty():
        raise PanelError("No product has enough rows for its own model")
    overall = _summed(per_product.withColumn(PRODUCT, F.lit(None).cast("string")))
    systems = eligible.unionByName(overall)

    def solve(batches):
        upper = np.triu_indices(k)
        penalty = np.diag([0.0, *[ridge] * (k - 1)])
        for batch in batches:
            solved = []
            for sums, n in zip(batch["sums"], batch["n_rows"]):
                matrix = np.zeros((k, k))
                matrix[upper] = sums[: len(upper[0])]
                matrix = matrix + np.triu(matrix, 1).T + n * penalty
                weights = np.linalg.pinv(matrix, hermitian=True) @ np.asarray(sums[len(upper[0]) :])
                slopes = weights[1:] / scale
                solved.append((float(weights[0] - slopes @ centre), [float(v) for v in slopes]))
            yield pd.DataFrame(
                {
                    PRODUCT: batch[PRODUCT],
                    "n_rows": batch["n_rows"],
                    "intercept": [s[0] for s in solved],
                    "coefficients": [s[1] for s in solved],
                }
            )

    return systems.select(PRODUCT, "n_rows", "sums").mapInPandas(
        solve, f"{PRODUCT} string, n_rows long, intercept double, coefficients array<double>"
    )


def score_per_product(
    df: DataFrame, models: DataFrame, columns: Sequence[str], medians: Mapping[str, float]
) -> DataFrame:
    """Add `prediction` from the product's own model, or from the overall one."""
    overall = models.where(F.col(PRODUCT).isNull())
    own = models.where(F.col(PRODUCT).isNotNull()).select(PRODUCT, "intercept", "coefficients")
    joined = join_same(df, own, [PRODUCT], "left").withColumns(
        {
            "__weights": F.coalesce("coefficients", overall.select("coefficients").scalar()),
            "__level": F.coalesce("intercept", overall.select("intercept").scalar()),
        }
    )
    terms = [
        F.get("__weights", F.lit(i)) * F.coalesce(as_double(df, c), F.lit(medians[c])) for i, c in enumerate(columns)
    ]
    return joined.withColumn("prediction", sum(terms, F.col("__level"))).drop(
        "__weights", "__level", "intercept", "coefficients"
    )


# Search ranges (low, high, logarithmic) of the two families.
SEARCH = {
    "gbt": {
        "rounds": (120, 420, False),
        "rate": (0.01, 0.2, True),
        "depth": (3, 12, False),
        "least": (5, 50, False),
        "rows": (0.6, 1.0, False),
        "columns": (0.6, 1.0, False),
    },
    "gbt_deep": {
        "rounds": (120, 420, False),
        "rate": (0.01, 0.2, True),
        "depth": (3, 10, False),
        "least": (1, 12, False),
        "rows": (0.6, 1.0, False),
        "columns": (0.6, 1.0, False),
    },
}


def sample_params(family: str, n_trials: int, seed: int, ranges: Mapping[str, tuple] | None = None) -> list[dict]:
    """Seeded random parameter sets within the family's ranges."""
    draw = random.Random(f"{seed}-{family}")
    chosen = {**SEARCH[family], **(ranges or {})}
    trials = []
    for _ in range(n_trials):
        params: dict[str, Any] = {}
        for name, (low, high, logarithmic) in chosen.items():
            if isinstance(low, int) and isinstance(high, int):
                params[name] = draw.randint(low, high)
            elif logarithmic:
                params[name] = float(np.exp(draw.uniform(np.log(low), np.log(high))))
            else:
                params[name] = draw.uniform(low, high)
        trials.append(params)
    return trials


def at_a_time(spark: SparkSession, jobs: Sequence[Callable[[], Any]], most: int) -> list[Any]:
    """The jobs' results in their order, up to `most` running at a time; the first error drops those not started."""
    with ThreadPoolExecutor(most) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        try:
            return [s.result() for s in started]
        except BaseException:
            pool.shutdown(cancel_futures=True)
            raise


def tune_models(
    matrix: Matrix,
    metric: str = "wmape",
    n_trials: int = 20,
    seed: int = 42,
    families: Sequence[str] = ("gbt", "gbt_deep"),
    ranges: Mapping[str, tuple] | None = None,
    parallelism: int | None = None,
) -> DataFrame:
    """Fit each trial on train, score it on validation, and mark the best trial per family.

    The matrix is binned once. Up to `parallelism` trials run at a time (default: one per slot), which changes no trial. Columns: model_name, trial_number, state,
    objective_value, params_json, is_best. A score that is no number counts as 1e12; a trial whose parameters are rejected is
    kept with its state and never wins. Any other error ends the search: it tells of the cluster or the data, not of the parameters.
    """
    metric_name(metric)
    if n_trials <= 0:
        raise PanelError("n_trials must be positive")
    prepared = prepare(matrix)
    held_out = matrix.frame.where(F.col("split") == "validation")
    validation = settle(held_out.select(F.col(matrix.target).cast("double").alias("actual"), "features"))
    slots = prepared.rows.sparkSession.sparkContext.defaultParallelism

    def trial(family: str, number: int, params: dict) -> tuple:
        try:
            scored = _fit(prepared, family, params, seed).transform(validation)
            value = metric_value(scored.select("actual", "prediction"), metric)
        except PanelError as error:  # parameters out of their bounds
            return family, number, f"FAIL: {str(error).splitlines()[0][:200]}", None, params
        return family, number, "COMPLETE", 1e12 if value is None or not np.isfinite(value) else value, params

    wanted = [(f, i, p) for f in families for i, p in enumerate(sample_params(f, n_trials, seed, ranges))]
    # The longest ones first, so that none of them is left over for the end.
    work = lambda w: -w[2]["rounds"] * w[2]["depth"]
    order = sorted(range(len(wanted)), key=lambda i: work(wanted[i]))
    done = at_a_time(prepared.rows.sparkSession, [partial(trial, *wanted[i]) for i in order], parallelism or slots)
    trials = [t for _, t in sorted(zip(order, done), key=lambda x: x[0])]
    if all(t[3] is None for t in trials):
        raise PanelError("No trial completed")
    best = {
        family: min((t[3], t[1]) for t in trials if t[0] == family and t[3] is not None)[1]
        for family in families
        if any(t[0] == family and t[3] is not None for t in trials)
    }
    schema = "model_name string, trial_number int, state string, objective_value double, params_json string, is_best boolean"
    rows = [(*t[:4], json.dumps(t[4]), best.get(t[0]) == t[1]) for t in trials]
    return prepared.rows.sparkSession.createDataFrame(rows, schema)


def best_params(trials: DataFrame, family: str) -> dict[str, Any]:
    """The parameters of the family's best trial, as the training functions take them."""
    row = trials.where(F.col("is_best") & (F.col("model_name") == family)).select("params_json").first()
    if row is None:
        raise PanelError(f"No trial of '{family}' completed")
    return json.loads(row["params_json"])


def matrix_of(df: DataFrame, **options: Any) -> Matrix:
    """`model_matrix` with the columns fits and scores need, computed once."""
    matrix = model_matrix(df, **options)
    return replace(matrix, frame=settle(matrix.frame.select(*PANEL_KEY, matrix.target, "split", "features")))
