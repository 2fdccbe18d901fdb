"""Double machine learning of own-price elasticities, one estimate per segment.

Rows never leave Spark: each stage sums cross products per segment (combined before the shuffle,
so a segment of any size becomes one row), a task solves the small systems of its segments, and the
weights are joined back to the rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.functions.scalars import as_double
from paneloom.operators import trees
from paneloom.operators.elasticity import (
    UNSTABLE,
    log_treatment,
    segment_columns,
    segment_guardrails,
    segment_key,
)
from paneloom.operators.quantiles import exact_medians
from paneloom.operators.scaling import join_same, settle, with_position
from paneloom.schema import BASE_COLUMNS, DATE, PANEL_KEY, PRICE, PRODUCT, STORE, UNITS, PanelError, require_columns

# The lean control set, names that are never controls, and name parts that mark
# own-price proxies, store indicators and planned features.
LEAN_CONTROLS = (
    "day_of_week",
    "month",
    "is_weekend",
    "units_sold_lag_7",
    "units_sold_lag_28",
    "inventory_level",
    "discount",
    "competitor_price",
    "promotion",
    "holiday",
)
NEVER_CONTROLS = (
    DATE,
    STORE,
    PRODUCT,
    UNITS,
    PRICE,
    "y_log",
    "t_log",
    "forecast_error_hint",
    "forecast_units",
    "baseline_units",
    "planned_price",
    "reference_price",
    "applied_elasticity",
    "elasticity_estimate",
    "lower_ci",
    "upper_ci",
    "segment_key",
    "fit_status",
    "skip_reason",
)
PROXY_PARTS = ("_lag_", "_roll_", "_momentum", "_delta", "_change", "_ma_", "_ewm")
STORE_INDICATORS = ("store_id_encoded", "store_numeric_id", "store_fe", "store_fixed_effect")
PLANNED_MARK = "llm"

NUISANCES = ("linear", "random-forest", "gradient-boosting")
# Size of the tree models of a segment.
FOREST = {"trees": 200, "depth": 6, "least": 5}
BOOSTING = {"rounds": 100, "rate": 0.1, "depth": 3}
HELD_ROWS = 1_000_000  # rows of a segment whose trees one task grows; larger segments are grown over all tasks


@dataclass(frozen=True)
class ElasticityConfig:
    level: str = "product"
    profile: str = "lean"
    min_samples: int = 250
    min_pairs: int | None = None
    min_unique_prices: int = 8
    min_price_std: float = 0.01
    min_units_std: float = 0.01
    min_variance: float = 1e-8
    epsilon: float = 1e-3
    alpha: float = 0.05
    include_planned: bool = False
    allow_demand_forecast: bool = False
    include_store_indicators: bool = True
    nuisance: str = "random-forest"
    seed: int = 42


def select_controls(
    df: DataFrame,
    profile: str = "lean",
    treatment: str = PRICE,
    include_store_indicators: bool = True,
    include_planned: bool = False,
    allow_demand_forecast: bool = False,
    extra_excluded: Sequence[str] = (),
) -> list[str]:
    """Numeric or boolean control columns by name and type, in column order."""
    kind = profile.strip().lower()
    if kind not in ("lean", "full"):
        raise PanelError(f"Unsupported feature profile '{profile}'. Allowed values: full, lean")
    price = treatment.strip().lower()
    planned = rf"(^|_){PLANNED_MARK}_|_{PLANNED_MARK}$"
    proxies = rf"(?=.*{re.escape(price)}).*({'|'.join(map(re.escape, PROXY_PARTS))})" if price else r"(?!)"
    # A name that one of these patterns finds is barred, unless the caller allows that kind.
    barred = [r"^target_|future", proxies, *([] if include_planned else [planned]), *([] if allow_demand_forecast else ["^demand_forecast$"])]
    bar = re.compile("|".join(f"(?:{p})" for p in barred))
    store = re.compile("|".join([*(f"^{re.escape(n)}$" for n in STORE_INDICATORS), "^store_indicator_"]))
    never = {*NEVER_CONTROLS, *extra_excluded}

    usable = {f.name: f.name.strip().lower() for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))}
    allowed = [name for name, low in usable.items() if name not in never and not bar.search(low)]
    if kind == "full":
        return allowed
    return [n for n in allowed if n in LEAN_CONTROLS or (include_store_indicators and store.search(usable[n]))]


def segment_controls(
    df: DataFrame,
    keys: Sequence[str],
    controls: Sequence[str],
    scaled: bool = False,
) -> DataFrame:
    """Fill each control with its segment median; add `controls_used`.

    A control with fewer than two values or no variance in the segment is unused and becomes 0.
    With `scaled`, used controls are centred on the median and divided by their deviation.
    """
    keys, controls = list(keys), list(controls)
    typed = df.withColumns({c: as_double(df, c) for c in controls}) if controls else df
    if not controls:
        return typed.withColumn("controls_used", F.lit(0).cast("long"))
    spread = typed.groupBy(*keys).agg(
        *[F.count(c).alias(f"__n_{c}") for c in controls], *[F.var_pop(c).alias(f"__v_{c}") for c in controls]
    )
    middles = exact_medians(typed, controls, keys).withColumnsRenamed({c: f"__m_{c}" for c in controls})
    joined = join_same(typed, join_same(spread, middles, keys), keys)
    used = {c: (F.col(f"__n_{c}") >= 2) & (F.col(f"__v_{c}") > 0) for c in controls}
    filled = {c: F.coalesce(F.col(c), F.col(f"__m_{c}")) for c in controls}
    if scaled:
        filled = {c: (v - F.col(f"__m_{c}")) / F.sqrt(f"__v_{c}") for c, v in filled.items()}
    helpers = [f"__{part}_{c}" for part in "nvm" for c in controls]
    count = sum((F.when(u, 1).otherwise(0) for u in used.values()), F.lit(0))
    return (
        joined.withColumn("controls_used", count.cast("long"))
        .withColumns({c: F.when(used[c], filled[c]).otherwise(0.0) for c in controls})
        .drop(*helpers)
    )


def _upper(columns: Sequence[Column]) -> list[Column]:
    return [a * b for i, a in enumerate(columns) for b in columns[i:]]


def _sums(columns: Sequence[Column]) -> Column:
    return F.array(*[F.sum(c) for c in columns])


def _dot(weights: str, columns: Sequence[Column]) -> Column:
    return sum((F.get(weights, F.lit(i)) * c for i, c in enumerate(columns)), F.lit(0.0))


def _square(values: Sequence[float], size: int) -> np.ndarray:
    matrix = np.zeros((size, size))
    matrix[np.triu_indices(size)] = values
    return matrix + np.triu(matrix, 1).T


def _inverse(matrix: np.ndarray) -> tuple[np.ndarray, int]:
    """Pseudo-inverse and rank of a Gram matrix after scaling it to a unit diagonal."""
    diagonal = np.sqrt(np.diag(matrix))
    scale = np.divide(1.0, diagonal, out=np.zeros_like(diagonal), where=diagonal > 0)
    unit = matrix * np.outer(scale, scale)
    inverse = np.linalg.pinv(unit, rcond=1e-12, hermitian=True)
    rank = int(np.linalg.matrix_rank(unit, tol=1e-10, hermitian=True))
    return inverse * np.outer(scale, scale), rank


def _per_row(df: DataFrame, keys: list[str], solve: Callable, outputs: str) -> DataFrame:
    """One Python call per row of small arrays; key columns are passed through."""
    schema = T.StructType([df.schema[k] for k in keys] + T.StructType.fromDDL(outputs).fields)
    names = schema.fieldNames()

    def run(batches):
        for batch in batches:
            found = [
                (*[row[k] for k in keys], *result) for row in batch.to_dict("records") for result in solve(row)
            ]
            yield pd.DataFrame(found, columns=names)

    return df.mapInPandas(run, schema)


def _linear_weights(rows: DataFrame, keys: list[str], design: list[Column]) -> DataFrame:
    """Outcome and treatment weights for each fold, fitted on the other fold."""
    size = len(design)
    parts = {
        "gram": _upper(design),
        "on_y": [c * F.col("y_log") for c in design],
        "on_t": [c * F.col("t_log") for c in design],
    }
    per_fold = rows.groupBy(*keys, "fold").agg(*[_sums(v).alias(k) for k, v in parts.items()])
    pick = lambda name, fold: F.max(F.when(F.col("fold") == fold, F.col(name))).alias(f"{name}_{fold}")
    both = per_fold.groupBy(*keys).agg(*[pick(name, fold) for name in parts for fold in (0, 1)])

    def solve(row):
        for fold in (0, 1):
            other = 1 - fold
            if row[f"gram_{other}"] is None:
                continue
            inverse, _ = _inverse(_square(row[f"gram_{other}"], size))
            yield fold, (inverse @ row[f"on_y_{other}"]).tolist(), (inverse @ row[f"on_t_{other}"]).tolist()

    return _per_row(both, keys, solve, "fold int, y_weights array<double>, t_weights array<double>")


def cross_fit_residuals(
    df: DataFrame,
    keys: Sequence[str],
    controls: Sequence[str],
    nuisance: str = "random-forest",
    order: Sequence[str] = (DATE,),
    tiebreak: Sequence[str] = (STORE, PRODUCT),
    seed: int = 42,
    params: dict | None = None,
    held_rows: int = HELD_ROWS,
) -> DataFrame:
    """Add `fold`, `y_res` and `t_res`: y_log and t_log minus what the other fold predicts.

    The folds are the first and second half of the segment's rows in time. Every segment has models of its own: least squares
    (`linear`), or trees, with `params` in place of the values of FOREST or BOOSTING. Rows enter a tree by a hash of the panel
    key, and sums are exact, so residuals don't depend on partitions, nor on whether a segment has over `held_rows` rows and is
    grown by all tasks. A segment whose other fold is empty has no residuals. Controls must be complete (`segment_controls`).
    """
    if nuisance not in NUISANCES:
        raise PanelError(f"Unsupported nuisance model. Allowed values: {', '.join(NUISANCES)}")
    keys, controls = list(keys), list(controls)
    placed = with_position(df, keys, order, tiebreak, "__position", "__rows")
    half = F.ceil(F.col("__rows") / 2)
    rows = placed.withColumn("fold", F.when(F.col("__position") < half, 0).otherwise(1)).drop("__position", "__rows")
    rows = settle(rows)
    if nuisance == "linear":
        design = [F.lit(1.0), *[F.col(c) for c in controls]]
        joined = join_same(rows, _linear_weights(rows, keys, design), [*keys, "fold"], "left")
        return joined.withColumns(
            {
                "y_res": F.col("y_log") - _dot("y_weights", design),
                "t_res": F.col("t_log") - _dot("t_weights", design),
            }
        ).drop("y_weights", "t_weights")
    return _tree_residuals(rows, keys, controls, nuisance, seed, params or {}, held_rows)


TARGETS = {"y_log": "y_res", "t_log": "t_res"}


def _tree_residuals(
    rows: DataFrame, keys: list[str], controls: list[str], nuisance: str, seed: int, params: dict, held_rows: int
) -> DataFrame:
    """Residuals of trees per segment, fold and target."""
    if nuisance == "random-forest":
        chosen: trees.Forest | trees.Boosting = trees.Forest(**{**FOREST, **params}, seed=seed)
    else:
        chosen = trees.Boosting(**{**BOOSTING, **params}, seed=seed)
    keyed = rows.withColumns({"__key": F.xxhash64(*PANEL_KEY), "__values": F.array(*[F.col(c).cast("double") for c in controls])})
    schema = T.StructType([*rows.schema.fields, *(T.StructField(n, T.DoubleType()) for n in TARGETS.values())])
    # At most one segment in `held_rows` rows.
    large = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > held_rows).select(*keys).collect()
    small = keyed
    for one in large:
        small = small.where(~_same(keys, one))
    found = small.groupBy(*keys).applyInArrow(_segment_residuals(chosen, rows.columns), schema)
    for one in large:
        found = found.unionByName(_spread_residuals(keyed.where(_same(keys, one)), chosen, len(controls)).select(*schema.fieldNames()))
    return found


def _same(keys: list[str], row) -> Column:
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.lit(row[k])) for k in keys])


def _segment_residuals(chosen: trees.Forest | trees.Boosting, columns: list[str]):
    """Adds the residuals to the rows of one segment."""

    def run(table: pa.Table) -> pa.Table:
        values = trees.column_values(table.column("__values").combine_chunks())
        keys, fold = table.column("__key").to_numpy(), table.column("fold").to_numpy()
        out = {}
        for target, name in TARGETS.items():
            y = table.column(target).to_numpy(zero_copy_only=False).astype(np.float64)
            out[name] = np.full(len(y), np.nan)
            for half in (0, 1):
                own = (fold != half) & ~np.isnan(y)
                if not own.any():
                    continue
                edges = trees.edges_of(values[own & trees.edge_rows(keys, int(own.sum()))])
                codes = trees.codes_of(values, edges)
                if isinstance(chosen, trees.Forest):
                    fit = trees.held_forest(codes[own], y[own], keys[own], chosen, edges)
                else:
                    fit = trees.Fit(edges, chosen.rate)
                    trees.boost(codes[own], y[own], keys[own], chosen, fit, 0, chosen.rounds)
                scored = fold == half
                out[name][scored] = y[scored] - fit.predict(codes[scored])
        found = table.select(columns)
        for name, residual in out.items():
            found = found.append_column(name, pa.array(residual, from_pandas=True))
        return found

    return run


def _spread_residuals(rows: DataFrame, chosen: trees.Forest | trees.Boosting, n_controls: int) -> DataFrame:
    """The same for one segment of many rows, whose trees are grown by jobs over all of them."""
    rows = settle(rows)
    halves = []
    for half in (0, 1):
        scored = rows.where(F.col("fold") == half)
        for target, name in TARGETS.items():
            own = rows.where((F.col("fold") != half) & F.col(target).isNotNull())
            train = own.select(F.col("__key").alias("key"), F.col(target).cast("double").alias("y"), F.col("__values").alias("values"))
            total = train.count()
            if not total:
                scored = scored.withColumn(name, F.lit(None).cast("double"))
                continue
            edges = trees.bin_edges(train, "values", "key", total)
            table = settle(trees.binned(train, "values", edges, ["key", "y"]))
            if isinstance(chosen, trees.Forest):
                fit = trees.spread_forest(table, total, chosen, edges)
            else:
                fit = trees.boosted(table, chosen, edges, total, 0, 100)
            scored = scored.withColumn(name, F.col(target) - trees.prediction(fit, F.col("__values")))
        halves.append(scored)
    return halves[0].unionByName(halves[1]).drop("__key", "__values")


def dml_elasticity(
    residuals: DataFrame, keys: Sequence[str], controls: Sequence[str], alpha: float = 0.05
) -> DataFrame:
    """Mean elasticity per segment from y_res on t_res x [1, controls], with averaged bounds.

    The effect of a row is linear in its controls. The estimate is the mean effect, and the bounds
    are the means of the rows' own bounds under a robust (HC1) covariance, which is wider than an
    interval for the mean. A rank-deficient or over-parameterised fit is reported as a warning.
    """
    if not 0 < alpha < 1:
        raise PanelError("alpha must be between 0 and 1")
    keys = list(keys)
    effect = [F.lit(1.0), *[F.col(c) for c in controls]]
    phi = [F.col("t_res") * c for c in effect]
    size = len(effect)
    rows = residuals.where(F.col("t_res").isNotNull() & F.col("y_res").isNotNull())

    systems = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        _sums(_upper(phi)).alias("gram"),
        _sums([c * F.col("y_res") for c in phi]).alias("right"),
        F.array(*[F.avg(c) for c in effect]).alias("mean_effect"),
        F.array(*[F.max(F.abs(c)) for c in effect]).alias("magnitude"),
    )

    def fit(row):
        inverse, rank = _inverse(_square(row["gram"], size))
        beta = inverse @ row["right"]
        used = int(np.count_nonzero(np.asarray(row["magnitude"]) > 0))
        yield (
            int(row["n_rows"]),
            beta.tolist(),
            inverse[np.triu_indices(size)].tolist(),
            float(beta @ row["mean_effect"]),
            rank,
            used,
        )

    fits = settle(
        _per_row(
            systems,
            keys,
            fit,
            "n_rows long, beta array<double>, inverse array<double>, estimate double, rank int, parameters int",
        )
    )

    error = F.col("y_res") - _dot("beta", phi)
    meats = join_same(rows, fits.select(*keys, "beta"), keys).groupBy(*keys).agg(
        _sums([error * error * c for c in _upper(phi)]).alias("meat")
    )

    def spread(row):
        inverse, meat = _square(row["inverse"], size), _square(row["meat"], size)
        n, p = row["n_rows"], row["parameters"]
        covariance = inverse @ meat @ inverse * (n / (n - p) if n > p else 1.0)
        yield (covariance[np.triu_indices(size)].tolist(),)

    covariances = _per_row(
        join_same(fits.select(*keys, "inverse", "n_rows", "parameters"), meats, keys),
        keys,
        spread,
        "covariance array<double>",
    )
    twice = [
        (1.0 if i == j else 2.0) * effect[i] * effect[j] for i in range(size) for j in range(i, size)
    ]
    variance = F.greatest(_dot("covariance", twice), F.lit(0.0))
    errors = join_same(rows, covariances, keys).groupBy(*keys).agg(F.avg(F.sqrt(variance)).alias("mean_error"))

    z = NormalDist().inv_cdf(1 - alpha / 2)
    unstable = (F.col("rank") < F.col("parameters")) | (F.col("n_rows") <= F.col("parameters"))
    return join_same(fits, errors, keys).select(
        *keys,
        "n_rows",
        F.col("estimate").alias("elasticity_estimate"),
        (F.col("estimate") - z * F.col("mean_error")).alias("lower_ci"),
        (F.col("estimate") + z * F.col("mean_error")).alias("upper_ci"),
        "parameters",
        "rank",
        unstable.cast("long").alias("inference_warning_count"),
        F.when(unstable, "Covariance matrix is singular or underdetermined; inference is unreliable.")
        .otherwise("")
        .alias("warnings_text"),
    )


def elasticity_estimates(
    df: DataFrame, config: ElasticityConfig | None = None
) -> DataFrame:
    """Guardrails, fit and quality of every segment; a segment that cannot be fitted stays in."""
    config = config or ElasticityConfig()
    if config.nuisance not in NUISANCES:
        raise PanelError(f"Unsupported nuisance model. Allowed values: {', '.join(NUISANCES)}")
    require_columns(df, BASE_COLUMNS, "Elasticity input")
    segment_columns(config.level)
    controls = select_controls(
        df,
        config.profile,
        include_store_indicators=config.include_store_indicators,
        include_planned=config.include_planned,
        allow_demand_forecast=config.allow_demand_forecast,
    )
    keys = ["segment_key"]
    logged = segment_key(log_treatment(df, config.epsilon), config.level)
    rows = settle(logged.select(*keys, DATE, STORE, PRODUCT, "y_log", "t_log", *controls))
    guards = segment_guardrails(
        rows,
        keys,
        config.min_samples,
        config.min_pairs,
        config.min_unique_prices,
        config.min_price_std,
        config.min_units_std,
        config.min_variance,
    )
    guards = settle(guards)
    incomplete = F.col("non_null_pair_count") < F.col("sample_size")
    usable = guards.where(F.col("is_valid") & ~incomplete).select(*keys)
    prepared = settle(
        segment_controls(rows.join(usable, keys, "left_semi"), keys, controls, scaled=True)
    )
    used = prepared.groupBy(*keys).agg(F.max("controls_used").alias("controls_used"))
    residuals = settle(
        cross_fit_residuals(
            prepared.where(F.col("controls_used") > 0), keys, controls, config.nuisance, seed=config.seed
        )
    )
    fits = dml_elasticity(residuals, keys, controls, config.alpha).drop("n_rows", "rank", "parameters")
    joined = join_same(join_same(guards, used, keys, "left"), fits, keys, "left")
    fitted = F.col("elasticity_estimate").isNotNull() & ~F.isnan("elasticity_estimate")
    reason = (
        F.when(~F.col("is_valid"), F.col("reason"))
        .when(incomplete, "fit_failed: missing outcome or treatment values")
        .when(F.coalesce("controls_used", F.lit(0)) == 0, "no_usable_controls_after_segment_filtering")
        .when(~fitted, "fit_failed: no finite estimate")
        .otherwise("")
    )
    status = F.when(reason == "", "success").when(reason.startswith("fit_failed"), "failed").otherwise("skipped")
    warnings = F.coalesce("inference_warning_count", F.lit(0)).cast("long")
    quality = F.when(status != "success", status).when(
        (warnings > 0) | F.col("lower_ci").isNull() | F.col("upper_ci").isNull(), UNSTABLE
    ).otherwise("ok")
    return joined.select(
        F.lit(config.level).alias("segmentation_level"),
        F.lit(config.profile).alias("feature_profile_used"),
        "segment_key",
        "sample_size",
        "non_null_pair_count",
        "unique_price_values",
        "log_price_std",
        "log_units_std",
        "treatment_variance",
        "outcome_variance",
        F.when(fitted, F.col("elasticity_estimate")).alias("elasticity_estimate"),
        F.when(fitted, F.col("lower_ci")).alias("lower_ci"),
        F.when(fitted, F.col("upper_ci")).alias("upper_ci"),
        status.alias("fit_status"),
        quality.alias("quality_status"),
        (quality == UNSTABLE).alias("ci_caution_flag"),
        reason.alias("skip_reason"),
        F.when(status == "success", F.col("controls_used")).otherwise(0).cast("long").alias("feature_count_used"),
        warnings.alias("warning_count"),
        warnings.alias("inference_warning_count"),
        F.coalesce("warnings_text", F.lit("")).alias("warnings_text"),
    )
