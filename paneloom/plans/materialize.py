"""Turn a declared plan into feature columns, and merge them into a feature table."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.operators.scaling import join_same
from paneloom.operators.windows import add_lookbacks
from paneloom.plans.specs import Spec, WindowSpecification, numbers
from paneloom.schema import BASE_COLUMNS, DATE, PANEL_KEY, require_columns

_OPERATIONS = {
    "LagSpec": "lag_feature",
    "RollingSpec": "rolling_feature",
    "RatioSpec": "ratio_feature",
    "DifferenceSpec": "difference_feature",
    "InteractionSpec": "interaction_feature",
    "BinaryFlagSpec": "binary_flag_feature",
    "CalendarSpec": "calendar_feature",
}


def materialize_plan(
    df: DataFrame, specs: Sequence[Spec], date_first: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Base columns plus one column per usable spec, and a table of the specs left out with reasons.

    A spec is left out if its name is taken or a source column holds no number; one aggregate counts
    the numbers of all sources. Specs over the same group share one exchange and one sort.
    """
    require_columns(df, BASE_COLUMNS, "Plan source")
    for spec in specs:
        require_columns(df, spec.needs(), f"Source of '{spec.name}'")
    values = numbers(df, specs)
    counts = df.agg(*[F.count(v).alias(c) for c, v in values.items()]).first() if values else {}

    taken, usable, rejected = set(df.columns), [], []
    for spec in specs:
        empty = [c for c in spec.sources() if counts[c] == 0]
        reason = None  # the texts below are fixed
        if spec.name in taken:
            reason = "feature name collision in materialization frame"
        elif empty:
            reason = f"Column '{empty[0]}' has no numeric values for deterministic materialization"
        if reason:
            rejected.append((spec.name, _OPERATIONS[type(spec).__name__], reason))
        else:
            taken.add(spec.name)
            usable.append(spec)

    frame = df.withColumns({f"__{c}": v for c, v in values.items()})
    groups = defaultdict(list)
    for spec in usable:
        if isinstance(spec, WindowSpecification):
            groups[(tuple(k for k in PANEL_KEY if k in spec.group_by), spec.order())].append(spec)
    for (keys, order), members in groups.items():
        if date_first:
            order = (DATE, *[c for c in order if c != DATE])
        frame = add_lookbacks(frame, {s.name: s.lookback(f"__{s.source}") for s in members}, keys, order)
    row_wise = {
        s.name: s.expression(lambda c: F.col(f"__{c}")) for s in usable if not isinstance(s, WindowSpecification)
    }
    if row_wise:
        frame = frame.withColumns(row_wise)
    features = frame.select(*BASE_COLUMNS, *[s.name for s in usable])
    rejects = df.sparkSession.createDataFrame(rejected, "feature_name string, operation string, reason string")
    return features, rejects


def merge_planned_features(
    df: DataFrame,
    planned: DataFrame,
    validated: Sequence[str] | None = None,
    drop_empty: bool = True,
    newest: str | None = None,
) -> DataFrame:
    """Left-join planned columns on date, store and product.

    Only columns `df` lacks are merged, limited to `validated` names if given and, with
    `drop_empty`, to columns holding a value. Of several planned rows with one key the one with the
    greatest `newest` column is kept; without it the order is undefined, so the greatest row is.
    """
    if not set(PANEL_KEY) <= set(planned.columns):
        return df
    wanted = [c for c in planned.columns if c not in df.columns and c != newest]
    if validated is not None:
        wanted = [c for c in wanted if c in set(validated)]
    if drop_empty and wanted:
        counts = planned.agg(*[F.count(c).alias(c) for c in wanted]).first()
        wanted = [c for c in wanted if counts[c]]
    if not wanted:
        return df
    rank = F.struct(newest, *wanted) if newest else F.struct(*wanted)
    one_per_key = planned.groupBy(*PANEL_KEY).agg(F.max_by(F.struct(*wanted), rank).alias("__planned"))
    return join_same(df, one_per_key, PANEL_KEY, "left").select(*df.columns, *[f"__planned.{c}" for c in wanted])
