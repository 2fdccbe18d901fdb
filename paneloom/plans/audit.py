"""Check a table of proposed feature specs and say why each is accepted or not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.operators.scaling import join_same, settle
from paneloom.plans.specs import (
    AGGREGATIONS,
    COMPARATORS,
    MAX_REACH,
    NAME_PATTERN,
    PRECONDITION_COLUMNS,
    RESERVED_NAMES,
    ROW_COLUMNS,
    WINDOW_COLUMNS,
)
from paneloom.schema import CALENDAR_FEATURES, DATE, SERIES

_COMMON = ("operation", "feature_name", "required_columns", "description", "rationale")
_FIELDS = {
    "lag_feature": ("source_column", "lag", "group_by"),
    "rolling_feature": ("source_column", "window", "aggregation", "shift", "group_by"),
    "ratio_feature": ("numerator_column", "denominator_column"),
    "difference_feature": ("minuend_column", "subtrahend_column"),
    "interaction_feature": ("left_column", "right_column", "interaction_method"),
    "binary_flag_feature": ("source_column", "comparator", "threshold", "true_value", "false_value"),
    "calendar_feature": ("calendar_component", "interact_with_column"),
}
_LISTS = ("required_columns", "group_by")
_PAIRS = {
    "ratio_feature": ("numerator_column", "denominator_column"),
    "difference_feature": ("minuend_column", "subtrahend_column"),
    "interaction_feature": ("left_column", "right_column"),
}
_SCHEMA = T.StructType(
    [
        T.StructField(name, T.ArrayType(T.StringType()) if name in _LISTS else T.StringType())
        for name in dict.fromkeys((*_COMMON, *[f for fs in _FIELDS.values() for f in fs]))
    ]
)


def plan_specs(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Rows `index, spec` of each JSON plan, whose list is under `specs` or else `features`."""
    items = "array<string>"
    listed = F.from_json(column, f"specs {items}, features {items}")
    return payloads.withColumn("__plan", listed).select(
        *[c for c in payloads.columns if c != column],
        F.posexplode(F.coalesce("__plan.specs", "__plan.features")).alias("index", "spec"),
    ).withColumn("index", F.col("index") + 1)


def _whole(column: Column) -> Column:
    number = column.try_cast("double")
    return F.when(number == F.floor(number), number)


def _outside(column: Column, low: int, high: int) -> Column:
    return ~F.coalesce(_whole(column).between(low, high), F.lit(False))


def _not_in(column: Column, allowed: Sequence[str]) -> Column:
    return ~F.coalesce(column.isin(*allowed), F.lit(False))


def _foreign(items: Column, allowed: Sequence[str]) -> Column:
    return F.coalesce(F.size(F.array_except(items, F.array(*[F.lit(a) for a in allowed]))) > 0, F.lit(False))


def _schema_error(keys: Column) -> Column:
    """First broken rule of the spec's own form, or NULL."""
    s = lambda name: F.col(f"__s_{name}")
    is_op = lambda *names: s("operation").isin(*names)
    name = F.lower(F.btrim(s("feature_name")))
    extra = F.lit(False)
    for operation, own in _FIELDS.items():
        extra |= is_op(operation) & _foreign(keys, (*_COMMON, *own))
    windowed = is_op("lag_feature", "rolling_feature")
    rules: list[tuple[Column, str, str]] = [
        (_not_in(s("operation"), tuple(_FIELDS)), "operation", "unknown operation"),
        (~F.coalesce(name.rlike(NAME_PATTERN), F.lit(False)), "feature_name", f"must match {NAME_PATTERN}"),
        (name.isin(*RESERVED_NAMES), "feature_name", "name is reserved"),
        (_foreign(F.transform(s("required_columns"), F.btrim), PRECONDITION_COLUMNS), "required_columns", "unsupported column"),
        (windowed & _not_in(s("source_column"), WINDOW_COLUMNS), "source_column", "unsupported column"),
        (is_op("binary_flag_feature") & _not_in(s("source_column"), ROW_COLUMNS), "source_column", "unsupported column"),
        (is_op("lag_feature") & _outside(s("lag"), 1, MAX_REACH), "lag", "must be a whole number from 1 to 365"),
        (is_op("rolling_feature") & _outside(s("window"), 2, MAX_REACH), "window", "must be a whole number from 2 to 365"),
        (is_op("rolling_feature") & _not_in(s("aggregation"), AGGREGATIONS), "aggregation", "unsupported aggregation"),
        (is_op("rolling_feature") & _outside(s("shift"), 1, MAX_REACH), "shift", "must be a whole number from 1 to 365"),
        (
            windowed & (_foreign(s("group_by"), SERIES) | F.coalesce(F.size(s("group_by")) == 0, F.lit(False))),
            "group_by",
            "must be series keys",
        ),
    ]
    for operation, pair in _PAIRS.items():
        rules += [(is_op(operation) & _not_in(s(c), ROW_COLUMNS), c, "unsupported column") for c in pair]
        rules.append((is_op(operation) & (s(pair[0]) == s(pair[1])), pair[1], "the two columns must differ"))
    method = F.coalesce(s("interaction_method"), F.lit("multiply"))
    flag_true = F.coalesce(s("true_value").try_cast("double"), F.lit(1.0))
    flag_false = F.coalesce(s("false_value").try_cast("double"), F.lit(0.0))
    rules += [
        (is_op("interaction_feature") & (method != "multiply"), "interaction_method", "must be multiply"),
        (is_op("binary_flag_feature") & _not_in(s("comparator"), COMPARATORS), "comparator", "unsupported comparator"),
        (is_op("binary_flag_feature") & s("threshold").try_cast("double").isNull(), "threshold", "must be a number"),
        (is_op("binary_flag_feature") & (flag_true == flag_false), "true_value", "true_value and false_value must differ"),
        (is_op("calendar_feature") & _not_in(s("calendar_component"), CALENDAR_FEATURES), "calendar_component", "unsupported component"),
        (
            is_op("calendar_feature")
            & s("interact_with_column").isNotNull()
            & _not_in(s("interact_with_column"), ROW_COLUMNS),
            "interact_with_column",
            "unsupported column",
        ),
        (extra, "keys", "unexpected key"),
    ]
    return F.coalesce(
        *[
            F.when(F.coalesce(broken, F.lit(False)), F.lit(f"Schema validation failed at '{field}': {text}"))
            for broken, field, text in rules
        ]
    )


def _needed_columns() -> Column:
    """All columns a spec reads, once each."""
    s = lambda name: F.col(f"__s_{name}")
    series = F.array(*[F.lit(k) for k in SERIES])
    windowed = s("operation").isin("lag_feature", "rolling_feature")
    sources = F.array(*[s(c) for c in ("source_column", *[c for p in _PAIRS.values() for c in p], "interact_with_column")])
    extra = F.when(windowed, F.concat(F.coalesce(s("group_by"), series), F.array(F.lit(DATE))))
    extra = extra.when(s("operation") == "calendar_feature", F.array(F.lit(DATE))).otherwise(F.array().cast("array<string>"))
    listed = F.coalesce(F.transform(s("required_columns"), F.btrim), F.array().cast("array<string>"))
    return F.array_distinct(F.filter(F.concat(listed, sources, extra), lambda c: c.isNotNull()))


def audit_plan(
    specs: DataFrame,
    available: Sequence[str],
    existing: Sequence[str],
    blocked: Sequence[str] = (),
) -> DataFrame:
    """`index, feature_name, operation, accepted, reason` for each row `index, spec` (JSON text).

    A name belongs to the first spec that passes every other check. Finding it is a grouped minimum
    joined back, so many specs with one name are combined before they meet.
    """
    text = F.btrim("spec")
    is_object = F.coalesce(text.startswith("{") & F.json_object_keys(text).isNotNull(), F.lit(False))
    # A generator parses each text once; as a plain column the parse would be repeated per field.
    fields = F.inline_outer(F.array(F.from_json(text, _SCHEMA)))
    parsed = specs.select(
        "index",
        is_object.alias("__object"),
        F.json_object_keys(text).alias("__keys"),
        fields.alias(*[f"__s_{f.name}" for f in _SCHEMA.fields]),
    )
    is_object = F.col("__object")
    given = F.lower(F.btrim("__s_feature_name"))
    named = F.when(given != "", given).otherwise(F.concat(F.lit("spec_"), F.col("index").cast("string")))
    names = lambda values: F.array(*[F.lit(str(v).lower()) for v in values]).cast("array<string>")
    missing = F.array_except(_needed_columns(), F.array(*[F.lit(c) for c in available]).cast("array<string>"))
    checked = parsed.select(
        "index",
        F.coalesce(named, F.concat(F.lit("spec_"), F.col("index").cast("string"))).alias("feature_name"),
        F.when(is_object, F.coalesce("__s_operation", F.lit("None"))).otherwise(F.lit("unknown")).alias("operation"),
        F.when(~is_object, F.lit("Spec item is not a JSON object"))
        .otherwise(_schema_error(F.col("__keys")))
        .alias("form_error"),
        F.array_join(F.array_sort(missing), ", ").alias("missing"),
    ).withColumns(
        {
            "blocked": F.array_contains(names(blocked), F.col("feature_name")),
            "exists": F.array_contains(names(existing), F.col("feature_name")),
        }
    )
    checked = settle(checked)  # read twice below, and the parse is the costly part
    passes = F.col("form_error").isNull() & ~F.col("blocked") & ~F.col("exists") & (F.col("missing") == "")
    owners = checked.where(passes).groupBy("feature_name").agg(F.min("index").alias("owner"))
    later = F.col("exists") | F.coalesce(F.col("index") > F.col("owner"), F.lit(False))
    # Fixed texts.
    reason = (
        F.when(F.col("form_error").isNotNull(), F.col("form_error"))
        .when(F.col("blocked"), "Feature name overlaps with the manual feature namespace")
        .when(later, "Feature name duplicates an existing column or previously accepted feature")
        .when(F.col("missing") != "", F.concat(F.lit("Missing required columns in source data: "), F.col("missing")))
    )
    return (
        join_same(checked, owners, ["feature_name"], "left")
        .withColumn("reason", reason)
        .select("index", "feature_name", "operation", F.col("reason").isNull().alias("accepted"), "reason")
    )
