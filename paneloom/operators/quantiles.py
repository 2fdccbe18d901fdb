"""Exact quantiles that never gather a large group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.operators.scaling import join_same, settle

# Rows of one group that the last step may sort in one task; fewer only means more narrowing passes.
ROWS_PER_TASK = 1_000_000
_PIVOTS = 256
_ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame,
    targets: Mapping[str, tuple[str, float]],
    keys: Sequence[str] = (),
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """Interpolated quantiles {output: (column, q)}, one row per key; NULL where a column has no values.

    A quantile lies between the values of two ranks. One aggregate takes a sketch of every column, one
    counts the rows below and up to two of its values around each rank, and only values between these are made rows of
    their own. While more than `limit` rows are left around a rank, they are cut again by two values of a new sketch. Exact
    counts tell in which part a rank is, so a sketch can only cost a pass, never change a result. A
    pivot itself may be the value, however many copies it has.
    """
    own_names = {f"__key_{i}": k for i, k in enumerate(keys)}
    columns = sorted({column for column, _ in targets.values()})
    source = df.select(*[F.col(k).alias(name) for name, k in own_names.items()], *[F.col(c).cast("double").alias(c) for c in columns])
    keys = list(own_names)
    group, rank_key = [*keys, "column"], [*keys, "column", "rank"]

    state = settle(_first_cut(source, targets, keys))
    wide = F.col("found").isNull() & (F.col("inside") > limit)
    while not state.where(wide).isEmpty():
        state = settle(_narrow(_cells(source, state.where(wide), columns, keys), state, rank_key, wide))

    left = state.where(F.col("found").isNull())
    copies = _inside(_cells(source, left, columns, keys), left, group)
    copies = copies.groupBy(*rank_key, "n", "below", "value").agg(F.count(F.lit(1)).alias("copies"))
    upto = Window.partitionBy(*rank_key).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    reached = copies.withColumn("end", F.col("below") + F.sum("copies").over(upto)).where(F.col("end") > F.col("rank"))
    last_step = reached.groupBy(*rank_key, "n").agg(F.min("value").alias("found"))
    ranked = state.where(F.col("found").isNotNull()).select(*rank_key, "n", "found").unionByName(last_step)

    picked = []
    for name, (column, q) in targets.items():
        own, place = F.col("column") == column, F.lit(float(q)) * (F.col("n") - 1)
        lower = F.max(F.when(own & (F.col("rank") == F.floor(place)), F.col("found")))
        upper = F.max(F.when(own & (F.col("rank") == F.ceil(place)), F.col("found")))
        share = F.max(F.when(own, place - F.floor(place)))
        picked.append((lower + share * (upper - lower)).alias(name))
    if not keys:
        return ranked.agg(*picked)
    # A key whose values are all NULL has no quantile but must stay.
    found = join_same(source.select(*keys).distinct(), ranked.groupBy(*keys).agg(*picked), keys, "left")
    return found.withColumnsRenamed(own_names)


def exact_medians(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), limit: int = ROWS_PER_TASK
) -> DataFrame:
    """Median of each column, one row per key; columns keep their names."""
    return exact_quantiles(df, {c: (c, 0.5) for c in columns}, keys, limit)


def _first_cut(source: DataFrame, targets: Mapping[str, tuple[str, float]], keys: list[str]) -> DataFrame:
    """One row per (keys, column, rank): an open interval of values that holds the rank, and the rows below and inside it.

    Groups of few values get no bounds: all of theirs are inside.
    """
    margin = 3.0 / _ACCURACY
    wanted = sorted(set(targets.values()))
    shares = {c: sorted({min(1.0, max(0.0, q + d)) for o, q in wanted if o == c for d in (-margin, margin)}) for c, _ in wanted}
    sketch = settle(
        source.groupBy(*keys).agg(
            *[F.count(c).alias(f"n_{c}") for c in shares],
            *[F.percentile_approx(c, own, _ACCURACY).alias(f"s_{c}") for c, own in shares.items()],
        )
    )
    pivots = {}
    for i, (c, q) in enumerate(wanted):
        for side, share in (("low", max(0.0, q - margin)), ("high", min(1.0, q + margin))):
            pivots[f"{side}_{i}"] = F.when(F.col(f"n_{c}") >= _ACCURACY, F.get(f"s_{c}", F.lit(shares[c].index(share))))
    bounds = sketch.select(*keys, *[f"n_{c}" for c in shares], *[value.alias(name) for name, value in pivots.items()])

    def beside(rows: DataFrame, table: DataFrame) -> DataFrame:
        """The columns of `table` beside the rows of the same keys; without keys it has one row."""
        if keys:
            return join_same(rows, table, keys)
        one = table.first()
        return rows.withColumns({f.name: F.lit(one[f.name]).cast(f.dataType) for f in table.schema.fields})

    tests = {"under": ("low", "<"), "upto_low": ("low", "<="), "before_high": ("high", "<"), "upto_high": ("high", "<=")}
    counted = beside(source, bounds.select(*keys, *pivots)).groupBy(*keys).agg(
        *[F.count_if(F.expr(f"`{c}` {sign} {side}_{i}")).alias(f"{name}_{i}") for i, (c, _) in enumerate(wanted) for name, (side, sign) in tests.items()]
    )
    cells = []
    for i, (c, q) in enumerate(wanted):
        n = F.col(f"n_{c}")
        place = F.lit(float(q)) * (n - 1)
        cells.append(
            F.struct(
                F.lit(c).alias("column"), n.alias("n"), F.array_distinct(F.array(F.floor(place), F.ceil(place))).alias("ranks"),
                F.col(f"low_{i}").alias("low"), F.col(f"high_{i}").alias("high"), *[F.col(f"{name}_{i}").alias(name) for name in tests],
            )
        )
    long = beside(counted, bounds).select(*keys, F.explode(F.array(*cells)).alias("cell")).select(*keys, "cell.*").where("n > 0")
    unknown = F.lit(None).cast("double")
    parts = long.withColumn("rank", F.explode("ranks")).drop("ranks").withColumns(
        {"lo": unknown, "hi": unknown, "below": F.lit(0).cast("long"), "inside": F.col("n")}
    )
    return _placed(parts, [*keys, "column", "rank"]).dropDuplicates([*keys, "column", "rank"])


def _cells(source: DataFrame, state: DataFrame, columns: Sequence[str], keys: list[str]) -> DataFrame:
    """(keys, column, value) of the values between the lowest and the highest bound of each column's open ranks."""
    low, high = F.coalesce("lo", F.lit(float("-inf"))), F.coalesce("hi", F.lit(float("inf")))
    hulls = state.groupBy(*keys).agg(
        *[F.min(F.when(F.col("column") == c, low)).alias(f"__low_{i}") for i, c in enumerate(columns)],
        *[F.max(F.when(F.col("column") == c, high)).alias(f"__high_{i}") for i, c in enumerate(columns)],
    )
    if keys:
        joined = join_same(source, settle(hulls), keys)
    else:
        one = hulls.first()
        joined = source.withColumns({f.name: F.lit(one[f.name]).cast("double") for f in hulls.schema.fields})
    held = [
        F.when(F.col(c).between(F.col(f"__low_{i}"), F.col(f"__high_{i}")), F.struct(F.lit(c).alias("column"), F.col(c).alias("value")))
        for i, c in enumerate(columns)
    ]
    return joined.select(*keys, F.explode(F.array_compact(F.array(*held))).alias("cell")).select(*keys, "cell.column", "cell.value")


def _inside(values: DataFrame, state: DataFrame, group: list[str]) -> DataFrame:
    """The values in each rank's open interval."""
    value, lo, hi = F.col("value"), F.col("lo"), F.col("hi")
    joined = join_same(values, state, group)
    return joined.where((lo.isNull() | (value > lo)) & (hi.isNull() | (value < hi)))


def _narrow(values: DataFrame, state: DataFrame, rank_key: list[str], wide: Column) -> DataFrame:
    """Cut the wide intervals by one sketch pass and one counting pass."""
    group = rank_key[:-1]
    shares = [i / _PIVOTS for i in range(_PIVOTS + 1)]
    margin = 2.0 / _ACCURACY
    place = (F.col("rank") - F.col("below")) / F.col("inside")
    first = F.greatest(F.lit(0), F.floor((place - margin) * _PIVOTS) - 1).cast("int")
    last = F.least(F.lit(_PIVOTS), F.ceil((place + margin) * _PIVOTS) + 1).cast("int")
    cut = (
        _inside(values, state.where(wide), group)
        .groupBy(*rank_key, "n", "lo", "hi", "below", "inside")
        .agg(F.percentile_approx("value", shares, _ACCURACY).alias("pivots"))
        .withColumns({"low": F.get("pivots", first), "high": F.get("pivots", last)})
        .drop("pivots")
    )
    cut = settle(cut)
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    parts = (
        _inside(values, cut, group)
        .groupBy(*rank_key, "n", "lo", "hi", "low", "high", "below", "inside")
        .agg(
            F.count_if(value < low).alias("under"),
            F.count_if(value <= low).alias("upto_low"),
            F.count_if(value < high).alias("before_high"),
            F.count_if(value <= high).alias("upto_high"),
        )
    )
    return state.where(~wide).unionByName(_placed(parts, rank_key).select(*state.columns))


def _placed(parts: DataFrame, rank_key: list[str]) -> DataFrame:
    """The interval of each rank after its counts at two pivots `low` and `high`; without pivots it stays as it was."""
    rank, low, high = F.col("rank") - F.col("below"), F.col("low"), F.col("high")
    under, upto_low = F.col("under"), F.col("upto_low")
    before_high, upto_high = F.greatest("before_high", upto_low), F.col("upto_high")
    interval = lambda lo, hi, skipped, inside, found=None: F.struct(
        lo.alias("lo"), hi.alias("hi"), (F.col("below") + skipped).alias("below"), inside.alias("inside"),
        (F.lit(None).cast("double") if found is None else found).alias("found"),
    )
    none = F.lit(0).cast("long")
    moved = (
        F.when(rank < under, interval(F.col("lo"), low, none, under))
        .when(rank < upto_low, interval(low, low, under, none, low))
        .when(rank < before_high, interval(low, high, upto_low, before_high - upto_low))
        .when(rank < upto_high, interval(high, high, before_high, none, high))
        .otherwise(interval(high, F.col("hi"), upto_high, F.col("inside") - upto_high))
    )
    moved = F.when(F.col("low").isNull(), interval(F.col("lo"), F.col("hi"), none, F.col("inside"))).otherwise(moved)
    return parts.select(*rank_key, "n", moved.alias("moved")).select(*rank_key, "n", "moved.*")
