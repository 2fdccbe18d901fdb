"""The tree engine against plain recursion, and one result however rows are dealt."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneloom.operators import dml, elasticity, trees

RNG = np.random.default_rng(8)
N = 300
VALUES = np.column_stack([RNG.normal(size=N), RNG.integers(0, 3, N), np.round(RNG.normal(size=N), 1), np.full(N, 2.0)])
Y = VALUES[:, 0] * 2 + (VALUES[:, 1] > 1) + RNG.normal(0, 0.2, N)
KEYS = RNG.integers(-(2**62), 2**62, N)


def plain_tree(codes, target, weights, depth, least):
    """Predictions of one tree for all rows, by recursion over sets of rows."""
    out = np.zeros(len(codes))

    def grow(rows, left_levels):
        w, s = weights[rows], weights[rows] * target[rows]
        n, total = int(w.sum()), s.sum()
        best = (total**2 / n * (1 + 1e-12) + 1e-9, None)
        if left_levels and n >= 2 * least:
            for c in range(codes.shape[1]):
                for cut in range(trees.BINS - 1):
                    low = codes[rows, c] <= cut
                    a, b = int(w[low].sum()), int(w[~low].sum())
                    if a >= least and b >= least:
                        gain = s[low].sum() ** 2 / a + s[~low].sum() ** 2 / b
                        if gain > best[0]:
                            best = (gain, (c, cut))
        if best[1] is None:
            out[rows] = total / n
            return
        low = codes[rows, best[1][0]] <= best[1][1]
        grow(rows[low], left_levels - 1)
        grow(rows[~low], left_levels - 1)

    grow(np.arange(len(codes)), depth)
    return out


@pytest.fixture(scope="module")
def coded():
    edges = trees.edges_of(VALUES)
    return edges, trees.codes_of(VALUES, edges)


@pytest.fixture(scope="module")
def table(spark, coded):
    edges, codes = coded
    rows = [(int(k), float(y), bytearray(c.tobytes())) for k, y, c in zip(KEYS, Y, codes)]
    return spark.createDataFrame(rows, "key long, y double, codes binary")


def test_bins_part_few_values_midway_and_many_evenly(coded):
    edges, codes = coded
    assert edges[1][:2].tolist() == [0.5, 1.5] and np.isinf(edges[1][2:]).all() and np.isinf(edges[3]).all()
    assert sorted(set(codes[:, 1])) == [0, 1, 2] and set(codes[:, 3]) == {0}
    assert np.bincount(codes[:, 0]).max() <= 2 * N / trees.BINS


def test_a_forest_equals_plain_trees_on_the_same_bootstrap(coded):
    edges, codes = coded
    chosen = trees.Forest(trees=7, depth=4, least=5, seed=3)
    fit = trees.held_forest(codes, Y, KEYS, chosen, edges)
    samples = trees._bootstrap(KEYS, range(7), 3)
    assert abs(samples.mean() - 1) < 0.1 and samples.max() > 2
    target = np.rint(Y / fit.unit)
    want = np.mean([plain_tree(codes, target, samples[:, t].astype(np.int64), 4, 5) for t in range(7)], axis=0) * fit.unit
    assert fit.predict(codes) == pytest.approx(want, abs=1e-9)


def test_histograms_of_packed_columns_are_those_of_cells(coded):
    """Few slots (packs of columns) and many (single columns), samples and repeats, on some of the columns."""
    codes, target = np.repeat(coded[1], 20, axis=0), np.rint(RNG.normal(0, 1e6, 20 * N))
    for n_slots in (3, 40):
        for weights in (RNG.integers(0, 2, (20 * N, 1)), RNG.integers(0, 5, (20 * N, 1))):
            for columns in (np.arange(4), np.array([1, 3])):
                held = trees.HeldRows(codes, target, weights.astype(np.uint8))
                held.at[:, 0] = RNG.integers(0, n_slots + 2, 20 * N)
                slot = np.r_[-1, np.arange(n_slots), -1]
                want = trees._count(codes[:, columns], target, held.weights, held.at, slot, n_slots, trees.BINS)
                assert np.array_equal(held.histograms(slot, n_slots, columns), want)
                joint, single = held.packs
                assert len(single) == len(columns) > len(joint) and all(np.prod(p.sizes) <= trees._PACK for p in joint)


def test_boosting_equals_plain_rounds(coded):
    edges, codes = coded
    p = trees.Boosting(rounds=6, rate=0.3, depth=3, least=4, seed=5)
    fit = trees.Fit(edges, p.rate)
    trees.boost(codes, Y, KEYS, p, fit, 0, 6)
    margin = np.full(N, fit.base)
    assert fit.base == pytest.approx(Y.mean(), abs=1e-9)
    for _ in range(6):
        margin = margin + 0.3 * plain_tree(codes, np.rint((Y - margin) / fit.unit), np.ones(N, np.int64), 3, 4) * fit.unit
    assert fit.predict(codes) == pytest.approx(margin, abs=1e-9)
    assert np.mean((margin - Y) ** 2) < 0.3 * Y.var()


def same(a, b):
    a, b = trees.joined(a.parts), trees.joined(b.parts)
    return all(np.array_equal(getattr(a, n), getattr(b, n)) for n in ("column", "bin", "left", "value", "roots"))


def test_boosting_does_not_depend_on_partitions_or_on_who_holds_the_rows(table, coded):
    edges, codes = coded
    p = trees.Boosting(rounds=9, rate=0.2, depth=3, least=3, rows=0.7, columns=0.6, seed=1)
    fits = [trees.boosted(table.repartition(n), p, edges, N, N, 4) for n in (1, 4, 32)]
    fits.append(trees.boosted(table.repartition(4), p, edges, N, N - 1, 8))
    fits.append(trees.boosted(table.repartition(3), p, edges, N, N - 1, 100))
    own = trees.Fit(edges, p.rate)
    trees.boost(codes, Y, KEYS, p, own, 0, 9)
    assert all(same(f, own) and f.base == own.base and f.unit == own.unit for f in fits)
    sampled = trees._round(p, own, 3, Y, np.zeros(N), KEYS)[1]
    assert 0.55 < sampled.mean() < 0.85 and not (sampled == trees._round(p, own, 4, Y, np.zeros(N), KEYS)[1]).all()


def test_a_spread_forest_equals_a_held_one(table, coded):
    edges, codes = coded
    p = trees.Forest(trees=6, depth=4, least=5)
    held = trees.held_forest(codes, Y, KEYS, p, edges).predict(codes)
    assert np.array_equal(trees.spread_forest(table.repartition(5), N, p, edges, together=4).predict(codes), held)
    assert same(trees.spread_forest(table.repartition(2), N, p, edges), trees.held_forest(codes, Y, KEYS, p, edges))


def test_constant_targets_single_rows_and_null_free_leaves(coded):
    edges, codes = coded
    flat = trees.held_forest(codes, np.full(N, 4.25), KEYS, trees.Forest(trees=3), edges)
    assert flat.predict(codes) == pytest.approx(np.full(N, 4.25))
    one = trees.Fit(edges, 0.1)
    trees.boost(codes[:1], Y[:1], KEYS[:1], trees.Boosting(3, 0.1, 2), one, 0, 3)
    assert one.predict(codes[:2]) == pytest.approx([Y[0], Y[0]])


@pytest.mark.parametrize("nuisance, params", [("random-forest", {"trees": 4}), ("gradient-boosting", {"rounds": 3})])
def test_residuals_are_the_same_for_any_partitions_and_for_large_segments(spark, nuisance, params):
    rows = [(i, f"S{i % 3}", "P" if i % 3 else "Q", float(20 + i % 13 + i % 3), 5 + 0.1 * (i % 7), 0.1 * (i % 5), float(i % 11)) for i in range(240)]
    df = spark.createDataFrame(rows, "n int, store_id string, product_id string, units_sold double, price double, discount double, inventory_level double")
    df = df.withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("n")))
    keyed = elasticity.segment_key(elasticity.log_treatment(df))

    def residuals(partitions, **more):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        try:
            made = dml.cross_fit_residuals(keyed, ["segment_key"], ["discount", "inventory_level"], nuisance, params=params, **more)
            return {r["n"]: (r["fold"], r["y_res"], r["t_res"]) for r in made.collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")

    want = residuals(2)
    assert len(want) == 240 and all(np.isfinite(r[1]) and np.isfinite(r[2]) for r in want.values())
    assert residuals(8) == want
    assert residuals(4, held_rows=100) == want  # one segment has 160 rows, the other 80
