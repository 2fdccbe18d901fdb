"""Regression trees on binned columns, grown level by level from exact histograms.

Targets are whole multiples of a small unit, so histogram sums are exact, and a fit doesn't depend on how rows are
dealt to tasks. Rows that one task holds are grown on there (`HeldRows`); more rows stay in their table, and each level is one keyed sum of
histograms over all tasks (`SpreadRows`). Both grow the same trees. Rows are sampled by a hash of their key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.operators.scaling import settle

BINS = 32
EDGE_ROWS = 100_000  # rows, chosen by a hash of their key, that the bin edges are taken from
EXACT = 2.0**50  # sums of whole numbers stay below this, so they are exact in double precision
_CELLS = 1 << 21  # (row, column) cells counted at a time
_PACK = 1024  # joint codes of columns that are counted together
_NODES = 256  # nodes whose splits are searched at a time


def mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """64 pseudo-random bits per key and salt (the finaliser of SplitMix64)."""
    with np.errstate(over="ignore"):
        z = keys.view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def uniform(keys: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) per key and salt."""
    return (mixed(keys, salt) >> np.uint64(11)).astype(np.float64) * 2.0**-53


@dataclass(frozen=True)
class Trees:
    """Trees of one ensemble: a row goes to `left`, or to the node after it if its code is above `bin`; leaves lead to themselves."""

    roots: np.ndarray
    column: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int

    def leaves(self, codes: np.ndarray, tree: int) -> np.ndarray:
        """The leaf of each row in one tree."""
        at, flat, rows = np.full(len(codes), self.roots[tree]), codes.reshape(-1), np.arange(len(codes)) * codes.shape[1]
        for _ in range(self.depth):
            at = self.left[at] + (flat.take(rows + self.column[at]) > self.bin[at])
        return at


def joined(parts: Sequence[Trees]) -> Trees:
    starts = np.cumsum([0, *(len(p.column) for p in parts)])
    whole = lambda name, shift: np.concatenate([getattr(p, name) + (s if shift else 0) for p, s in zip(parts, starts)])
    return Trees(whole("roots", True), whole("column", False), whole("bin", False), whole("left", True), whole("value", False), max(p.depth for p in parts))


def edges_of(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """For each column `bins` - 1 rising edges, filled up with infinity.

    Few distinct values are parted midway, else each bin gets an equal share of the rows.
    """
    found = np.full((values.shape[1], bins - 1), np.inf)
    for c in range(values.shape[1]):
        column = np.sort(values[:, c])
        distinct = np.unique(column)
        if len(distinct) <= bins:
            own = (distinct[:-1] + distinct[1:]) / 2
        else:
            own = np.unique(column[(np.arange(1, bins) * len(column)) // bins - 1])
        found[c, : len(own)] = own
    return found


def codes_of(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The bin of each value: how many edges are below it."""
    codes = np.empty(values.shape, np.uint8)
    for c in range(values.shape[1]):
        codes[:, c] = np.searchsorted(edges[c], values[:, c], side="left")
    return codes


def whole_unit(largest: float, rows: int) -> float:
    """A power of two: values up to `largest` times it, summed over `rows` rows, stay exact."""
    bound = max(largest, 1e-300) * max(rows, 1)
    return 2.0 ** min(40, int(np.floor(np.log2(EXACT / bound))))


def _count(codes, target, weights, at, slot, n_slots, bins) -> np.ndarray:
    """(slot, column, bin, 2): weighted sums of the target and of ones over the rows whose node has a slot."""
    n_columns = codes.shape[1]
    size = n_slots * n_columns * bins
    sums, counts = np.zeros(size), np.zeros(size)
    offsets = np.arange(n_columns) * bins
    step = max(1, _CELLS // (n_columns * weights.shape[1]))
    for start in range(0, len(codes), step):
        own = slot[at[start : start + step]]
        w = weights[start : start + step]
        i, k = np.nonzero((own >= 0) & (w > 0))
        if not len(i):
            continue
        cells = ((own[i, k] * (n_columns * bins))[:, None] + (codes[start + i] + offsets)).ravel()
        heft = w[i, k].astype(np.float64)
        counts += np.bincount(cells, minlength=size) if heft.max() == 1 else np.bincount(cells, np.repeat(heft, n_columns), size)
        sums += np.bincount(cells, np.repeat(heft * target[start + i], n_columns), size)
    return np.stack([sums, counts], axis=1).astype(np.int64).reshape(n_slots, n_columns, bins, 2)


@dataclass(frozen=True)
class Pack:
    """Columns whose codes make one number a row, below the product of `sizes`."""

    columns: tuple[int, ...]
    sizes: tuple[int, ...]
    values: np.ndarray


def columns_of(codes: np.ndarray) -> list[Pack]:
    """Each column by itself."""
    return [Pack((c,), (int(codes[:, c].max(initial=0)) + 1,), np.ascontiguousarray(codes[:, c])) for c in range(codes.shape[1])]


def packs_of(single: Sequence[Pack]) -> list[Pack]:
    """Columns in packs of at most `_PACK` joint codes, by their places in `single`."""
    groups: list[list[int]] = []
    size = lambda i: single[i].sizes[0]
    for i in sorted(range(len(single)), key=lambda i: -size(i)):
        own = next((g for g in groups if size(i) * int(np.prod([size(k) for k in g])) <= _PACK), None)
        if own is None:
            groups.append([i])
        else:
            own.append(i)
    packs = []
    for group in groups:
        values = single[group[0]].values
        for i in group[1:]:
            values = values.astype(np.uint16) * np.uint16(size(i)) + single[i].values
        packs.append(Pack(tuple(group), tuple(size(i) for i in group), values))
    return packs


def _count_packed(packs: Iterator[tuple[Pack, np.ndarray]], n_columns: int, target, weights, own, n_slots: int, bins: int) -> np.ndarray:
    """As `_count` for one tree and rows of slots `own`: joint histograms of packs, then their margins, all exact."""
    out = np.zeros((n_slots, n_columns, bins, 2), np.int64)
    equal = weights.max(initial=1) == 1
    total = target if equal else weights * target
    for pack, values in packs:
        width = int(np.prod(pack.sizes))
        cells, shape = own * width, (n_slots, *pack.sizes)
        cells += values
        counts = np.bincount(cells, None if equal else weights, n_slots * width).reshape(shape)
        sums = np.bincount(cells, total, n_slots * width).reshape(shape)
        for axis, (c, size) in enumerate(zip(pack.columns, pack.sizes)):
            others = tuple(i + 1 for i in range(len(shape) - 1) if i != axis)
            out[:, c, :size, 0], out[:, c, :size, 1] = sums.sum(axis=others), counts.sum(axis=others)
    return out


def _splits(hist: np.ndarray, least: int, allowed: np.ndarray) -> tuple[np.ndarray, ...]:
    """(gains?, column, bin, left's sums): the best split of each node; equal ones by the lower column, then bin."""
    found = []
    for start in range(0, len(hist), _NODES):
        part = hist[start : start + _NODES]
        below = [part[..., i].cumsum(axis=2) for i in (0, 1)]
        whole, (low, n_left) = [b[:, :, -1:] for b in below], [b[:, :, :-1] for b in below]
        high, n_right = (w - b for w, b in zip(whole, (low, n_left)))
        fits = (n_left >= least) & (n_right >= least) & allowed[start : start + _NODES, :, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            score = low.astype(np.float64) ** 2 / n_left + high.astype(np.float64) ** 2 / n_right
        score[~fits] = -np.inf
        score = score.reshape(len(part), -1)
        best = score.argmax(axis=1)
        column, cut = np.divmod(best, part.shape[2] - 1)
        rows = np.arange(len(part))
        total, n = (w[:, 0, 0].astype(np.float64) for w in whole)
        base = total**2 / np.maximum(n, 1)
        chosen = np.stack([low[rows, column, cut], n_left[rows, column, cut]], axis=1)
        found.append((score[rows, best] > base * (1 + 1e-12) + 1e-9, column, cut, chosen))
    return tuple(np.concatenate(x) for x in zip(*found))


class HeldRows:
    """Rows of one task; each column of `weights` is a sample for one tree. `single` has the columns of `codes`, if they are known."""

    def __init__(self, codes: np.ndarray, target: np.ndarray, weights: np.ndarray, bins: int = BINS, single: list[Pack] | None = None):
        self.codes, self.target, self.weights, self.bins = codes, target, weights, bins
        self.trees, self.single, self.packs = weights.shape[1], single, None
        self.at = np.broadcast_to(np.arange(self.trees), weights.shape).copy()

    def histograms(self, slot: np.ndarray, n_slots: int, columns: np.ndarray) -> np.ndarray:
        """Of these columns."""
        if self.trees > 1:
            codes = self.codes if len(columns) == self.codes.shape[1] else self.codes[:, columns]
            return _count(codes, self.target, self.weights, self.at, slot, n_slots, self.bins)
        if self.packs is None:
            single = self.single or columns_of(self.codes)
            own = [Pack((i,), single[c].sizes, single[c].values) for i, c in enumerate(columns)]
            self.packs = packs_of(own), own
        own, weights = slot[self.at[:, 0]], self.weights[:, 0]
        rows = np.flatnonzero((own >= 0) & (weights > 0))
        packs = self.packs[0 if n_slots * _PACK <= len(rows) else 1]  # margins cost as much as there are cells
        taken = ((p, p.values.take(rows)) for p in packs)
        return _count_packed(taken, len(columns), self.target[rows], weights[rows], own[rows], n_slots, self.bins)

    def route(self, column: np.ndarray, cut: np.ndarray, left: np.ndarray) -> None:
        """One level down."""
        flat, width = self.codes.reshape(-1), self.codes.shape[1]
        step = max(1, _CELLS // self.trees)
        for start in range(0, len(self.at), step):
            now = self.at[start : start + step]
            rows = np.arange(start, start + len(now))[:, None] * width
            self.at[start : start + step] = left[now] + (flat.take(rows + column[now]) > cut[now])


class SpreadRows:
    """Rows of a table: `make` gives (codes, target, weights) of a batch.

    Histograms are combined in each task and summed by (node, column); nodes x columns rows reach the driver.
    """

    def __init__(self, table: DataFrame, make: Callable[[pa.RecordBatch], tuple], trees: int, bins: int = BINS):
        self.table, self.make, self.trees, self.bins = table, make, trees, bins
        self.nodes: tuple | None = None
        self.levels = 0

    def histograms(self, slot: np.ndarray, n_slots: int, columns: np.ndarray) -> np.ndarray:
        make, nodes, levels, trees, bins = self.make, self.nodes, self.levels, self.trees, self.bins
        shape = (n_slots, len(columns), bins, 2)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape, np.int64)
            for batch in batches:
                if batch.num_rows:
                    held = HeldRows(*make(batch), bins)
                    for _ in range(levels):
                        held.route(*nodes)
                    total += held.histograms(slot, n_slots, columns)
            flat = total.reshape(-1, 2 * bins)
            cells = np.flatnonzero(flat.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(flat[cells].tolist(), pa.list_(pa.int64()))], names=["cell", "sums"])

        parts = self.table.mapInArrow(run, "cell long, sums array<long>")
        whole = parts.groupBy("cell").agg(F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(2 * bins)]).alias("sums")).collect()
        out = np.zeros((n_slots * len(columns), 2 * bins), np.int64)
        for cell, sums in whole:
            out[cell] = sums
        return out.reshape(shape)

    def route(self, column: np.ndarray, cut: np.ndarray, left: np.ndarray) -> None:
        self.nodes, self.levels = (column, cut, left), self.levels + 1


def grow(rows: HeldRows | SpreadRows, depth: int, least: int, allowed: np.ndarray) -> Trees:
    """One tree per sample of the rows, each to least squares; values of leaves are means of the whole target.

    A level counts the smaller child of each split, on the columns that any tree may use; the other child's histogram is what is
    left of its parent's. Children of which neither can be split are not counted.
    """
    k, columns = rows.trees, np.flatnonzero(allowed.any(axis=0))
    allowed = allowed[:, columns]
    column, cut, left, tree = np.zeros(k, np.int16), np.full(k, 255, np.uint8), np.arange(k), np.arange(k)
    fresh, rest, parents = np.arange(k), np.zeros(0, np.int64), None
    sums, reached = np.zeros((k, 2), np.int64), 0
    for level in range(depth):
        nodes = np.concatenate([fresh, rest])
        if not len(nodes):
            break
        slot = np.full(len(column), -1)
        slot[fresh] = np.arange(len(fresh))
        hist = rows.histograms(slot, len(fresh), columns)
        if parents is None:
            sums = hist[:, 0].sum(axis=1)
        else:
            hist = np.concatenate([hist, parents - hist])
        open_ = sums[nodes, 1] >= 2 * least
        nodes, hist = nodes[open_], hist[open_]
        if not len(nodes):
            break
        good, col, where, low = _splits(hist, least, allowed[tree[nodes]])
        nodes, col, where, low, hist = nodes[good], col[good], where[good], low[good], hist[good]
        if not len(nodes):
            break
        reached = level + 1
        first = len(column) + 2 * np.arange(len(nodes))
        column[nodes], cut[nodes], left[nodes] = columns[col], where, first
        new = len(column) + np.arange(2 * len(nodes))
        high = sums[nodes] - low
        sums = np.concatenate([sums, np.stack([low, high], axis=1).reshape(-1, 2)])
        tree = np.concatenate([tree, np.repeat(tree[nodes], 2)])
        column = np.concatenate([column, np.zeros(len(new), np.int16)])
        cut = np.concatenate([cut, np.full(len(new), 255, np.uint8)])
        left = np.concatenate([left, new])
        rows.route(column, cut, left)
        smaller = low[:, 1] <= high[:, 1]
        fresh, rest = np.where(smaller, first, first + 1), np.where(smaller, first + 1, first)
        counted = sums[rest, 1] >= 2 * least  # the larger child; if it can't be split, neither can the other
        fresh, rest, parents = fresh[counted], rest[counted], hist[counted]
    return Trees(np.arange(k), column, cut, left, sums[:, 0] / np.maximum(sums[:, 1], 1), reached)


# ------------------------------------------------------------------------------ boosting


@dataclass(frozen=True)
class Boosting:
    """Rounds, learning rate, depth, least rows of a leaf, and the shares of rows and columns that a round uses."""

    rounds: int
    rate: float
    depth: int
    least: int = 1
    rows: float = 1.0
    columns: float = 1.0
    seed: int = 42


@dataclass
class Fit:
    """An ensemble: base + rate x the sum of its trees, times `unit`."""

    edges: np.ndarray
    rate: float
    base: float = 0.0
    unit: float = 1.0
    parts: list[Trees] = field(default_factory=list)

    def predict(self, codes: np.ndarray) -> np.ndarray:
        out = np.full(len(codes), self.base)
        for part in self.parts:
            out = self.add(part, codes, out)
        return out


    def __post_init__(self) -> None:
        self.edges = np.asarray(self.edges)

    def add(self, trees: Trees, codes: np.ndarray, margin: np.ndarray) -> np.ndarray:
        """The margin of rows after one more part of the ensemble."""
        for tree in range(len(trees.roots)):
            margin = margin + self.rate * (trees.value[trees.leaves(codes, tree)] * self.unit)
        return margin


def _round(p: Boosting, fit: Fit, number: int, y: np.ndarray, margin: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(target, weights) of the rows in a round."""
    target = np.rint((y - margin) / fit.unit)
    if p.rows >= 1:
        return target, np.ones((len(y), 1), np.uint8)
    return target, (uniform(keys, p.seed * 1_000_003 + number) < p.rows).astype(np.uint8)[:, None]


def _columns_of(p: Boosting, number: int, n_columns: int) -> np.ndarray:
    """The columns that a round may use."""
    allowed = np.zeros((1, n_columns), bool)
    taken = max(1, int(round(p.columns * n_columns)))
    allowed[0, np.random.default_rng([p.seed, number]).permutation(n_columns)[:taken]] = True
    return allowed


def _start(fit: Fit, total: int, largest: float, sum_of: Callable[[float], int], farthest: Callable[[float], float]) -> None:
    """Base (the exact mean) and unit of an ensemble."""
    unit = whole_unit(largest, total)
    fit.base = sum_of(unit) / max(total, 1) / unit
    fit.unit = 1 / whole_unit(4 * farthest(fit.base), total)  # residuals of sampled rounds may grow a little before they shrink


def boost(codes: np.ndarray, y: np.ndarray, keys: np.ndarray, p: Boosting, fit: Fit, start: int, stop: int) -> None:
    """Add the rounds from `start` to before `stop` to `fit`, on rows that this task holds."""
    if start == 0:
        _start(fit, len(y), float(np.abs(y).max(initial=0.0)), lambda u: int(np.rint(y * u).astype(np.int64).sum()), lambda b: float(np.abs(y - b).max(initial=0.0)))
    margin, single = fit.predict(codes), columns_of(codes)
    for number in range(start, stop):
        rows = HeldRows(codes, *_round(p, fit, number, y, margin, keys), single=single)
        trees = grow(rows, p.depth, p.least, _columns_of(p, number, codes.shape[1]))
        fit.parts.append(trees)
        margin = margin + fit.rate * (trees.value[rows.at[:, 0]] * fit.unit)


# ------------------------------------------------------------------------------ forests


@dataclass(frozen=True)
class Forest:
    """Trees, depth, least rows of a leaf; every tree sees a bootstrap of the rows and all columns."""

    trees: int = 200
    depth: int = 6
    least: int = 5
    seed: int = 42


def _bootstrap(keys: np.ndarray, trees: Sequence[int], seed: int) -> np.ndarray:
    """How often each row is in each tree's sample: Poisson numbers of mean one by a hash of key and tree."""
    steps = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)]))
    return np.stack([np.searchsorted(steps, uniform(keys, seed * 1_000_003 + t), side="right") for t in trees], axis=1).astype(np.uint8)


def forest(total: int, largest: float, p: Forest, edges: np.ndarray, together: int, rows_of: Callable) -> Fit:
    """The mean of trees on hashed bootstraps; `rows_of(unit, numbers)` gives the rows with samples for the trees of these numbers."""
    unit = whole_unit(16 * largest, total)  # a row is in a sample 11 times at most
    fit = Fit(edges, 1.0 / p.trees, 0.0, 1 / unit)
    for start in range(0, p.trees, together):
        numbers = range(start, min(start + together, p.trees))
        fit.parts.append(grow(rows_of(unit, numbers), p.depth, p.least, np.ones((len(numbers), len(edges)), bool)))
    return fit


def held_forest(codes: np.ndarray, y: np.ndarray, keys: np.ndarray, p: Forest, edges: np.ndarray) -> Fit:
    """A forest on rows that this task holds."""
    together = int(min(p.trees, max(1, _CELLS // max(1, len(y)))))
    rows_of = lambda unit, numbers: HeldRows(codes, np.rint(y * unit), _bootstrap(keys, numbers, p.seed))
    return forest(len(y), float(np.abs(y).max(initial=0.0)), p, edges, together, rows_of)


def spread_forest(rows: DataFrame, total: int, p: Forest, edges: np.ndarray, together: int = 25) -> Fit:
    """The same forest on a table of (key long, y double, codes binary)."""
    largest = rows.agg(F.max(F.abs("y"))).first()[0] or 0.0
    width = len(edges)

    def rows_of(unit: float, numbers: range) -> SpreadRows:
        def make(batch: pa.RecordBatch):
            keys, y, codes = _arrays([batch], width)
            return codes, np.rint(y * unit), _bootstrap(keys, numbers, p.seed)

        return SpreadRows(rows, make, len(numbers))

    return forest(total, largest, p, edges, min(together, p.trees), rows_of)


# ------------------------------------------------------------------------------ on Spark


TREE_SCHEMA = "part int, depth int, roots binary, column binary, bin binary, left binary, value binary, base double, unit double"
_KINDS = {"roots": "<i8", "column": "<i2", "bin": "u1", "left": "<i8", "value": "<f8"}


def packed(fit: Fit) -> pa.RecordBatch:
    """One row per part of an ensemble."""
    rows = [
        {"part": i, "depth": t.depth, "base": fit.base, "unit": fit.unit} | {n: np.ascontiguousarray(getattr(t, n), k).tobytes() for n, k in _KINDS.items()}
        for i, t in enumerate(fit.parts)
    ]
    kinds = {"part": pa.int32(), "depth": pa.int32(), "base": pa.float64(), "unit": pa.float64()}
    names = [c.split()[0] for c in TREE_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.binary())) for n in names], names=names)


def unpacked(rows: Sequence, edges: np.ndarray, rate: float) -> Fit:
    rows = sorted(rows, key=lambda r: r["part"])
    fit = Fit(edges, rate)
    if rows:
        fit.base, fit.unit = rows[0]["base"], rows[0]["unit"]
    for r in rows:
        arrays = {n: np.frombuffer(r[n], k) for n, k in _KINDS.items()}
        fit.parts.append(Trees(arrays["roots"], arrays["column"], arrays["bin"], arrays["left"], arrays["value"], r["depth"]))
    return fit


def column_values(column: pa.Array) -> np.ndarray:
    """A column of equally long arrays as a table of numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def edge_rows(keys: np.ndarray, total: int) -> np.ndarray:
    """Which of `total` rows bin edges are taken from: all, or about EDGE_ROWS by a hash of the key."""
    return uniform(keys, -1) * total < EDGE_ROWS


def bin_edges(rows: DataFrame, values: str, key: str, total: int, bins: int = BINS) -> np.ndarray:
    """Edges of each column from the rows that `edge_rows` names; no more reach the task that sorts them."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(edge_rows(batch.column("key").to_numpy(), total)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [column_values(b.column("values")) for b in batches if b.num_rows]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(edges_of(np.concatenate(held), bins).tolist(), pa.list_(pa.float64()))], names=["edges"])

    own = rows.select(F.col(key).alias("key"), F.col(values).alias("values"))
    found = own.mapInArrow(chosen, own.schema).repartition(1).mapInArrow(run, "edges array<double>").collect()
    return np.array([r.edges for r in found]).reshape(len(found), bins - 1)


def binned(rows: DataFrame, values: str, edges: np.ndarray, keep: Sequence[str]) -> DataFrame:
    """The rows' bins as one binary value, with the columns of `keep`."""
    kept = rows.select(*keep, F.col(values).alias("codes"))
    schema = kept.drop("codes").schema.add("codes", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = codes_of(column_values(batch.column("codes")), edges)
                packed_codes = pa.array([c.tobytes() for c in codes], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed_codes], names=batch.schema.names)

    return kept.mapInArrow(run, schema)


def _arrays(batches: Sequence[pa.RecordBatch], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, y, codes) of batches."""
    keys = np.concatenate([b.column("key").to_numpy() for b in batches]) if batches else np.zeros(0, np.int64)
    y = np.concatenate([b.column("y").to_numpy() for b in batches]) if batches else np.zeros(0)
    codes = np.frombuffer(b"".join(v for b in batches for v in b.column("codes").to_pylist()), np.uint8).reshape(-1, width)
    return keys, y, codes


def _held_boosted(rows: DataFrame, p: Boosting, edges: np.ndarray, rounds_a_stage: int) -> Fit:
    """Rounds in one task; a job adds `rounds_a_stage` of them, so a lost executor costs no more."""
    one = rows.select("key", "y", "codes").coalesce(1)

    def stage(state: Fit, start: int, stop: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, y, codes = _arrays([b for b in batches if b.num_rows], len(edges))
            own = Fit(edges, p.rate, state.base, state.unit, list(state.parts))
            boost(codes, y, keys, p, own, start, stop)
            yield packed(Fit(edges, p.rate, own.base, own.unit, [joined(own.parts[len(state.parts) :])]))

        return run

    fit = Fit(edges, p.rate)
    for start in range(0, p.rounds, rounds_a_stage):
        found = one.mapInArrow(stage(fit, start, min(start + rounds_a_stage, p.rounds)), TREE_SCHEMA).collect()  # one row
        new = unpacked(found, edges, p.rate)
        fit = Fit(edges, p.rate, new.base, new.unit, [*fit.parts, *new.parts])
    return fit


def _spread_boosted(rows: DataFrame, p: Boosting, edges: np.ndarray, total: int, rounds_a_stage: int) -> Fit:
    """A job for each level of each tree over all rows.

    Margins are written every `rounds_a_stage` rounds, so that a job adds up these rounds' trees only.
    """
    width = len(edges)
    fit = Fit(edges, p.rate)
    in_units = lambda unit: int(rows.agg(F.sum(F.rint(F.col("y") * unit).cast("decimal(38,0)"))).first()[0] or 0)
    farthest = lambda base: rows.agg(F.max(F.abs(F.col("y") - base))).first()[0] or 0.0
    _start(fit, total, rows.agg(F.max(F.abs("y"))).first()[0] or 0.0, in_units, farthest)
    table, since = rows.select("key", "y", "codes").withColumn("margin", F.lit(fit.base)), 0

    def margins(batch: pa.RecordBatch, parts: Sequence[Trees]) -> tuple:
        keys, y, codes = _arrays([batch], width)
        margin = batch.column("margin").to_numpy()
        for part in parts:
            margin = fit.add(part, codes, margin)
        return keys, y, codes, margin

    def moved(parts: Sequence[Trees]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    *_, margin = margins(batch, parts)
                    yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(margin)], names=batch.schema.names)

        return run

    for number in range(p.rounds):
        if number - since >= rounds_a_stage:
            table, since = settle(table.mapInArrow(moved(fit.parts[since:]), table.schema)), number
        parts = fit.parts[since:]

        def make(batch: pa.RecordBatch, number=number, parts=parts):
            keys, y, codes, margin = margins(batch, parts)
            return codes, *_round(p, fit, number, y, margin, keys)

        fit.parts.append(grow(SpreadRows(table, make, 1), p.depth, p.least, _columns_of(p, number, width)))
    return fit


def boosted(rows: DataFrame, p: Boosting, edges: np.ndarray, total: int, held_rows: int, rounds_a_stage: int) -> Fit:
    """Boost over rows (key long, y double, codes binary): in one task up to `held_rows` rows, else by jobs over all.

    A task that holds the rows needs (4 x columns + 100) bytes for each. The trees are the same either way.
    """
    if total <= held_rows:
        return _held_boosted(rows, p, edges, rounds_a_stage)
    return _spread_boosted(rows, p, edges, total, max(1, rounds_a_stage // 4))


def prediction(fit: Fit, values: Column) -> Column:
    """The ensemble's prediction for a column of arrays."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            rows = np.array(part.tolist(), np.float64).reshape(len(part), len(fit.edges))
            yield pd.Series(fit.predict(codes_of(rows, fit.edges)))

    return F.pandas_udf(run, "double")(values)
