"""Near-duplicate embeddings through a pivot-permutation index.

Pivots are the positive and negative axes of random rotations, so they are spread out whatever the vectors are. A vector is
described by the pivots nearest to it, in order, PREFIX of each rotation. Inverted lists hold the vectors that have SHARED pivots of a
rotation in common, so vectors that meet have a shared-pivot count of SHARED at least, and each
pair is verified by the cosine once, in the first list that it shares. How often two vectors meet depends on their
angle only, not on their number or on how dense the place is that they lie in, and neither does the index.
"""

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.llm.components import connected_components, local_star
from paneloom.llm.tables import complete_runs, save, small_batches

THRESHOLD = 0.95
RECALL = 0.99  # share of pairs at the threshold that must meet
SEED, SAMPLED_PAIRS = 42, 4096  # of the rotations, and pairs at the threshold that the number of rotations is measured on
MOST_PIVOT_AXES, MOST_ROTATIONS = 256, 64
PREFIX, SHARED = 3, 2  # nearest pivots of a rotation that describe a vector, and how many of them two candidates share
BLOCK = 1024  # members of a list that one task compares with another such block
ROW = "cls long, weight long, keys array<long>, embedding array<double>"


def usable(embedding: Column) -> Column:
    """Whether a vector can link: no null, no null or non-finite component, not zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(embedding.isNotNull() & ~bad & F.exists(embedding, lambda x: x != 0), F.lit(False))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, first by their largest component so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


@lru_cache(maxsize=256)
def pivot_axes(size: int, rotation: int) -> np.ndarray:
    """Orthonormal columns; they and their negatives are the pivots of one rotation."""
    draws = np.random.default_rng([SEED, size, rotation]).normal(size=(size, min(size, MOST_PIVOT_AXES)))
    return np.linalg.qr(draws)[0]


def nearest_pivots(units: np.ndarray, rotation: int) -> np.ndarray:
    """For each unit vector the numbers of its nearest pivots of a rotation, nearest first."""
    along = units @ pivot_axes(units.shape[1], rotation)
    axes = np.argsort(-np.abs(along), axis=1, kind="stable")[:, :PREFIX]
    return 2 * axes + (np.take_along_axis(along, axes, 1) > 0)


def list_numbers(units: np.ndarray, rotations: int) -> np.ndarray:
    """For each unit vector the lists it stands in: every SHARED of its nearest pivots of each rotation.

    A number holds the rotation, then the pivots in rising order, so a rotation's lists follow one another.
    """
    found = []
    for start in range(0, len(units), 1024):
        part = units[start : start + 1024]
        columns = []
        for rotation in range(rotations):
            pivots = np.sort(nearest_pivots(part, rotation), axis=1)
            for chosen in combinations(range(pivots.shape[1]), min(SHARED, pivots.shape[1])):
                number = np.full(len(part), rotation)
                for place in chosen:
                    number = number * 2 * MOST_PIVOT_AXES + pivots[:, place]
                columns.append(number)
        found.append(np.stack(columns, axis=1))
    return np.concatenate(found)


def lists_a_rotation(size: int) -> int:
    pivots = min(PREFIX, size, MOST_PIVOT_AXES)
    return len(list(combinations(range(pivots), min(SHARED, pivots))))


def in_common(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """For pairs of rows of list numbers whether they share a list."""
    return (one[:, :, None] == other[:, None, :]).any(axis=(1, 2))


def pairs_at(cosine: float, size: int, n: int = SAMPLED_PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """Random pairs of unit vectors with the given cosine."""
    rng = np.random.default_rng([SEED, size])
    one = unit_rows(rng.normal(size=(n, size)))
    other = rng.normal(size=(n, size))
    other = unit_rows(other - (other * one).sum(axis=1, keepdims=True) * one)
    return one, cosine * one + np.sqrt(max(0.0, 1 - cosine * cosine)) * other


@lru_cache(maxsize=1024)
def rotations_for(size: int, threshold: float, recall: float) -> int:
    """The fewest rotations in which a share `recall` of pairs at the threshold meets; none if MOST_ROTATIONS don't do."""
    one, other = pairs_at(threshold, size)
    met = np.zeros(len(one), bool)
    each = lists_a_rotation(size)
    for rotations in range(1, MOST_ROTATIONS + 1):
        met[~met] = in_common(*(list_numbers(x[~met], rotations)[:, -each:] for x in (one, other)))
        if met.mean() >= recall:
            return rotations
    return 0


def _describe(threshold: float, recall: float, all_pairs: bool):
    """Adds the lists of each vector; without an index a vector is in one list with all of its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            embeddings = batch.column("embedding").to_pylist()
            keys: list[list[int]] = [[]] * len(embeddings)
            for size in {len(e) for e in embeddings}:
                rotations = 0 if all_pairs else rotations_for(size, threshold, recall)
                if rotations:
                    rows = [i for i, e in enumerate(embeddings) if len(e) == size]
                    found = list_numbers(unit_rows(np.array([embeddings[i] for i in rows], dtype=np.float64)), rotations)
                    for i, own in zip(rows, found.tolist()):
                        keys[i] = own
            yield pa.RecordBatch.from_arrays(
                [batch.column("cls"), batch.column("weight"), pa.array(keys, pa.list_(pa.int64())), batch.column("embedding")],
                names=["cls", "weight", "keys", "embedding"],
            )

    return run


def list_keys(keys: Column, size: Column) -> Column:
    """The lists of a vector; number -1 for the one list of all vectors of a length."""
    own = F.transform(keys, lambda key: F.struct(size.alias("size"), key.alias("q")))
    return F.when(F.size(keys) == 0, F.array(F.struct(size.alias("size"), F.lit(-1).cast("long").alias("q")))).otherwise(own)


def _met_before(keys: list[np.ndarray], q: int, each: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of rows share a list before list q; rotations are compared one by one."""
    met = np.zeros(len(i), bool)
    for start in range(0, keys[0].shape[1], each):
        for a in range(start, start + each):
            one = keys[0][i, a]
            for b in range(start, start + each):
                met |= (one == keys[-1][j, b]) & (one < q)
    return met


def _settled(keys: np.ndarray, q: int, each: int) -> np.ndarray:
    """Rows with equal non-negative numbers have met before list q, so their pairs need no comparison.

    Rows with the same pivots of the first rotation share its first list.
    """
    _, number = np.unique(keys[:, 0] * (1 << 32) + keys[:, each - 1], return_inverse=True)
    return np.where(keys[:, 0] < q, number, -1)


def _pairs(units: list[np.ndarray], keys: list[np.ndarray], q: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked (i, j) rows of two blocks, or of one with i < j, that list q answers for (-1: of all)."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    each = lists_a_rotation(units[0].shape[1])
    if q >= 0:
        together = _settled(np.concatenate(keys), q, each)
        known = [together[: len(units[0])], together[-len(units[-1]) :]]
    else:
        known = [np.full(len(u), -1) for u in units]
    order = np.argsort(known[0], kind="stable")
    for start in range(0, len(order), 256):
        rows = order[start : start + 256]
        first = known[0][rows[0]]
        alike = first >= 0 and first == known[0][rows[-1]]
        columns = np.flatnonzero(known[-1] != first) if alike else np.arange(len(units[-1]))
        i, j = np.nonzero(units[0][rows] @ units[-1][columns].T >= threshold)
        i, j = rows[i], columns[j]
        if len(units) == 1:
            i, j = i[i < j], j[i < j]
        if len(i) and q >= 0:
            once = ~_met_before(keys, q, each, i, j)
            i, j = i[once], j[once]
        found.append((i, j))
    return tuple(np.concatenate(x) for x in zip(*found))


def _links(units: list[np.ndarray], keys: list[np.ndarray], ids: list[np.ndarray], weights: list[np.ndarray], q: int, threshold: float):
    """(class, links of it, smallest class of its linked group) within a list or between two of its blocks."""
    i, j = _pairs(units, keys, q, threshold)
    nodes, at = np.unique(np.concatenate([ids[0][i], ids[-1][j]]), return_inverse=True)
    n = np.zeros(len(nodes), np.int64)
    np.add.at(n, at, np.concatenate([weights[-1][j], weights[0][i]]))
    inner, root = local_star(ids[0][i], ids[-1][j])
    low = nodes.copy()
    low[np.searchsorted(nodes, inner)] = root
    return nodes, n, low


def _verify(threshold: float):
    """For each list or pair of its blocks: link counts by class, and the smallest class of each linked group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in complete_runs(batches, "unit", 1 << 62):
            table = table.combine_chunks()
            unit, size, q, one, two, side, crossed, cls, weight = (
                table.column(c).to_numpy() for c in ("unit", "size", "q", "one", "two", "side", "crossed", "cls", "weight")
            )
            flat = {c: table.column(c).combine_chunks() for c in ("embedding", "keys")}
            ends = {c: np.r_[0, np.cumsum(pc.list_value_length(v).to_numpy())] for c, v in flat.items()}
            flat = {c: v.flatten().to_numpy() for c, v in flat.items()}
            edges = np.flatnonzero(np.any([np.diff(x) != 0 for x in (unit, size, q, one, two)], axis=0)) + 1
            found = []
            for begin, end in zip(np.r_[0, edges], np.r_[edges, table.num_rows]):
                parts = [begin + np.flatnonzero(side[begin:end] == s) for s in (0, 1)]
                parts = [p for p in parts if len(p)]
                if end - begin < 2 or (crossed[begin] and len(parts) < 2):
                    continue
                rows = {c: v[ends[c][begin] : ends[c][end]].reshape(end - begin, -1) for c, v in flat.items()}
                units = [unit_rows(rows["embedding"][p - begin]) for p in parts]
                keys = [rows["keys"][p - begin] for p in parts]
                links = _links(units, keys, [cls[p] for p in parts], [weight[p] for p in parts], int(q[begin]), threshold)
                if len(links[0]):
                    found.append(links)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["cls", "n", "low"])

    return run


def _dealt(described: DataFrame) -> DataFrame:
    """Members of every list, lists of over BLOCK members as pairs of blocks; sorted by unit of work."""
    keyed = described.withColumn("key", F.explode(list_keys(F.col("keys"), F.size("embedding")))).select("*", "key.*").drop("key")
    blocks = keyed.groupBy("size", "q").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    large = save(blocks.where("blocks > 1"))  # at most one in BLOCK list entries
    joined = keyed.join(large, ["size", "q"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    pairs = joined.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.withColumns({"one": F.least("own", "other"), "two": F.greatest("own", "other")})
    pairs = pairs.withColumns(
        {
            "side": F.when(F.col("own") == F.col("one"), 0).otherwise(1),
            "crossed": F.col("one") != F.col("two"),
            "unit": F.xxhash64("size", "q", "one", "two"),
        }
    ).drop("own", "other", "blocks")
    return pairs.repartition("unit").sortWithinPartitions("unit", "size", "q", "one", "two")


def embedding_groups(
    vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, id_column: str = "vec_id", vector_column: str = "embedding",
    all_pairs: bool = False,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Equal vectors form a class first, so copies cost one row per partition. Classes are described
    by their nearest pivots and listed, and a list of over BLOCK members is compared in
    pairs of blocks by many tasks. Lists give link counts and the smallest class of each linked
    group, not pairs. Pairs below the threshold are never linked; of pairs at the threshold `recall` are found,
    of closer ones more. The index is the same for any number of vectors, so more rows change no link of those there were.
    With `all_pairs`, and where no number of rotations reaches the recall, all vectors of a length are compared.

    Vectors that are null, zero or hold null or non-finite components link with nothing, vectors
    of different lengths don't link with each other. Repeated rows are vectors of their own. Rows with a null id take
    part; an empty table gives an empty result; other columns, labels too, are not read.
    """
    small_batches(vectors.sparkSession)
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("embedding"))
    linkable = rows.where(usable(F.col("embedding")))
    classes = linkable.groupBy("embedding").agg(F.min("vec_id").alias("low_id"), F.count(F.lit(1)).alias("weight"))
    classes = save(classes.withColumn("cls", F.monotonically_increasing_id()))
    described = classes.select("cls", "weight", "embedding").mapInArrow(_describe(threshold, recall, all_pairs), ROW)
    found = save(_dealt(save(described)).mapInArrow(_verify(threshold), "cls long, n long, low long"))
    parts = connected_components(found.where("low <> cls"), "cls", "low").withColumnsRenamed({"node": "cls"})
    links = found.groupBy("cls").agg(F.sum("n").alias("n"))
    labelled = save(classes.join(parts, "cls", "left").join(links, "cls", "left").withColumn("component", F.coalesce("component", "cls")))
    lowest = labelled.groupBy("component").agg(F.min("low_id").alias("component_id"))
    of_class = labelled.join(lowest, "component").select(
        "embedding", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id"
    )
    joined = rows.join(save(of_class), "embedding", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
