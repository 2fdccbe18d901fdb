"""Centroid clustering with heap-ordered bounds.

A vector's gap is how much nearer its own centroid is than any other. After centroids move, the gap may have shrunk by at most the own
drift and the largest drift of the others. Each cluster keeps its vectors in the order of gap plus the drift
that had accumulated when the gap was measured: the vectors in front whose value lies below the drift accumulated by now have
expired. Only they are popped, scanned exactly and put back; the others keep their cluster unread.

The order is kept in tables sorted by cluster and value, so popping is a range of them, and what a pop puts back is a new table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.llm.tables import Saved, save, small_batches

SIZE, CLUSTERS, ROUNDS, SCALE, SALT = 64, 8, 10, 1024, "3:"
LARGEST = 1 << 27  # of a component: squared distances of 64 of them fit in a long
COMPACT = 0.5  # when a pop takes this share of all vectors, all are written to one table

HELD = "vec_id long, vector binary, cluster int, was int, due double"


@dataclass
class State:
    """Centroids, and for each cluster the drift accumulated up to the last pop and up to now."""

    centroids: list[list[int]]
    popped: list[float]
    drift: list[float]


def usable(embedding: Column, size: int) -> Column:
    """Whether a vector takes part: `size` components, none null or non-finite."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(embedding) == size) & ~bad, F.lit(False))


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors (n x d) to integer centroids (k x d)."""
    largest = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if vectors.shape[1] * (2 * largest) ** 2 < 1 << 52:  # whole numbers below 2^52 are exact in double precision
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]).astype(np.int64)
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for j, centroid in enumerate(centroids.astype(np.int64)):
        gap = vectors.astype(np.int64) - centroid
        out[:, j] = (gap * gap).sum(axis=1)
    return out


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, size)


def _assign(vectors: np.ndarray, centroids: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector (ties: the smaller number), and the accumulated drift at which its gap is due."""
    squared = squared_distances(vectors, centroids)
    own = squared.argmin(axis=1).astype(np.int32)
    if len(centroids) == 1:
        return own, np.full(len(own), math.inf)
    near = np.sqrt(np.partition(squared, 1, axis=1)[:, :2].astype(np.float64))
    gap, base = near[:, 1] - near[:, 0], drift[own]
    slack = (near.sum(axis=1) + base + 1) * 2.0**-40  # more than all roundings together
    return own, base + np.maximum(gap - slack, 0)


def _scan(state: State, size: int):
    """Exact assignment of every row that arrives; `was` becomes the cluster before."""
    centroids, drift = np.array(state.centroids, np.int64), np.array(state.drift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own, due = _assign(_vectors(batch.column("vector"), size), centroids, drift)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("vector"), pa.array(own), batch.column("cluster"), pa.array(due)],
                    names=["vec_id", "vector", "cluster", "was", "due"],
                )

    return run


def _moves(size: int):
    """For each cluster what its sum and count gain and lose by the rows that changed cluster; one row a task and cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch.column("vector"), size).astype(np.int64)
            wide = np.concatenate([vectors, np.ones((len(vectors), 1), np.int64)], axis=1)
            for name, sign in (("cluster", 1), ("was", -1)):
                clusters = batch.column(name).to_numpy()
                for c in np.unique(clusters[clusters >= 0]).tolist():
                    sums[c] = sums.get(c, 0) + sign * wide[clusters == c].sum(axis=0)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], names=["cluster", "gains"]
            )

    return run


def _whole_numbers(scale: int, size: int):
    """Vectors of doubles as 4-byte integers floor(scale * x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.floor(batch.column("embedding").flatten().to_numpy(zero_copy_only=False) * float(scale))
            if len(flat) and np.abs(flat).max() > LARGEST:
                raise ValueError(f"a component is beyond {LARGEST} / {scale}: its squared distances don't fit in a long")
            packed = flat.astype("<i4").reshape(-1, size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([row.tobytes() for row in packed], pa.binary()), pa.array(np.full(len(packed), -1, np.int32))],
                names=["vec_id", "vector", "cluster"],
            )

    return run


def _between(low: list[float], high: list[float] | None) -> Column:
    """Rows due from `low` on, and before `high`, of their cluster; ranges of (cluster, due), which the scan prunes by."""
    found = F.lit(False)
    for c, value in enumerate(low):
        own = (F.col("cluster") == c) & (F.col("due") >= F.lit(value))
        found = found | (own if high is None else own & (F.col("due") < F.lit(high[c])))
    return found


def _moved(state: State, centroids: list[list[int]]) -> State:
    """The state after centroids moved: an own drift and the largest of the others' add to each cluster's."""
    steps = []
    for old, new in zip(state.centroids, centroids):
        squared = sum((a - b) ** 2 for a, b in zip(old, new))
        steps.append(math.sqrt(squared) * (1 + 2.0**-50) if squared else 0.0)
    others = [max((s for j, s in enumerate(steps) if j != c), default=0.0) for c in range(len(steps))]
    return State(centroids, state.drift, [math.fsum(x) for x in zip(state.drift, steps, others)])


class _Heaps:
    """All vectors in tables sorted by cluster and due value, and the sums of the clusters."""

    def __init__(self, vectors: DataFrame, centroids: list[list[int]], size: int):
        self.size = size
        self.state = State(centroids, [0.0] * len(centroids), [0.0] * len(centroids))
        self.sums = [[0] * (size + 1) for _ in centroids]
        self.tables: list[Saved] = [self._written(vectors.mapInArrow(_scan(self.state, size), HELD))]
        self._add_up(self.tables[0].df)
        self.rows = sum(s[-1] for s in self.sums)
        self.scanned = [self.rows]  # vectors scanned by each assignment

    @staticmethod
    def _written(df: DataFrame) -> Saved:
        return Saved(df.sortWithinPartitions("cluster", "due"))

    def _add_up(self, df: DataFrame) -> None:
        """Add the moves of a table's rows to the sums: one row per cluster and component reaches the driver."""
        parts = df.where("cluster <> was").select("vector", "cluster", "was").mapInArrow(_moves(self.size), "cluster int, gains array<long>")
        gains = parts.select("cluster", F.posexplode("gains")).groupBy("cluster", "pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("gain"))
        for cluster, pos, gain in gains.collect():
            self.sums[cluster][pos] += int(gain)

    def _all(self, condition: Column) -> DataFrame:
        found = self.tables[0].df.where(condition)
        for table in self.tables[1:]:
            found = found.union(table.df.where(condition))
        return found

    def live(self) -> DataFrame:
        """Every vector once, as last put back: values below the drift at the last pop were popped by it or before."""
        return self._all(_between(self.state.popped, None))

    def update(self) -> None:
        """Replace every centroid that has vectors by the floor of their mean."""
        means = [[v // s[-1] for v in s[:-1]] if s[-1] else c for s, c in zip(self.sums, self.state.centroids)]
        self.state = _moved(self.state, means)

    def pop(self) -> None:
        """Scan the vectors whose gap has expired, and put them back."""
        now = self.state
        if now.drift == now.popped:  # no centroid has moved
            self.scanned.append(0)
            return
        due = _between(now.popped, now.drift)
        n = self._all(due).count()
        self.scanned.append(n)
        table = None
        if n:
            back = self._all(due).drop("was").mapInArrow(_scan(now, self.size), HELD)
            table = self._written(back)
            self._add_up(table.df)
        if n > COMPACT * self.rows:
            # Most tables' rows are spent: the rest joins the new table, and the old ones go.
            rest = self._all(_between(now.drift, None))
            rest = Saved(rest.withColumn("was", F.col("cluster")).sortWithinPartitions("cluster", "due")) if n < self.rows else None
            for old in self.tables:
                old.drop()
            self.tables = [t for t in (table, rest) if t]
        elif table:
            self.tables.append(table)
        self.state = State(now.centroids, now.drift, now.drift)


def first_centroids(vectors: DataFrame, clusters: int, salt: str) -> list[bytes]:
    """The vectors with the smallest SHA-256 of salt and id; equal ids by their components."""
    hashed = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = vectors.select("vector", hashed.alias("hash")).orderBy("hash", "vector").limit(clusters)
    return [bytes(r.vector) for r in chosen.orderBy("hash", "vector").collect()]


def _distances(centroids: list[list[int]], size: int):
    own = np.array(centroids, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                squared = squared_distances(_vectors(batch.column("vector"), size), own)
                found = squared[np.arange(batch.num_rows), batch.column("cluster").to_numpy()]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("cluster"), pa.array(found)], names=["vec_id", "cluster", "distance"])

    return run


def cluster_vectors(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, salt: str = SALT,
    id_column: str = "vec_id", vector_column: str = "embedding", report: dict | None = None,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part.

    Components become integers floor(scale * x), all arithmetic is exact: the result is that of `rounds` full rounds of nearest
    centroid (ties: the smaller number) and floor of the mean, and one more assignment. Centroids and their
    sums (clusters x components) are all that the driver holds; sums change by the vectors that move only. A round
    reads the vectors whose gap expired. No vector is shuffled, so a hot cluster is no larger task.

    Vectors that are null, of another size or with null or non-finite components are left out. With fewer vectors
    than clusters each starts a centroid. Equal vectors and ids are rows of their own; a null id hashes as the salt alone.
    Components beyond 2^27 after scaling raise an error, since their distances don't fit in a long. An empty
    table gives an empty result, other columns are not read. `report["scanned"]` gets the vectors scanned by each assignment.
    """
    small_batches(vectors.sparkSession)
    raw = F.col(vector_column).cast("array<double>")
    own = vectors.select(F.col(id_column).cast("long").alias("vec_id"), raw.alias("embedding")).where(usable(F.col("embedding"), size))
    packed = save(own.mapInArrow(_whole_numbers(scale, size), "vec_id long, vector binary, cluster int"))
    start = [np.frombuffer(v, "<i4").tolist() for v in first_centroids(packed, clusters, salt)]
    shape = "vec_id long, cluster int, distance long"
    if not start:
        empty = packed.select("vec_id", "cluster", F.lit(0).cast("long").alias("distance"))
        zero = F.lit(0).cast("long")
        return empty.select("*", zero.alias("cluster_inertia"), zero.alias("inertia"), F.lit("").alias("centroid_sha256"))
    heaps = _Heaps(packed, start, size)
    for _ in range(rounds):
        heaps.update()
        heaps.pop()
    if report is not None:
        report["scanned"] = heaps.scanned
    centroids = heaps.state.centroids
    placed = save(heaps.live().select("vec_id", "vector", "cluster").mapInArrow(_distances(centroids, size), shape))
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()  # one row per cluster
    of_cluster = {r.cluster: int(r["sum"]) for r in sums}
    whole = sum(of_cluster.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertias = F.array(*(F.lit(of_cluster.get(c, 0)).cast("long") for c in range(len(centroids))))
    return placed.select(
        "vec_id", "cluster", "distance", F.get(inertias, F.col("cluster")).alias("cluster_inertia"), F.lit(whole).cast("long").alias("inertia"),
        F.get(F.array(*map(F.lit, digests)), F.col("cluster")).alias("centroid_sha256"),
    )
