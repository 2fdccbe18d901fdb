"""SimHash near-duplicates found through the anchors of a covering code.

The anchors are the words of the perfect Golay code of length 23 on each of two blocks of 23 bits
(the other 18 bits are free), so every fingerprint is within 3 bits of an anchor in each block. Take
two fingerprints that differ in at most four bits and a point midway: it differs from either in at
most two bits, spread over the blocks, and from its own anchor in at most three bits a block. Hence both are
within the covering radius of that anchor plus half the threshold (two bits, counted over both
blocks). Each fingerprint is replicated to every anchor within that distance (61 on average), and
fingerprints are compared at the anchors they share. No link is lost.
"""

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.llm.components import connected_components, local_star
from paneloom.llm.tables import complete_runs, fresh, save, small_batches, texts_of, unsigned_hex

GENERATOR = 0b101011100011  # of the Golay code of length 23 (fixed value)
BLOCK, CHECK_BITS, RADIUS = 23, 11, 3
THRESHOLD, SLACK = 4, 2  # differing bits that link; half of it for each side
SHINGLE_WORDS, SEED = 4, 42
SMALL_RUN = 48  # up to here all pairs of an anchor are compared at once
RUN_ROWS = 100_000  # fingerprints of one anchor that one task compares; more are dealt out in tiles


def shingle_digests(text: str, words: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of the shingles of A-Z-lowered words, repeats included; a shorter text is one shingle, none without words."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    last = max(1, len(found) - words + 1) if found else 0
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(b" ".join(found[i : i + words]), SEED) for i in range(last)), dtype="<u8", count=last)


def print_of(digests: np.ndarray) -> int:
    """64-bit SimHash of shingle digests; 0 if there are none."""
    votes = np.zeros(64, dtype=np.int64)
    for start in range(0, len(digests), 1 << 15):
        part = digests[start : start + (1 << 15)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(digests), bitorder="little").tobytes(), "little")


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the shingles of A-Z-lowered words; 0 without words."""
    return print_of(shingle_digests(text, words))


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, words) for t in texts_of(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return run


def _print_column(words: int):
    """A column function from text to the fingerprint as a signed long."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t, words) for t in texts_of(texts)], dtype=np.uint64).view(np.int64))

    return F.arrow_udf(run, "long")


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of 12-bit halves of a block, and the error patterns of weight up to 5 by syndrome.

    Returns (low, high, first, patterns): the syndrome of a block is low[its lower 12 bits] xor
    high[its upper 11]; patterns[first[s, k]:first[s, k + 1]] lead to anchors k bits beyond the radius.
    """

    def remainder(value: int) -> int:
        for bit in range(BLOCK - 1, CHECK_BITS - 1, -1):
            if value >> bit & 1:
                value ^= GENERATOR << (bit - CHECK_BITS)
        return value

    unit = [remainder(1 << i) for i in range(BLOCK)]
    low, high = np.zeros(1 << 12, np.int64), np.zeros(1 << 11, np.int64)
    for table, shift in ((low, 0), (high, 12)):
        for i in range(len(table).bit_length() - 1):
            table[1 << i : 2 << i] = table[: 1 << i] ^ unit[shift + i]
    errors = [(sum(1 << b for b in bits), max(0, n - RADIUS)) for n in range(RADIUS + SLACK + 1) for bits in combinations(range(BLOCK), n)]
    pattern = np.array([e for e, _ in errors], np.int64)
    slot = (low[pattern & 4095] ^ high[pattern >> 12]) * (SLACK + 1) + np.array([x for _, x in errors])
    order = np.argsort(slot, kind="stable")
    first = np.searchsorted(slot[order], np.arange((1 << CHECK_BITS) * (SLACK + 1) + 1))
    return low, high, first, pattern[order]


def _spread(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers repeated once for each element of values[start:end], and those elements."""
    sizes = ends - starts
    rows = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return rows, values[starts[rows] + within]


def anchors_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) for every anchor within reach of each fingerprint (uint64); anchors are 46-bit numbers."""
    low, high, first, patterns = _golay()
    mask = (1 << BLOCK) - 1
    blocks = [(prints & np.uint64(mask)).astype(np.int64), (prints >> np.uint64(BLOCK) & np.uint64(mask)).astype(np.int64)]
    bases = [(low[b & 4095] ^ high[b >> 12]) * (SLACK + 1) for b in blocks]
    rows, anchors = [], []
    for extra in range(SLACK + 1):
        one, error = _spread(patterns, first[bases[0] + extra], first[bases[0] + extra + 1])
        left = blocks[0][one] ^ error
        two, error = _spread(patterns, first[bases[1][one]], first[bases[1][one] + SLACK + 1 - extra])
        rows.append(one[two])
        anchors.append(left[two] << BLOCK | (blocks[1][one[two]] ^ error))
    return np.concatenate(rows), np.concatenate(anchors)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("print").to_numpy()
        for start in range(0, len(prints), 4096):
            part = prints[start : start + 4096]
            rows, anchors = anchors_of(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(part[rows])], names=["anchor", "print"])


def _grow(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the groups of one run: breadth first, each fingerprint compared with those not yet reached."""
    rest, found = prints.view(np.uint64), ([], [])
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            near, front = front[:256], front[256:]
            tile = max(1, (1 << 24) // len(near))
            keep, reached = [], []
            for start in range(0, len(rest), tile):
                part = rest[start : start + tile]
                close = np.bitwise_count(near[:, None] ^ part[None, :]) <= THRESHOLD
                hit = close.any(axis=0)
                found[0].append(near[close[:, hit].argmax(axis=0)])
                found[1].append(part[hit])
                reached.append(part[hit])
                keep.append(part[~hit])
            rest, front = np.concatenate(keep), np.concatenate([front, *reached])
    return tuple(np.concatenate(x).view(np.int64) if x else np.zeros(0, np.int64) for x in found)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links at each anchor (`hot` false); fingerprints of an anchor with too many for a task come back as they are."""
    names = ["hot", "a", "b"]

    def out(hot: bool, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), hot)), pa.array(a), pa.array(b)], names=names)

    overfull = -1
    links: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for table in complete_runs(batches, "anchor", RUN_ROWS):
        anchors, prints = table.column("anchor").to_numpy(), table.column("print").to_numpy()
        edges = np.flatnonzero(np.diff(anchors)) + 1
        starts, ends = np.r_[0, edges], np.r_[edges, len(anchors)]
        sizes = ends - starts
        hot = (sizes > RUN_ROWS) | (anchors[starts] == overfull)
        for i in np.flatnonzero(hot):
            overfull = anchors[starts[i]]
            yield out(True, anchors[starts[i] : ends[i]], prints[starts[i] : ends[i]])
        for i in np.flatnonzero((sizes > SMALL_RUN) & ~hot):
            links.append(_grow(prints[starts[i] : ends[i]]))
        few = np.repeat((sizes <= SMALL_RUN) & ~hot, sizes)
        plain, run, bits = prints[few], anchors[few], prints[few].view(np.uint64)
        for step in range(1, min(SMALL_RUN, len(plain))):
            same = run[step:] == run[:-step]
            if not same.any():
                break
            close = np.flatnonzero(same & (np.bitwise_count(bits[step:] ^ bits[:-step]) <= THRESHOLD))
            links.append((plain[close + step], plain[close]))
        held += sum(len(a) for a, _ in links[-SMALL_RUN:])
        if held > 1 << 20:
            links, held = [local_star(*map(np.concatenate, zip(*links)))], 0
            yield out(False, *links.pop())
    if links:
        yield out(False, *local_star(*map(np.concatenate, zip(*links))))


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within a tile of an overfull anchor; a tile holds two of its blocks."""
    held: list[pa.Table] = []

    def done() -> Iterator[pa.RecordBatch]:
        prints = pa.concat_tables(held).column("print").to_numpy()
        a, b = local_star(*_grow(prints))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for table in complete_runs(batches, "tile", 1 << 62):
        tiles = table.column("tile").to_numpy()
        edges = np.flatnonzero(np.diff(tiles)) + 1
        for start, end in zip(np.r_[0, edges], np.r_[edges, len(tiles)]):
            held = [table.slice(start, end - start)]
            yield from done()


def _overfull_links(members: DataFrame) -> DataFrame:
    """Links at anchors with over RUN_ROWS fingerprints: blocks of half that size, every pair of blocks a tile."""
    counts = members.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / (RUN_ROWS // 2)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("b"), "blocks").cast("int")
    pairs = members.join(counts, "a").withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tile = F.xxhash64("a", F.least("own", "other"), F.greatest("own", "other"))
    dealt = pairs.select(tile.alias("tile"), F.col("b").alias("print")).repartition("tile").sortWithinPartitions("tile")
    return dealt.mapInArrow(_tiles, "a long, b long")


def fingerprint_table(docs: DataFrame, words: int = SHINGLE_WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, print as signed long) of every row; one narrow pass over the texts."""
    small_batches(docs.sparkSession)
    light = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return light.mapInArrow(_fingerprints(words), "doc_id long, print long")


def linked_prints(prints: DataFrame) -> DataFrame:
    """(a, b) links whose components are those of all pairs of `prints` within the threshold."""
    near = prints.select("print").distinct().mapInArrow(_replicate, "anchor long, print long")
    # One shuffle of 16 bytes a replica; a partition holds many anchors, an overfull anchor is dealt again.
    found = save(near.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_compare, "hot boolean, a long, b long"))
    return found.where("NOT hot").select("a", "b").union(_overfull_links(found.where("hot").select("a", "b")))


def _with_components(lowest: DataFrame) -> DataFrame:
    """Adds `component`, one of the fingerprints reachable, to a table with one row per `print`."""
    parts = connected_components(linked_prints(lowest)).withColumnRenamed("node", "print")
    return lowest.join(parts, "print", "left").withColumn("component", F.coalesce("component", "print"))


def simhash_groups(docs: DataFrame, words: int = SHINGLE_WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Equal fingerprints collapse to one before anything is compared, so copies, however many, cost
    one row per partition. component_id is the smallest doc_id reachable over links of at most four
    differing bits. Null and empty texts, and texts of white space, have fingerprint zero and are
    linked like any other. Repeated rows come back repeated; rows with a null doc_id take part, and
    a component of such rows only has a null component_id. An empty table gives an empty result;
    other columns are not read. Labels of fingerprints stay in Spark throughout.
    """
    prints = save(fingerprint_table(docs, words, id_column, text_column))
    lowest = save(prints.groupBy("print").agg(F.min("doc_id").alias("low")))
    labelled = _with_components(lowest)
    ids = labelled.groupBy("component").agg(F.min("low").alias("component_id"))
    of_print = save(labelled.join(ids, "component").select("print", "component_id"))
    joined = prints.join(of_print, "print")
    return joined.select("doc_id", unsigned_hex(F.col("print")).alias("fingerprint"), "component_id")


def keep_one_of_group(docs: DataFrame, words: int = SHINGLE_WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each group of linked fingerprints, all columns as they are: the smallest id, of equal ids any one.

    Rows with a null id come last. Rows get a number of their own when they are written with their
    fingerprints, so rows that repeat an id are told apart.
    """
    small_batches(docs.sparkSession)
    row, prints = fresh(docs, "row_number"), fresh(docs, "print")
    numbered = docs.withColumn(row, F.monotonically_increasing_id()).withColumn(prints, _print_column(words)(F.col(text_column)))
    wide = save(numbered)
    first = F.struct(F.col(id_column).isNull().alias("last"), F.col(id_column).alias("id"), F.col(row).alias("row"))
    lowest = save(wide.groupBy(F.col(prints).alias("print")).agg(F.min(first).alias("low")))
    chosen = _with_components(lowest).groupBy("component").agg(F.min("low").alias("low")).select(F.col("low.row").alias(row))
    return wide.join(chosen, row, "left_semi").select(*docs.columns)
