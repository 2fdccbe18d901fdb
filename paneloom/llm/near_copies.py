"""Near copies: groups of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from two generators. SimHash: texts meet whose fingerprints are linked at four or fewer differing bits, found
through the anchors of the covering code. At a similarity of 0.8 fingerprints differ in about ten bits, so most such pairs are found by
the second: bands of minima (MinHash), where texts meet if all minima of a band agree, which at 0.8 happens in at least one
of the bands with probability 0.9998. Candidates of either kind link only if the similarity of their shingle sets says so.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.llm.components import connected_components
from paneloom.llm.simhash import linked_prints, print_of, shingle_digests
from paneloom.llm.tables import complete_runs, fresh, save, small_batches, texts_of

WORDS, PERCENT, SEED = 5, 80, 42
BANDS, ROWS = 16, 4
BLOCK = 256  # members of a band's list that one task compares with another such block
SALTS = np.random.default_rng(SEED).integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64)[:, None]
MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def sketch(digests: np.ndarray) -> list[int]:
    """The digest of the set of shingles, its SimHash, then one key for each band, as signed longs."""
    hashes = np.unique(digests)
    low = np.full(BANDS * ROWS, ~np.uint64(0))
    for start in range(0, len(hashes), 1 << 13):
        mixed = (hashes[None, start : start + (1 << 13)] ^ SALTS) * MIX[0]
        mixed = (mixed ^ mixed >> np.uint64(32)) * MIX[1]
        low = np.minimum(low, mixed.min(axis=1))
    keys = [xxhash.xxh64_intdigest(band.tobytes(), number) for number, band in enumerate(low.reshape(BANDS, ROWS))]
    return np.array([xxhash.xxh64_intdigest(hashes.tobytes()), print_of(hashes), *keys], dtype=np.uint64).view(np.int64).tolist()


def _sketches(words: int):
    """A column function from text to its sketch."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([sketch(shingle_digests(t, words)) for t in texts_of(texts)], pa.list_(pa.int64()))

    return F.arrow_udf(run, "array<long>")


def _shingles(words: int):
    """A column function from text to its shingles, 32 bits each."""

    def run(texts: pa.Array) -> pa.Array:
        sets = [np.unique(shingle_digests(t, words).astype(np.uint32)).view(np.int32) for t in texts_of(texts)]
        return pa.array(sets, pa.list_(pa.int32()))

    return F.arrow_udf(run, "array<int>")


def _alike(one: Column, other: Column, percent: int) -> Column:
    return F.size(F.array_intersect(one, other)) * (100 + percent) >= (F.size(one) + F.size(other)) * percent


def _compare(percent: int):
    """Links between the strays (side 0) and all members (side 1) of each unit that have other labels."""

    def one(part: pa.Table) -> pa.RecordBatch:
        sides, cls, label = (part.column(c).to_numpy() for c in ("side", "cls", "label"))
        sets = part.column("shingles").to_pylist()
        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if len(left) and len(right):
            sizes = np.array([len(sets[i]) for i in right])
            values, at = np.unique(np.concatenate([np.array(sets[i], np.int32) for i in right]), return_inverse=True)
            starts = np.cumsum(sizes) - sizes
            for i in left:
                mine = np.isin(values, np.array(sets[i], np.int32), assume_unique=True)
                shared = np.add.reduceat(mine[at].astype(np.int64), starts)
                near = right[(shared * (100 + percent) >= (sizes + len(sets[i])) * percent) & (label[right] != label[i])]
                found.append((np.full(len(near), cls[i]), cls[near]))
        a, b = (np.concatenate(x) for x in zip(*found))
        return pa.RecordBatch.from_pydict({"a": a, "b": b})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in complete_runs(batches, "unit", 1 << 62):
            names = [table.column(c).to_numpy() for c in ("unit", "key", "l", "r")]
            edges = np.flatnonzero(np.any([np.diff(x) != 0 for x in names], axis=0)) + 1
            for begin, end in zip(np.r_[0, edges], np.r_[edges, table.num_rows]):
                yield one(table.slice(begin, end - begin))

    return run


def _stray_links(labelled: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of members of a list that its leader's group has not reached, with all members of the list."""
    stray = F.col("label") != F.col("main")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    totals = labelled.groupBy("key").agg(blocks(F.count_if(stray)).alias("ls"), blocks(F.count(F.lit(1))).alias("rs")).where("ls > 0")
    open_lists = save(labelled.join(totals, "key").join(sets, "cls"))
    own = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    other = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = open_lists.where(stray).select("key", own("ls").alias("l"), other("rs").alias("r"), F.lit(0).alias("side"), "cls", "label", "shingles")
    right = open_lists.select("key", other("ls").alias("l"), own("rs").alias("r"), F.lit(1).alias("side"), "cls", "label", "shingles")
    dealt = left.union(right).withColumn("unit", F.xxhash64("key", "l", "r"))
    return dealt.repartition("unit").sortWithinPartitions("unit", "key", "l", "r").mapInArrow(_compare(percent), "a long, b long")


def _with_families(classes: DataFrame) -> DataFrame:
    """`classes` (cls, print, keys) with one more key: that of all fingerprints which SimHash links reach."""
    families = connected_components(linked_prints(classes)).toDF("print", "family")
    family = F.xxhash64(F.coalesce("family", "print"), F.lit(BANDS))
    return classes.join(families, "print", "left").select("cls", F.concat("keys", F.array(family)).alias("keys"))


def copy_links(
    classes: DataFrame, texts: Callable[[DataFrame], DataFrame], words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """(a, b) links whose components are those of all candidate pairs that are alike.

    `classes` has cls and keys; `texts` gives cls and text of a table of cls, those that meet another. Each list is first compared with one of its members, another
    one in each band; only what that leaves apart is compared pair by pair, so a large group of near copies costs one row a member and band.
    """
    entries = classes.select("cls", F.explode("keys").alias("key"))
    leader = F.min(F.struct(F.xxhash64("cls", "key").alias("order"), F.col("cls").alias("leader")))
    lists = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("cls")).alias("sign"), leader.alias("led"))
    # Bands in which the same texts meet are compared once.
    once = lists.where("n > 1").groupBy("n", "sign").agg(F.min(F.struct("key", "led.leader")).alias("list"))
    members = save(entries.join(once.select("list.*"), "key"))
    met = members.select("cls").distinct()
    sets = save(texts(met).select("cls", _shingles(words)(F.col("text")).alias("shingles")))
    star = members.where("cls <> leader").select("cls", "leader").distinct()
    both = star.join(sets.toDF("cls", "mine"), "cls").join(sets.toDF("leader", "theirs"), "leader")
    near = save(both.where(_alike(F.col("mine"), F.col("theirs"), percent)).select(F.col("cls").alias("a"), F.col("leader").alias("b")))
    parts = save(connected_components(near))
    labels = members.join(parts.toDF("cls", "label"), "cls", "left").join(parts.toDF("leader", "main"), "leader", "left")
    labelled = save(labels.withColumns({"label": F.coalesce("label", "cls"), "main": F.coalesce("main", "leader")}))
    return near.union(_stray_links(labelled, sets, percent))


def keep_one_of_copies(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each group of near copies, all columns as they are: the smallest id, of equal ids any one.

    Rows with a null id come last. Texts with equal shingles, and all texts without words (null, empty or of white space), are
    copies; a text of fewer words than a shingle is one shingle. Long texts are sketched whole, and repeated rows are copies. An empty
    table gives an empty result, columns of any name stay as they are.
    """
    small_batches(docs.sparkSession)
    row, made = fresh(docs, "row_number"), fresh(docs, "sketch")
    wide = save(docs.withColumn(row, F.monotonically_increasing_id()).withColumn(made, _sketches(words)(F.col(text_column))))
    first = F.struct(F.col(id_column).isNull().alias("last"), F.col(id_column).alias("id"), F.col(row).alias("row"))
    keys = F.first(F.slice(made, 3, BANDS)).alias("keys")
    classes = save(wide.groupBy(F.col(made)[0].alias("cls")).agg(F.min(first).alias("low"), F.first(F.col(made)[1]).alias("print"), keys))
    lowest = classes.select("cls", F.col("low.row").alias(row))
    # Ids are matched first, so that a text is shuffled once at most.
    texts = lambda met: wide.select(row, F.col(text_column).alias("text")).join(lowest.join(met, "cls", "left_semi"), row).select("cls", "text")
    listed = save(_with_families(classes.select("cls", "print", "keys")))
    parts = connected_components(copy_links(listed, texts, words, percent)).withColumnRenamed("node", "cls")
    labelled = classes.join(parts, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    chosen = labelled.groupBy("component").agg(F.min("low").alias("low")).select(F.col("low.row").alias(row))
    return wide.join(chosen, row, "left_semi").select(*docs.columns)
