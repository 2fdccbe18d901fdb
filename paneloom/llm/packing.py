"""Packing token sequences by linear grouping.

Everything that is decided at once works on the histogram of piece lengths, which has at most as many
entries as a sequence has tokens, however large the corpus is. Pieces are then matched to the places
by their rank among the pieces of the same length, which comes from counts per partition.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.llm.bpe import byte_symbols
from paneloom.llm.tables import offsets_of, save, small_batches, texts_of

CAPACITY = 1024
END_ID = 2
GROUPS = 128  # size classes of the large pieces
SMALL = 192  # shorter pieces are packed last, by best fit
# The split pattern of byte-level BPE files with use_regex (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> tuple[tiktoken.Encoding, frozenset[str]]:
    """The encoder of a byte-level BPE JSON file, and its special tokens (found in texts, as the file's library does)."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    kind = described["pre_tokenizer"]
    if described["normalizer"] or kind["type"] != "ByteLevel" or kind["add_prefix_space"] or not kind["use_regex"]:
        raise ValueError(f"{path}: a byte-level BPE file without normalizer or prefix space is needed")
    byte_of = {symbol: number for number, symbol in byte_symbols().items()}
    special = {t["content"]: t["id"] for t in described["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): rank for token, rank in described["model"]["vocab"].items() if token not in special}
    encoding = tiktoken.Encoding("from-file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
    return encoding, frozenset(special)


def _pieces(path: str, capacity: int):
    """Tokenizes texts and cuts long ones; numbers the pieces of each length within the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, special = byte_encoder(path)
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            docs, rows = batch.column("doc_id").to_pylist(), []
            for doc, text in zip(docs, texts_of(batch.column("text"))):
                ids = np.array([*encoding.encode(text, allowed_special=special), END_ID], dtype="<u4")
                start, length = 0, len(ids) % capacity or min(len(ids), capacity)
                piece = 0
                while start < len(ids):
                    rows.append((doc, piece, start, length, zlib.crc32(ids[start : start + length].tobytes()), int(seen[length])))
                    seen[length] += 1
                    start, piece, length = start + length, piece + 1, capacity
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "local_rank"]
            )

    return run


def _best_pattern(sizes: np.ndarray, values: np.ndarray, limits: np.ndarray | None, capacity: int) -> np.ndarray:
    """How many of each size to put into one sequence for the greatest total value (a knapsack)."""
    best = np.zeros(capacity + 1)
    choice = np.full((len(sizes), capacity + 1), 0, dtype=np.int16)
    for i, (size, value) in enumerate(zip(sizes, values)):
        if value <= 1e-12:
            continue
        most = capacity // size if limits is None else min(capacity // size, int(limits[i]))
        base = best.copy()
        for count in range(1, most + 1):
            shifted = base[: capacity + 1 - count * size] + count * value
            better = shifted > best[count * size :] + 1e-12
            best[count * size :][better] = shifted[better]
            choice[i, count * size :][better] = count
    pattern, room = np.zeros(len(sizes), dtype=np.int64), capacity
    for i in range(len(sizes) - 1, -1, -1):
        pattern[i] = choice[i, room]
        room -= pattern[i] * sizes[i]
    return pattern


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int = CAPACITY) -> list[tuple[np.ndarray, int]]:
    """(pattern, times) covering `demand` pieces of each size in few sequences.

    The linear program over all patterns is solved by column generation; its multiplicities are
    rounded down and what remains is filled with the fullest pattern that is still wanted.
    """
    rest, plan = demand.astype(np.int64).copy(), []
    if len(sizes):
        basis = np.diag((capacity // sizes).astype(float))
        amounts = demand / (capacity // sizes)
        for _ in range(40 * len(sizes)):
            prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
            pattern = _best_pattern(sizes, prices, None, capacity)
            if pattern @ prices <= 1 + 1e-7:
                break
            direction = np.linalg.solve(basis, pattern.astype(float))
            ratios = np.where(direction > 1e-9, amounts / np.where(direction > 1e-9, direction, 1), np.inf)
            leaving = int(ratios.argmin())
            amounts = amounts - ratios[leaving] * direction
            amounts[leaving] = ratios[leaving]
            basis[:, leaving] = pattern
        for column, amount in zip(basis.T.round().astype(np.int64), amounts):
            used = column > 0
            times = min(int(amount + 1e-6), int((rest[used] // column[used]).min())) if used.any() else 0
            if times > 0:
                plan.append((column, times))
                rest = rest - column * times
    while rest.any():
        pattern = _best_pattern(sizes, sizes.astype(float), rest, capacity)
        used = pattern > 0
        times = int((rest[used] // pattern[used]).min())
        plan.append((pattern, times))
        rest = rest - pattern * times
    return plan


class Layout:
    """Where the pieces of each length go: (length, first rank, pieces, first sequence, pieces a sequence, offset)."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL):
        self.intervals: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0
        self._taken = dict.fromkeys(histogram, 0)
        self._room: list[tuple[int, int, int]] = []  # (room, first sequence, sequences)
        large = sorted(n for n in histogram if small <= n < capacity)
        if histogram.get(capacity):
            self._put(capacity, histogram[capacity], self._open(histogram[capacity]), 1, 0)
        self._large(large, histogram, capacity, groups)
        self._small([n for n in sorted(histogram, reverse=True) if n < min(small, capacity)], histogram, capacity)

    def _open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def _put(self, length: int, pieces: int, sequence: int, each: int, offset: int) -> None:
        self.intervals.append((length, self._taken[length], pieces, sequence, each, offset))
        self._taken[length] += pieces

    def _large(self, lengths: list[int], histogram: dict[int, int], capacity: int, groups: int) -> None:
        """Groups of equal cardinality, each rounded up to its longest; then the pieces themselves."""
        total = sum(histogram[n] for n in lengths)
        members: list[list[list[int]]] = []  # of a group: [length, pieces]
        each, room = max(1, -(-total // groups)), 0
        for length in lengths:
            left = histogram[length]
            while left:
                if not room:
                    members.append([])
                    room = each
                part = min(left, room)
                members[-1].append([length, part])
                left, room = left - part, room - part
        sizes = np.array([m[-1][0] for m in members], dtype=np.int64)
        demand = np.array([sum(n for _, n in m) for m in members], dtype=np.int64)
        for pattern, times in configurations(sizes, demand, capacity):
            spans = [[self._open(times), times, 0]]  # [first sequence, sequences, tokens so far]
            for group in np.flatnonzero(pattern):
                for _ in range(pattern[group]):
                    spans = self._fill(spans, members[group])
            self._room += [(capacity - used, first, count) for first, count, used in spans if used < capacity]

    def _fill(self, spans: list[list[int]], members: list[list[int]]) -> list[list[int]]:
        """One piece of the group for each sequence of the spans; spans split where lengths change."""
        out = []
        for first, count, used in spans:
            while count:
                length, left = members[-1]
                part = min(count, left)
                self._put(length, part, first, 1, used)
                out.append([first, part, used + length])
                first, count = first + part, count - part
                members[-1][1] -= part
                if not members[-1][1]:
                    members.pop()
        return out

    def _small(self, lengths: list[int], histogram: dict[int, int], capacity: int) -> None:
        """Best fit, longest first: the tightest sequences with room take as many as fit, then new ones open."""
        by_room: dict[int, list[tuple[int, int]]] = {}
        for room, first, count in self._room:
            by_room.setdefault(room, []).append((first, count))
        for length in lengths:
            left = histogram[length]
            heap: list[int] = []
            for room in by_room:
                if room >= length:
                    heappush(heap, room)
            while left:
                if not heap:
                    fits = capacity // length
                    full, over = divmod(left, fits)
                    for count, each in ((full, fits), (1 if over else 0, over)):
                        if count:
                            first = self._open(count)
                            self._put(length, count * each, first, each, 0)
                            by_room.setdefault(capacity - each * length, []).append((first, count))
                    break
                room = heap[0]
                if not by_room.get(room):
                    by_room.pop(room, None)
                    heappop(heap)
                    continue
                first, count = by_room[room].pop()
                fits = room // length
                full, over = divmod(left, fits)
                whole = min(count, full)
                for number, each in ((whole, fits), (1 if whole < count and over else 0, over)):
                    if number:
                        self._put(length, number * each, first, each, capacity - room)
                        by_room.setdefault(room - each * length, []).append((first, number))
                        first, count, left = first + number, count - number, left - number * each
                if count:
                    by_room[room].append((first, count))

    def arrays(self) -> tuple[np.ndarray, ...]:
        table = np.array(sorted(self.intervals), dtype=np.int64).reshape(-1, 6)
        return tuple(table.T)


def _place(layout: tuple[np.ndarray, ...], capacity: int):
    length_of, rank_of, _, sequence_of, each_of, offset_of = layout
    # Lengths and ranks as one sorted number: ranks stay below 2**50.
    keys = (length_of << 50) + rank_of

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (length << 50) + rank, side="right") - 1
            place = rank - rank_of[at]
            sequence = sequence_of[at] + place // each_of[at]
            offset = offset_of[at] + place % each_of[at] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    groups: int = GROUPS,
    small: int = SMALL,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and the end id; one longer than the capacity is cut into full pieces, of
    which the first may be shorter. Lengths from `small` up are grouped into `groups` classes of
    equal cardinality and rounded up to the longest of the class; a linear program over the
    classes chooses the configurations; actual pieces take the places; short pieces follow by best
    fit. The driver sees one count per length. Tokenizing is one narrow pass whose pieces (without
    ids) are written once; no text is shuffled and no key deals out rows, so hot groups of equal
    lengths or copies are harmless.

    Null texts count as empty and give one piece with the end id. Repeated rows are packed as
    often as they occur, ties are broken by input order, an empty table gives an empty result,
    other columns are not read.
    """
    small_batches(docs.sparkSession, "4m")
    light = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, local_rank long"
    pieces = save(light.mapInArrow(_pieces(path, capacity), schema).withColumn("part", F.spark_partition_id()))
    counts = save(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("pieces")))
    histogram = {r.length: r.pieces for r in counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()}
    layout = Layout(histogram, capacity, groups, small)
    # One row per input partition with its offset for each length; merged by partition, as it grows with their number.
    offsets = offsets_of(counts, ["length"], "part", "pieces", "before")
    before = offsets.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("length", "before"))).alias("before"))
    ranked = pieces.join(before.hint("merge"), "part").withColumn("rank", F.element_at("before", F.col("length")) + F.col("local_rank"))
    ranked = ranked.drop("part", "before", "local_rank")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(_place(layout.arrays(), capacity), schema)
