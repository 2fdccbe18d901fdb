"""BPE encoding with a segment tree over adjacent pair ranks, and decoding.

A tokenizer file (JSON of the tokenizers library) is loaded once per Python worker. Texts are cut at
white space; each distinct chunk is normalised, cut into words and merged once per worker.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paneloom.llm.tables import small_batches, texts_of

# White space of Unicode, as the tokenizer file's patterns see it (fixed value).
CHUNK = re.compile("[^\t\n\x0b\x0c\r \x85\xa0  -     　]+")
# Up to here every character is its own NFC form and Python lower-cases as the library does.
BEYOND_LATIN = re.compile("[^\x00-\u024f]")
NO_RANK = 1 << 60
CACHED_CHUNKS = 400_000  # of a worker; a full cache is emptied, which costs time only


def byte_symbols() -> dict[int, str]:
    """The symbol of each byte in byte-level vocabularies: itself if it prints, else from 256 upwards."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


def merge_symbols(symbols: list[str], merges: dict[tuple[str, str], tuple[int, str]]) -> list[str]:
    """Apply merges until no adjacent pair has a rank: always the lowest rank, the leftmost on ties.

    Leaf i of the tree holds the rank of (symbol i, next living symbol) and i, as one number, so
    the root's minimum is the next merge; a merge changes three leaves, each in logarithmic time.
    """
    count = len(symbols)
    if count < 2:
        return symbols
    width = 1 << (count - 1).bit_length()
    tree = [NO_RANK] * (2 * width)
    symbols = list(symbols)
    rank = merges.get
    for i in range(count - 1):
        found = rank((symbols[i], symbols[i + 1]))
        if found:
            tree[width + i] = found[0] * width + i
    for node in range(width - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    after = list(range(1, count + 1))
    before = list(range(-1, count - 1))

    def put(leaf: int, value: int) -> None:
        node = width + leaf
        tree[node] = value
        while node > 1:
            other = tree[node ^ 1]
            node >>= 1
            low = value if value < other else other
            if tree[node] == low:
                return
            tree[node] = value = low

    while tree[1] < NO_RANK:
        at = tree[1] % width
        gone = after[at]
        symbols[at] = rank((symbols[at], symbols[gone]))[1]
        symbols[gone] = ""
        after[at] = following = after[gone]
        put(gone, NO_RANK)
        if following < count:
            before[following] = at
            found = rank((symbols[at], symbols[following]))
            put(at, found[0] * width + at if found else NO_RANK)
        else:
            put(at, NO_RANK)
        previous = before[at]
        if previous >= 0:
            found = rank((symbols[previous], symbols[at]))
            put(previous, found[0] * width + previous if found else NO_RANK)
    return [s for s in symbols if s]


class Codec:
    """Encoder and decoder of one tokenizer file whose words never span white space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        if model["type"] != "BPE" or described["decoder"] is not None or model["unk_token"] is not None:
            raise ValueError(f"{path}: a BPE file without decoder and unknown token is needed")
        split, to_bytes = described["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in described["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or not split["invert"] or to_bytes["use_regex"] or to_bytes["add_prefix_space"]:
            raise ValueError(f"{path}: another normalizer or pre-tokenizer than this codec knows")
        self._library = Tokenizer.from_file(path)
        self._pattern = regex.compile(split["pattern"]["Regex"])
        self._byte_symbols = byte_symbols()
        self._ids = model["vocab"]
        self._suffix = model["end_of_word_suffix"] or ""
        self._merges: dict[tuple[str, str], tuple[int, str]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self._merges[left, right] = (rank, left + right)
        self._special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self._special, key=len, reverse=True))) + ")") if self._special else None
        size = max([*self._ids.values(), *self._special.values()]) + 1
        self._tokens = [""] * size
        for token, number in [*self._ids.items(), *self._special.items()]:
            self._tokens[number] = token
        self._words: dict[str, bytes] = {}
        self._chunks: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        """Ids of one word of the pre-tokenizer, as little-endian unsigned 32-bit integers."""
        found = self._words.get(word)
        if found is None:
            symbols = list(word)
            symbols[-1] += self._suffix
            ids = [self._ids[s] for s in merge_symbols(symbols, self._merges) if s in self._ids]
            found = np.array(ids, dtype="<u4").tobytes()
            if len(self._words) >= CACHED_CHUNKS:
                self._words.clear()
            self._words[word] = found
        return found

    def _chunk(self, chunk: str) -> bytes:
        """Ids of normalised text without white space."""
        if BEYOND_LATIN.search(chunk):
            words = [word for word, _ in self._library.pre_tokenizer.pre_tokenize_str(chunk)]
        elif chunk.isascii() and chunk.isprintable():
            words = self._pattern.findall(chunk)
        else:
            words = [w.encode().decode("latin-1").translate(self._byte_symbols) for w in self._pattern.findall(chunk)]
        found = b"".join([self._word(word) for word in words])
        if len(self._chunks) >= CACHED_CHUNKS:
            self._chunks.clear()
        if len(chunk) <= 256:
            self._chunks[chunk] = found
        return found

    def _plain(self, text: str) -> bytes:
        """Ids of text without special tokens."""
        normal = self._library.normalizer.normalize_str(text) if BEYOND_LATIN.search(text) else text.lower()
        known, new = self._chunks.get, self._chunk
        return b"".join([known(c) or new(c) for c in CHUNK.findall(normal)])

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not self._cut or not self._cut.search(text):
            return self._plain(text)
        return b"".join(
            self._special[part].to_bytes(4, "little") if part in self._special else self._plain(part)
            for part in self._cut.split(text)
        )

    def decode(self, ids: bytes) -> str:
        """The text the file's decoder gives: tokens joined by spaces, special ones kept."""
        return " ".join(map(self._tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _per_text(path: str, row: Callable[[Codec, str], tuple], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            rows = [row(own, t) for t in texts_of(batch.column("text"))]
            columns = list(zip(*rows)) if rows else [()] * (len(schema) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:]))], schema=schema
            )

    return run


def _frame(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def _arrow(*fields: tuple[str, pa.DataType]) -> pa.Schema:
    return pa.schema([("doc_id", pa.int64()), *fields])


def encode_texts(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every whole text; null and empty texts have no ids. No shuffle."""
    schema = _arrow(("ids", pa.list_(pa.int32())))
    run = _per_text(path, lambda own, text: (np.frombuffer(own.encode(text), dtype="<u4").astype(np.int32),), schema)
    return _frame(docs, id_column, text_column).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null or empty ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts = [own.decode(np.array(ids or [], dtype="<u4").tobytes()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    small_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def bpe_digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document the number of ids, the SHA-256 of the ids and of the text decoded from them.

    Whole texts are encoded and decoded in one narrow pass: no shuffle, memory bounded by the
    longest text, the caches and one Arrow batch. Null texts count as empty: 0 ids and the digests
    of no bytes. Repeated rows give repeated results, an empty table an empty one; other columns
    are not read.
    """

    def row(own: Codec, text: str) -> tuple[int, str, str]:
        ids = own.encode(text)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(own.decode(ids).encode()).hexdigest()

    schema = _arrow(("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()))
    return _frame(docs, id_column, text_column).mapInArrow(
        _per_text(path, row, schema), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
