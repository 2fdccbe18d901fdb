"""WARC archives as seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each with whole records, and a skippable frame at its end
with the seek table (sizes of every frame), in the public seekable format. The index maps a record
to bundle, frame and place in the frame, so one record needs one ranged read and one frame.
"""

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom.llm.tables import save, shared_folder, small_batches

LEAST_SHARED = 100  # payload bytes from which equal payloads are stored once
FRAME_BYTES = 1 << 19  # records a frame, before compression
BUNDLE_BYTES = 1 << 26  # a bundle, after compression
# Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
DATE = "1970-01-01T00:00:00Z"  # pages have no time of capture
INDEX = "page_id long, bundle string, frame int, frame_start long, frame_size long, record_start long, record_size long"


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


def _record(kind: str, page_id: int | None, url: str | None, digest: str, size: int, payload: bytes, refers_to: int | None) -> bytes:
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join((url or "").split())),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "text/html"),
    ]
    if kind == "revisit":
        headers += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
            ("WARC-Payload-Length", str(size)),
        ]
    headers.append(("Content-Length", str(len(payload))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + payload + b"\r\n\r\n"


def _header(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    return dict(line.split(": ", 1) for line in lines[1:] if line)


def parse_records(frame: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and content of each record of a decompressed frame."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        headers = _header(frame[at:end])
        start = end + 4
        size = int(headers["Content-Length"])
        yield headers, frame[start : start + size]
        at = start + size + 4


class BundleWriter:
    """Writes records to bundles of one task; hands out their index rows when a bundle is closed."""

    def __init__(self, folder: str, frame_bytes: int, bundle_bytes: int):
        self._filesystem, self._folder = _filesystem(folder)
        self._uri, self._frame_bytes, self._bundle_bytes = folder, frame_bytes, bundle_bytes
        self._compressor = zstandard.ZstdCompressor(level=3)
        self._stream = None

    def _begin(self) -> None:
        name = f"bundle-{TaskContext.get().partitionId() if TaskContext.get() else 0:06d}-{uuid.uuid4().hex}.warc.zst"
        self._name = f"{self._uri}/{name}"
        self._filesystem.create_dir(self._folder, recursive=True)
        self._stream = self._filesystem.open_output_stream(f"{self._folder}/{name}", compression=None)
        self._frames: list[tuple[int, int]] = []
        self._rows: list[tuple] = []
        self._place, self._buffer, self._open_rows = 0, io.BytesIO(), []

    def add(self, page_id: int | None, record: bytes) -> list[tuple]:
        if self._stream is None:
            self._begin()
        self._open_rows.append((page_id, self._buffer.tell(), len(record)))
        self._buffer.write(record)
        if self._buffer.tell() >= self._frame_bytes:
            self._end_frame()
        return self.close() if self._place >= self._bundle_bytes else []

    def _end_frame(self) -> None:
        data = self._buffer.getvalue()
        packed = self._compressor.compress(data)
        self._stream.write(packed)
        number = len(self._frames)
        self._rows += [(p, self._name, number, self._place, len(packed), start, size) for p, start, size in self._open_rows]
        self._frames.append((len(packed), len(data)))
        self._place += len(packed)
        self._buffer, self._open_rows = io.BytesIO(), []

    def close(self) -> list[tuple]:
        if self._stream is None:
            return []
        if self._open_rows:
            self._end_frame()
        entries = b"".join(struct.pack("<II", *sizes) for sizes in self._frames)
        footer = struct.pack("<IBI", len(self._frames), 0, SEEKABLE_MAGIC)
        self._stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self._stream.close()
        self._stream = None
        return self._rows


@contextmanager
def _opened(bundle: str):
    filesystem, path = _filesystem(bundle)
    with filesystem.open_input_file(path) as file:
        yield file


def seek_table(file) -> list[tuple[int, int, int]]:
    """(start, compressed size, size) of every frame, from the footer of an open bundle."""
    end = file.size()
    frames, flags, magic = struct.unpack("<IBI", file.read_at(9, end - 9))
    if magic != SEEKABLE_MAGIC or flags:
        raise ValueError("no seek table without checksums at the end of the bundle")
    raw = file.read_at(8 * frames, end - 9 - 8 * frames)
    found, start = [], 0
    for packed, size in struct.iter_unpack("<II", raw):
        found.append((start, packed, size))
        start += packed
    return found


def read_record(bundle: str, frame_start: int, frame_size: int, record_start: int, record_size: int) -> tuple[dict[str, str], bytes]:
    """One record by its index row: one ranged read, one frame decompressed."""
    with _opened(bundle) as file:
        frame = zstandard.ZstdDecompressor().decompress(file.read_at(frame_size, frame_start))
    return next(parse_records(frame[record_start : record_start + record_size]))


def _write(folder: str, frame_bytes: int, bundle_bytes: int):
    names = [f.split()[0] for f in INDEX.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 4]

    def rows_out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BundleWriter(folder, frame_bytes, bundle_bytes)
        for batch in batches:
            for row in batch.to_pylist():
                kind = "response" if row["refers_to"] is None else "revisit"
                payload = (row["html"] or "").encode() if kind == "response" else b""
                record = _record(kind, row["page_id"], row["url"], row["digest"], row["bytes"], payload, row["refers_to"])
                if done := writer.add(row["page_id"], record):
                    yield rows_out(done)
        if done := writer.close():
            yield rows_out(done)

    return run


def write_archives(
    pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
    id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
) -> DataFrame:
    """Write a record for each row to bundles in `folder`; returns the index of the records.

    Payloads of at least 100 bytes that are equal by SHA-256 are stored once: the smallest page_id
    is the response, the others are revisits that refer to it. Payloads meet their group's smallest
    id in a join by digest whose hot keys Spark can split; revisits' payloads are dropped before the
    rows are dealt evenly to the writers. Bundles of failed or repeated tasks have names of their
    own that the index, written to the shared folder, doesn't hold.

    Null payloads and urls count as empty. Rows that repeat the smallest page_id of a group are all
    responses. A null page_id takes part only where its group has no other, as a response. An
    empty table writes nothing and gives an empty index; other columns are not read.
    """
    small_batches(pages.sparkSession)
    html = F.coalesce(F.col(html_column), F.lit(""))
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"), html.alias("html"),
        F.sha2(F.encode(html, "UTF-8"), 256).alias("digest"), F.octet_length(F.encode(html, "UTF-8")).cast("long").alias("bytes"),
    )
    shared = rows.where(F.col("bytes") >= LEAST_SHARED).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
    shared = save(shared.where("n > 1").select("digest", "first"))
    refers = F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    joined = rows.join(shared, "digest", "left").select("page_id", "url", "digest", "bytes", refers.alias("refers_to"), F.when(refers.isNull(), F.col("html")).alias("html"))
    return save(joined.mapInArrow(_write(folder, frame_bytes, bundle_bytes), INDEX))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    decompressor = zstandard.ZstdDecompressor()
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        for bundle, first, last in zip(*(batch.column(c).to_pylist() for c in ("bundle", "first", "last"))):
            with _opened(bundle) as file:
                for start, packed, size in seek_table(file)[first : last + 1]:
                    frame = decompressor.decompress(file.read_at(packed, start), max_output_size=size)
                    rows = [_described(*record) for record in parse_records(frame)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "None" else int(number)


def _described(headers: dict[str, str], content: bytes) -> tuple[int | None, int, str, str, int | None]:
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "revisit":
        return _page(headers["WARC-Record-ID"]), int(headers["WARC-Payload-Length"]), digest, kind, _page(headers["WARC-Refers-To"])
    if hashlib.sha256(content).hexdigest() != digest:
        raise ValueError(f"{headers['WARC-Record-ID']}: the payload differs from its digest")
    return _page(headers["WARC-Record-ID"]), len(content), digest, kind, None


def read_archives(index: DataFrame) -> DataFrame:
    """Every record of the indexed bundles, read frame by frame through the seek tables.

    (page_id, payload_bytes, payload_digest, record_type, refers_to). Payloads are checked against their
    digests. Work is dealt out in stretches of frames, so a large bundle is read by many tasks.
    """
    stretch = F.floor(F.col("frame") / 16)
    work = index.groupBy("bundle", stretch.alias("stretch")).agg(F.min("frame").alias("first"), F.max("frame").alias("last"))
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return work.select("bundle", "first", "last").mapInArrow(_read, schema)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for bundles under the shared one of the session."""
    return f"{shared_folder(spark)}/warc"
