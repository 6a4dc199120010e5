"""WARC archives as seekable Zstandard bundles.

Records are written one after the other into frames of bounded size, each compressed on
its own. A bundle is a file of frames followed by a seek table, a skippable frame with the
compressed and plain size of every frame, so any Zstandard reader can unpack the whole file
and a reader that knows the table can unpack one frame. An index maps every record to its
bundle, frame and offset inside the frame.

Pages are written where they lie; only their ids and digests move. Of pages with equal
payloads the one with the smallest id is stored as a response, the others as revisits that
refer to it. A task writes its bundles under names of its own into the shared folder, frame
by frame, and Spark keeps its index entries only if it ends well, so a task that is lost or
repeated leaves at most a file that no index names. Files go through pyarrow's file systems,
which know local and remote stores by URI. A task holds one frame, one Arrow batch of pages
and, read back, ``BATCH_BYTES`` of payloads, or one payload where that is larger.

Edge cases: a null payload is empty. Payloads below ``min_revisit_bytes`` are always
responses. If several rows have the smallest id of equal payloads, all of them are
responses. A page without an id, which cannot be referred to, revisits the smallest id of
its payload if there is one and is a response otherwise. A payload larger than a frame gets
a frame of its own. No pages give no bundles and an empty index. Other columns are not
touched.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import BinaryIO
from urllib.parse import urlsplit

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricepanel.tables import lookup_join, materialize, scratch_path

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
MIN_REVISIT_BYTES = 100
LEVEL = 3
# Payloads and rows that are handed to Spark at once.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 10_000
# Fixed values of the seekable format: magic numbers, and the layouts of its parts.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
_FOOTER = "<IBI"
_ENTRY = "<II"
_SKIPPABLE = "<II"

INDEX_SCHEMA = (
    "page_id long, record_id string, bundle string, frame int, offset long, length long"
)
HEADER_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string"
)
RECORD_SCHEMA = f"{HEADER_SCHEMA}, payload binary"


@dataclass
class BundleWriter:
    """Collects records into frames, and writes each to ``out`` when it is full."""

    out: BinaryIO
    frame_bytes: int = FRAME_BYTES
    level: int = LEVEL
    sizes: list[tuple[int, int]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.written = 0
        self._frame = bytearray()
        self._compressor = zstandard.ZstdCompressor(level=self.level, write_checksum=True)

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and offset of the record."""
        if self._frame and len(self._frame) + len(record) > self.frame_bytes:
            self._flush()
        place = len(self.sizes), len(self._frame)
        self._frame += record
        return place

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.written += len(data)

    def _flush(self) -> None:
        packed = self._compressor.compress(bytes(self._frame))
        self.sizes.append((len(packed), len(self._frame)))
        self._write(packed)
        self._frame.clear()

    def finish(self) -> None:
        """Write the last frame and the seek table."""
        if self._frame:
            self._flush()
        table = b"".join(struct.pack(_ENTRY, *sizes) for sizes in self.sizes)
        footer = struct.pack(_FOOTER, len(self.sizes), 0, SEEKABLE_MAGIC)
        self._write(struct.pack(_SKIPPABLE, SKIPPABLE_MAGIC, len(table) + len(footer)))
        self._write(table + footer)


class BundleReader:
    """Reads single frames of a bundle by its seek table."""

    def __init__(self, file) -> None:
        self._file = file
        end = file.size()
        frames, flags, magic = struct.unpack(_FOOTER, self._at(end - struct.calcsize(_FOOTER), struct.calcsize(_FOOTER)))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("the bundle has no seek table")
        entry = struct.calcsize(_ENTRY) + (4 if flags & 0x80 else 0)
        table = self._at(end - struct.calcsize(_FOOTER) - frames * entry, frames * entry)
        self.starts, self.sizes = [], []
        start = 0
        for k in range(frames):
            packed, plain = struct.unpack_from(_ENTRY, table, k * entry)
            self.starts.append(start)
            self.sizes.append((packed, plain))
            start += packed

    def _at(self, offset: int, length: int) -> bytes:
        self._file.seek(offset)
        return self._file.read(length)

    def frame(self, number: int) -> bytes:
        packed, plain = self.sizes[number]
        data = self._at(self.starts[number], packed)
        return zstandard.ZstdDecompressor().decompress(data, max_output_size=plain)


def record_bytes(
    record_id: str, page_id: str | None, url: str | None, payload: bytes, digest: str,
    length: int, refers_to: str | None,
) -> bytes:
    """One WARC record; a revisit has headers only and names the page it refers to."""
    revisit = refers_to is not None
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(length)),
        ("Content-Type", "text/html; charset=utf-8"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", " ".join(url.split())))
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if revisit:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        headers += [("WARC-Profile", profile), ("X-Refers-To-Page-ID", str(refers_to))]
    body = b"" if revisit else payload
    headers.append(("Content-Length", str(len(body))))
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return b"WARC/1.1\r\n" + head.encode("utf-8") + b"\r\n" + body + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record at this offset")
    headers = dict(line.split(": ", 1) for line in lines)
    return headers, rest[: int(headers["Content-Length"])]


def mark_revisits(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """Pages with their payload, its length and digest, and the page they refer to."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    told = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
    )
    large = told.where(F.col("payload_bytes") >= min_revisit_bytes)
    first = large.groupBy("payload_digest").agg(
        F.min("page_id").alias("__first"), F.count(F.lit(1)).alias("__copies")
    )
    copied = materialize(first.where("__copies > 1").select("payload_digest", "__first"))
    looked_up = lookup_join(told, copied, ["payload_digest"])
    # Only digests of large payloads are in the table, and a digest tells the length.
    refers = F.when(~F.col("__first").eqNullSafe(F.col("page_id")), F.col("__first"))
    return looked_up.withColumn("refers_to", refers).drop("__first")


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if urlsplit(uri).scheme:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    **columns,
) -> DataFrame:
    """Write all pages as bundles under ``path`` and return the index, itself a table there."""
    spark = pages.sparkSession
    folder = f"{path.rstrip('/')}/bundles"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = name = None

        def opened() -> tuple[str, BundleWriter]:
            name = f"{folder}/{uuid.uuid4().hex}.warc.zst"
            store, target = _open(name)
            store.create_dir(target.rpartition("/")[0], recursive=True)
            return name, BundleWriter(store.open_output_stream(target, compression=None), frame_bytes)

        def close() -> None:
            writer.finish()
            writer.out.close()

        for batch in batches:
            entries = []
            for row in batch.itertuples(index=False):
                if writer is None:
                    name, writer = opened()
                record_id = f"urn:uuid:{uuid.uuid4()}"
                record = record_bytes(
                    record_id, row.page_id, row.url, row.payload or b"", row.payload_digest,
                    row.payload_bytes, row.refers_to,
                )
                page = None if row.page_id is None else int(row.page_id)
                entries.append((page, record_id, name, *writer.add(record), len(record)))
                if writer.written >= bundle_bytes:
                    close()
                    writer = None
            columns = ["page_id", "record_id", "bundle", "frame", "offset", "length"]
            yield pd.DataFrame(entries, columns=columns, dtype=object)
        if writer is not None:
            close()

    marked = mark_revisits(pages, **columns)
    # A revisit needs no payload; it is not handed to Python.
    # Ids go as text, which pandas does not turn into floating point where one is null.
    stored = marked.select(
        F.col("page_id").cast("string").alias("page_id"), "url", "payload_bytes", "payload_digest",
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
        F.col("refers_to").cast("string").alias("refers_to"),
    )
    stored.mapInPandas(write, INDEX_SCHEMA).write.parquet(f"{path}/index")
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")


def read_records(index: DataFrame, payload: bool = True) -> DataFrame:
    """The records that the index names, read by bundle, frame and offset.

    Length and digest of a response are those of the bytes read; a revisit has those of
    its headers and no payload. Entries of a frame that follow each other unpack it once.
    Without ``payload`` the bytes are read and checked, but not returned.
    """
    columns = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    columns += ["payload"] if payload else []

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundle, file, reader, place, frame = None, None, None, None, b""
        rows: list[Sequence] = []
        held = 0

        def handed() -> pd.DataFrame:
            return pd.DataFrame(rows, columns=columns, dtype=object)

        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.bundle != bundle:
                    if file is not None:
                        file.close()
                    store, target = _open(row.bundle)
                    file = store.open_input_file(target)
                    bundle, reader, place = row.bundle, BundleReader(file), None
                if row.frame != place:
                    place, frame = row.frame, reader.frame(row.frame)
                headers, body = parse_record(frame[row.offset : row.offset + row.length])
                kind = headers["WARC-Type"]
                told = headers["WARC-Payload-Digest"].partition(":")[2]
                n = int(headers["X-Payload-Length"])
                if kind == "response":
                    n, digest = len(body), hashlib.sha256(body).hexdigest()
                    if digest != told:
                        raise ValueError(f"record {row.record_id} is damaged")
                page = headers.get("X-Page-ID")
                refers = headers.get("X-Refers-To-Page-ID")
                record = (
                    None if page is None else int(page), headers.get("WARC-Target-URI"), kind,
                    None if refers is None else int(refers), n, told,
                )
                if payload:
                    record += (body if kind == "response" else None,)
                    held += len(body)
                rows.append(record)
                if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                    yield handed()
                    rows, held = [], 0
        if rows:
            yield handed()
        if file is not None:
            file.close()

    return index.mapInPandas(read, RECORD_SCHEMA if payload else HEADER_SCHEMA)


def archive_round_trip(
    pages: DataFrame, path: str | None = None, payload: bool = True
) -> DataFrame:
    """Write all pages and read them back from the archives."""
    path = path or scratch_path(pages.sparkSession, "warc")
    return read_records(write_archives(pages, path), payload)
