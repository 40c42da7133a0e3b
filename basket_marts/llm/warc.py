"""Web pages as WARC records in seekable Zstandard bundles, and back.

Records are grouped into frames that decompress on their own. A bundle ends with a seek
table in a skippable frame (sizes of every frame), and an index row per record gives its
bundle, frame and offset inside the decompressed frame. Reading a record takes the end of
the file, one frame, and a slice of it; any Zstandard tool can still read the whole file.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basket_marts.llm.common import lookup_join, shuffle_width, stored, text_slices

# Payloads from this size on are stored once; later copies become revisit records.
REVISIT_BYTES = 1000
FRAME_BYTES = 256 * 1024
LEVEL = 3

# The seekable format's numbers and the revisit profile.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_FOOTER = struct.Struct("<IBI")
_SKIPPABLE = struct.Struct("<II")
_ENTRY = np.dtype([("stored", "<u4"), ("plain", "<u4")])


# Bundles ------------------------------------------------------------------------------


class BundleWriter:
    """Appends records to a stream; `add` tells frame and offset of each."""

    def __init__(self, stream):
        self.stream, self.compressor = stream, zstandard.ZstdCompressor(level=LEVEL)
        self.entries: list[tuple[int, int]] = []
        self.waiting, self.held = [], 0

    def add(self, record: bytes) -> tuple[int, int]:
        if self.held and self.held + len(record) > FRAME_BYTES:
            self._end_frame()
        place = len(self.entries), self.held
        self.waiting.append(record)
        self.held += len(record)
        return place

    def _end_frame(self) -> None:
        frame = self.compressor.compress(b"".join(self.waiting))
        self.stream.write(frame)
        self.entries.append((len(frame), self.held))
        self.waiting, self.held = [], 0

    def close(self) -> None:
        if self.held:
            self._end_frame()
        table = np.array(self.entries, dtype=_ENTRY).tobytes()
        footer = _FOOTER.pack(len(self.entries), 0, SEEKABLE_MAGIC)
        self.stream.write(_SKIPPABLE.pack(SKIPPABLE_MAGIC, len(table) + len(footer)))
        self.stream.write(table + footer)
        self.stream.close()


class BundleReader:
    """Reads single frames of a bundle, found through its seek table."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        file.seek(size - _FOOTER.size)
        count, _, magic = _FOOTER.unpack(file.read(_FOOTER.size))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("not a seekable bundle")
        file.seek(size - _FOOTER.size - count * _ENTRY.itemsize)
        self.entries = np.frombuffer(file.read(count * _ENTRY.itemsize), dtype=_ENTRY)
        self.starts = np.cumsum(self.entries["stored"], dtype=np.int64) - self.entries["stored"]
        self.decompressor = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        self.file.seek(int(self.starts[number]))
        data = self.file.read(int(self.entries["stored"][number]))
        return self.decompressor.decompress(
            data, max_output_size=int(self.entries["plain"][number])
        )


# Records ------------------------------------------------------------------------------


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, sha1: bytes, refers_to: int | None, date: str
) -> bytes:
    """One record: a response with its payload, or a revisit that refers to one."""
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url:
        # A line break in a URL would end its header.
        safe = "".join(f"%{ord(c):02X}" if c <= " " else c for c in url)
        head.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if refers_to is None:
        body += payload
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record (no payload for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")[1:]
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def _page_id(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "null" else int(number)


# Spark --------------------------------------------------------------------------------


def with_originals(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to): which record each page's payload refers to.

    Of equal payloads of `REVISIT_BYTES` or more the largest page_id is kept. Pages that tie
    there are responses themselves, and so are pages without an id where none has one.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    hashed = pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "sha1", F.unhex(F.sha1("payload"))
    )
    originals = stored(
        hashed.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("sha1", F.octet_length("payload").alias("size"))
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .drop("copies"),
        "warc-originals",
    )
    sized = hashed.withColumn("size", F.octet_length("payload"))
    return lookup_join(sized, originals, ["sha1", "size"], "left").select(
        "page_id",
        "url",
        "payload",
        "sha1",
        F.when(
            F.col("page_id").isNull() | (F.col("page_id") < F.col("original")), F.col("original")
        ).alias("refers_to"),
    )


def write_archives(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of (page_id, url, html) to bundles below `path`; the index.

    `path` is a folder that all executors reach, as a URI that pyarrow's file systems know
    or an absolute path. A task writes a bundle of its own under a name of its own, so a
    task that is run again leaves a file that no index row names. The index (page_id,
    record_type, bundle, frame, offset, length) is stored, so that nothing is written twice.

    A NULL html is an empty payload, a NULL url is left out; repeated rows give a record
    each; other columns are not read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
        for batch in text_slices(batches, "payload"):
            if writer is None:
                system, folder = fs.FileSystem.from_uri(path)
                system.create_dir(folder, recursive=True)
                writer = BundleWriter(system.open_output_stream(f"{folder}/{name}", compression=None))
            rows = []
            for row in batch.to_pylist():
                record = record_bytes(**row, date=date)
                frame, offset = writer.add(record)
                kind = "response" if row["refers_to"] is None else "revisit"
                rows.append((row["page_id"], kind, name, frame, offset, len(record)))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), _INDEX.types)]
            yield pa.RecordBatch.from_arrays(columns, schema=_INDEX)
        if writer is not None:
            writer.close()

    schema = (
        "page_id bigint, record_type string, bundle string, frame bigint, offset bigint, "
        "length bigint"
    )
    return stored(with_originals(pages).mapInArrow(write, schema), "warc-index")


_INDEX = pa.schema(
    [
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("bundle", pa.string()),
        ("frame", pa.int64()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
    ]
)
_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("url", pa.string()),
        ("payload", pa.binary()),
    ]
)


def read_records(index: DataFrame, path: str, with_payload: bool = False) -> DataFrame:
    """The records that index rows point to; filter the index to read a few.

    Rows are dealt out by frame, so each frame is decompressed once. A response's size and
    digest are taken from the payload read; its digest must be the one in the header. A
    revisit's are those of its header, which are its full payload's.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(path)
        bundle, reader, number, frame = None, None, None, b""
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["bundle"] != bundle:
                    bundle, number = row["bundle"], None
                    reader = BundleReader(system.open_input_file(f"{folder}/{bundle}"))
                if row["frame"] != number:
                    number = row["frame"]
                    frame = reader.frame(number)
                record = frame[row["offset"] : row["offset"] + row["length"]]
                rows.append(_read_back(*parse_record(record), with_payload))
            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    width = shuffle_width(index.sparkSession)
    places = index.select("bundle", "frame", "offset", "length")
    placed = places.repartition(width, "bundle", "frame").sortWithinPartitions("bundle", "frame")
    schema = (
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, url string, payload binary"
    )
    records = placed.mapInArrow(read, schema)
    return records if with_payload else records.drop("payload")


def _read_back(headers: dict[str, str], payload: bytes, with_payload: bool) -> dict:
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    is_response = headers["WARC-Type"] == "response"
    if is_response and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    refers_to = headers.get("WARC-Refers-To")
    return {
        "page_id": _page_id(headers["WARC-Record-ID"]),
        "payload_bytes": len(payload) if is_response else int(headers["X-Payload-Length"]),
        "payload_digest": digest,
        "record_type": headers["WARC-Type"],
        "refers_to": _page_id(refers_to) if refers_to else None,
        "url": headers.get("WARC-Target-URI"),
        "payload": payload if with_payload and is_response else None,
    }


def round_trip(pages: DataFrame, path: str) -> DataFrame:
    """Write all pages, read all records back: a row per page, without payloads."""
    return read_records(write_archives(pages, path), path)
