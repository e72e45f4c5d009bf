"""WARC archives in seekable Zstandard bundles.

Records are grouped into frames that decompress on their own. A bundle is a run of frames and ends with a seek table in a skippable frame,
as the seekable format lays it down, so that a reader finds every frame from the last bytes of the file. The index maps a record's
id to its bundle, its frame, and its place inside the decompressed frame; one record costs one ranged read.

Files are written by the tasks through ``pyarrow.fs`` into a folder that all executors share, each under a name of its own attempt. The index
comes from the attempts that succeeded, and readers follow it: files of lost attempts are never read.

Defined results: a null html is an empty payload. Of equal payloads of at least ``REVISIT_BYTES`` bytes the record of the smallest page_id
is the response; rows that repeat this page_id are responses too, and all others revisit it. Without any page_id all are responses.
A null url leaves its header out. Repeated rows are records of their own. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from functools import partial
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, batch_of, shared_path, write_aside

REVISIT_BYTES = 100
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
#: Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
#: Pages carry no time of their own.
RECORD_DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = pa.schema([
    ("page_id", pa.int64()), ("record_id", pa.string()), ("bundle", pa.string()), ("frame", pa.int64()),
    ("frame_at", pa.int64()), ("frame_bytes", pa.int64()), ("frame_size", pa.int64()), ("record_at", pa.int64()), ("record_bytes", pa.int64()),
])
INDEX_DDL = (
    "page_id long, record_id string, bundle string, frame long, frame_at long, frame_bytes long, frame_size long, record_at long, record_bytes long"
)
RECORD = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])
RECORD_DDL = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
)


def mark_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, first): a revisit has the id in ``first`` and no payload.

    Digests are counted on their own; their hot values are combined before the shuffle and their join can be split.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    firsts = (
        rows.filter(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy("payload_digest").agg(F.min("page_id").alias("least"), F.count("*").alias("copies"))
        .filter("copies > 1 AND least IS NOT NULL").select("payload_digest", "least")
    )
    joined = rows.join(firsts, "payload_digest", "left")
    revisit = F.col("least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least"))
    return joined.select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        F.when(revisit, F.col("least")).alias("first"),
    )


def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:x-page:{'-' if page_id is None else page_id}:{digest[:32]}"


def encode_record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, first: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if payload is None else http + payload
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", f"<{record_id(page_id, digest)}>"),
        ("WARC-Date", RECORD_DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="/:?#[]@!$&'()*+,;=%~-._")))
    if first is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{record_id(first, digest)}>")]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields)
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def decode_records(data: bytes) -> Iterator[tuple]:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of each record; digests are checked."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:head_end].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"no record at byte {at} of the frame")
        fields = dict(line.split(": ", 1) for line in lines)
        start, size = head_end + 4, int(fields["Content-Length"])
        block = data[start : start + size]
        http, _, payload = block.partition(b"\r\n\r\n")
        payload_bytes = int(re.search(rb"(?m)^Content-Length: (\d+)", http)[1])
        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
        if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != payload_bytes):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")

        def page(name: str, fields: dict = fields) -> int | None:
            number = fields[name].split(":")[2] if name in fields else "-"
            return None if number == "-" else int(number)

        yield (
            page("WARC-Record-ID"), fields.get("WARC-Target-URI"), payload_bytes, digest, kind, page("WARC-Refers-To"),
            payload if kind == "response" else None,
        )
        at = start + size + 4


class BundleWriter:
    """A bundle file that grows frame by frame."""

    def __init__(self, folder: str) -> None:
        self.store, root = fs.FileSystem.from_uri(folder)
        self.store.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.zst"
        self.path = f"{folder}/{name}"
        self.file = self.store.open_output_stream(f"{root}/{name}", compression=None)  # by its name it would be compressed again
        self.packer = zstandard.ZstdCompressor(level=3)
        self.sizes: list[tuple[int, int]] = []
        self.at = 0

    def add(self, records: list[bytes]) -> tuple[int, int, int]:
        """Number, place and size of the new frame."""
        data = b"".join(records)
        frame = self.packer.compress(data)
        self.file.write(frame)
        self.sizes.append((len(frame), len(data)))
        self.at += len(frame)
        return len(self.sizes) - 1, self.at - len(frame), len(frame)

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *pair) for pair in self.sizes)
        table += struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.file.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.file.close()


def seek_table(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(place, packed size, size) of every frame, from the end of the file."""
    size = file.size()
    file.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("the file does not end with a seek table")
    file.seek(size - 9 - 8 * count)
    pairs = struct.iter_unpack("<II", file.read(8 * count))
    frames, at = [], 0
    for packed, size in pairs:
        frames.append((at, packed, size))
        at += packed
    return frames


def _write_task(batches: Iterable[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    writer: BundleWriter | None = None
    held: list[tuple[int | None, str, bytes]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        nonlocal writer, held, size
        writer = writer or BundleWriter(folder)
        frame, at, packed = writer.add([data for _, _, data in held])
        places, inside = [], 0
        for _, _, data in held:
            places.append(inside)
            inside += len(data)
        n = len(held)
        out = batch_of(
            INDEX, page_id=[x[0] for x in held], record_id=[x[1] for x in held], bundle=[writer.path] * n, frame=[frame] * n,
            frame_at=[at] * n, frame_bytes=[packed] * n, frame_size=[inside] * n, record_at=places, record_bytes=[len(x[2]) for x in held],
        )
        if writer.at >= BUNDLE_BYTES:
            writer.close()
            writer = None
        held, size = [], 0
        return out

    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "first"]
    for batch in batches:
        for page_id, *rest in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            data = encode_record(page_id, *rest)
            held.append((page_id, record_id(page_id, rest[3]), data))
            size += len(data)
            if size >= FRAME_BYTES:
                yield flush()
    if held:
        yield flush()
    if writer:
        writer.close()


def write_bundles(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives into ``folder`` and returns the index, which is stored beside them."""
    task = partial(_write_task, folder=folder)
    return write_aside(arrow_map(mark_revisits(pages), task, INDEX_DDL), "warc-index")


def _frames_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column("bundle").to_pylist():
            store, path = fs.FileSystem.from_uri(uri)
            with store.open_input_file(path) as file:
                frames = seek_table(file)
            yield pa.RecordBatch.from_pydict({
                "bundle": [uri] * len(frames), "at": [f[0] for f in frames], "packed": [f[1] for f in frames], "size": [f[2] for f in frames],
            })


def _read_task(batches: Iterable[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        for uri, at, packed, size in zip(*(batch.column(n).to_pylist() for n in ("bundle", "at", "packed", "size")), strict=True):
            store, path = fs.FileSystem.from_uri(uri)
            with store.open_input_file(path) as file:
                data = unpacker.decompress(file.read_at(packed, at), max_output_size=size)
            columns = list(zip(*decode_records(data), strict=True)) or [[]] * len(RECORD)
            if not payloads:
                columns[-1] = [None] * len(columns[0])
            yield batch_of(RECORD, **dict(zip(RECORD.names, columns, strict=True)))


def read_bundles(bundles: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the files in column ``bundle``. Frames are found by the seek tables and dealt out to all tasks."""
    frames = arrow_map(bundles.select("bundle").distinct(), _frames_task, "bundle string, at long, packed long, size long")
    parts = int(bundles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return arrow_map(frames.repartition(parts, "bundle", "at"), partial(_read_task, payloads=payloads), RECORD_DDL)


def read_record(index_row: dict) -> tuple:
    """One record by its index row, with one ranged read."""
    store, path = fs.FileSystem.from_uri(index_row["bundle"])
    with store.open_input_file(path) as file:
        packed = file.read_at(index_row["frame_bytes"], index_row["frame_at"])
    data = zstandard.ZstdDecompressor().decompress(packed, max_output_size=index_row["frame_size"])
    start = index_row["record_at"]
    return next(decode_records(data[start : start + index_row["record_bytes"]]))


def archive_folder(spark: SparkSession) -> str:
    folder = shared_path(spark, "warc")
    return folder if "://" in folder or folder.startswith("file:") else os.path.abspath(folder)


def archive_report(pages: DataFrame) -> DataFrame:
    """Writes the pages, reads the archives back and describes each record found in them."""
    index = write_bundles(pages, archive_folder(pages.sparkSession))
    return read_bundles(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
