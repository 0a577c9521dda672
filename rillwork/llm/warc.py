"""WARC archives in seekable Zstandard bundles.

Every partition writes one bundle ``<folder>/bundles/<name>.warc.zst``: WARC records
grouped into independent Zstandard frames of about ``FRAME`` bytes, and a
seek table (sizes and checksum of every frame) in a skippable frame at the end, as the public seekable format
has it, so any Zstandard reader unpacks the whole. The index, a Parquet table
``<folder>/index``, maps every record to its bundle, frame and offset within the frame; reading
a record costs the footer and one frame.

Bundles are named anew by every attempt of a task, and the index, which Spark
commits once per task, names the bundles that count; a lost or repeated task leaves at most a file that nothing
names. Bundles are written with ``pyarrow.fs``, which must know the folder's file system.

Of records with equal payloads of at least ``revisit_from`` bytes, the one with
the smallest page_id is a response, the others revisit it. Defined results: null html is an
empty payload; a null or unclean url is written empty or percent-encoded; a record with
null page_id is always a response; rows with equal page_id and payload are alike, so both may be
responses, under one record id. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillwork.llm.keep import kept, small_batches
from rillwork.session import shared_folder

FRAME = 256 * 1024  # bytes of records in a frame, before compression
LEVEL = 3
TASK = 64 << 20  # bytes of records that a task reads
BROADCAST_ROWS = 500_000  # so many revisits are sent to every executor at most
INDEX = "page_id long, bundle string, frame int, offset long, length long"

# Fixed values of the public seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80
# Fixed value of the WARC standard.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest32(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record of a page; with ``refers_to`` a revisit, which leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
            f"WARC-Payload-Digest: sha1:{digest32(payload)}", "Content-Type: application/http;msgtype=response",
            f"Content-Length: {len(block)}", f"X-Page-Id: {'' if page_id is None else page_id}", f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes | None]:
    """(headers, payload) of a record; the payload of a revisit is None. Raises if the payload is not what its digest says."""
    head, _, block = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record at this offset")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = block[:int(fields["Content-Length"])]
    if fields["WARC-Type"] == "revisit":
        return fields, None
    payload = block.partition(b"\r\n\r\n")[2]
    if f"sha1:{digest32(payload)}" != fields["WARC-Payload-Digest"]:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return fields, payload


class Bundle:
    """Writes records as frames to an open stream and the seek table at the end."""

    def __init__(self, stream):
        self.stream, self.packer = stream, zstandard.ZstdCompressor(level=LEVEL)
        self.open, self.size, self.frames = [], 0, []

    def add(self, raw: bytes) -> tuple[int, int]:
        """(frame, offset in it) of the record."""
        if self.open and self.size + len(raw) > FRAME:
            self.flush()
        place = len(self.frames), self.size
        self.open.append(raw)
        self.size += len(raw)
        return place

    def flush(self) -> None:
        plain = b"".join(self.open)
        packed = self.packer.compress(plain)
        self.stream.write(packed)
        self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.open, self.size = [], 0

    def close(self) -> None:
        if self.open:
            self.flush()
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), HAS_CHECKSUMS, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.stream.close()


class Reader:
    """Frames of a bundle by number, through its seek table."""

    def __init__(self, path: str):
        system, place = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        self.file.seek(size - 9)
        count, _, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{path} has no seek table")
        self.file.seek(size - 9 - 12 * count)
        raw = self.file.read(12 * count)
        self.frames, at = [], 0
        for packed, plain, check in struct.iter_unpack("<III", raw):
            self.frames.append((at, packed, plain, check))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, plain, check = self.frames[number]
        self.file.seek(at)
        out = zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=max(plain, 1))
        if xxhash.xxh64_intdigest(out) & 0xFFFFFFFF != check:
            raise ValueError("a frame does not match its checksum")
        return out

    def close(self) -> None:
        self.file.close()


def with_references(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """(page_id, url, html binary, refers_to): the response that every page revisits, null for responses."""
    html = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8")
    named = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string").alias("url"), html.alias("html"))
    named = named.withColumn("digest", F.unhex(F.sha1("html"))).withColumn("bytes", F.octet_length("html"))
    brief = named.where(F.col("page_id").isNotNull() & (F.col("bytes") >= revisit_from)).select("page_id", "digest", "bytes")
    several = brief.groupBy("digest", "bytes").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("refers_to < last")
    revisits = kept(brief.join(several.drop("last"), ["digest", "bytes"]).where("page_id <> refers_to").distinct())
    if revisits.count() <= BROADCAST_ROWS:
        revisits = F.broadcast(revisits)
    return named.join(revisits, ["page_id", "digest", "bytes"], "left").select("page_id", "url", "html", "refers_to")


def write(pages: DataFrame, folder: str, revisit_from: int = 0) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) under ``folder``; the index, read from where it was written."""
    small_batches(pages.sparkSession)
    system, place = fs.FileSystem.from_uri(folder)
    system.create_dir(f"{place}/bundles", recursive=True)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/bundles/{uuid.uuid4()}.warc.zst"
        system, place = fs.FileSystem.from_uri(path)
        bundle = None
        for batch in batches:
            rows = []
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                bundle = bundle or Bundle(system.open_output_stream(place, compression=None))
                raw = record(page_id, url, html, refers_to)
                rows.append((page_id, path, *bundle.add(raw), len(raw)))
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()),
                                                  pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                                                 ["page_id", "bundle", "frame", "offset", "length"])
        if bundle:
            bundle.close()

    index = f"{folder}/index"
    with_references(pages, revisit_from).mapInArrow(pack, INDEX).write.parquet(index)
    return pages.sparkSession.read.schema(INDEX).parquet(index)


def read(index: DataFrame) -> DataFrame:
    """The records that ``index`` names: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload.

    The payload of a revisit is null; its length and digest are those its record states.
    """
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, opened, number, frame = None, None, None, b""
        for batch in batches:
            out = []
            for bundle, k, offset, length in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "offset", "length"))):
                if bundle != opened:
                    if reader:
                        reader.close()
                    reader, opened, number = Reader(bundle), bundle, None
                if k != number:
                    number, frame = k, reader.frame(k)
                fields, payload = parsed(frame[offset:offset + length])
                out.append((int(fields["X-Page-Id"]) if fields["X-Page-Id"] else None, fields["WARC-Target-URI"], fields["WARC-Type"],
                            int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                            int(fields["X-Refers-To-Page"]) if "X-Refers-To-Page" in fields else None, payload))
            if out:
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
                names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
        if reader:
            reader.close()

    # the records of a frame come together, so each frame is read once; tasks by the bytes they unpack, not by those of the index
    unpacked = index.agg(F.sum("length")).first()[0] or 0
    placed = index.repartition(1 + unpacked // TASK, "bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")
    return placed.mapInArrow(unpack, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
                                     "refers_to long, payload binary")


def new_folder(spark: SparkSession) -> str:
    """A folder of its own for one archive in the session's shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4()}"
