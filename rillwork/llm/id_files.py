"""Token ids in files, with document boundaries in Elias-Fano code.

Documents are dealt by ranges of doc_id, and every task writes its documents in order as one or more *shards*
``<folder>/shards/<name>.ids``: the ids of all its documents one after another, and behind them two monotone sequences,
the places where documents end and the doc_ids (as differences from the smallest). A sequence of n values below u keeps the lower
``l = floor(log2(u / n))`` bits of every value as they are and the upper ones as n set bits in a row of about 2n,
so an end costs about 2 + l bits; the place of every ``SAMPLE``-th set bit, 32 bits each, is the select
structure that finds any value without reading those before it. A shard ends with a footer that says where its sections begin.

Shards are named anew by every attempt of a task; the index, a Parquet table ``<folder>/index`` that Spark commits once per task,
names those that count, in order, so a lost or repeated task leaves at most a file that nothing names. Shards are written with
``pyarrow.fs``, which must know the folder's file system. Ids take two bytes each if the vocabulary allows it, else four.

Defined results: a null or empty text is the end id alone; text is encoded whole, however long. Rows with equal doc_ids stand in the
order of a hash of their texts; null doc_ids stand last and stay null. An empty table makes no shards and no rows. Other columns are not looked at.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillwork.llm.keep import small_batches
from rillwork.llm.tokens import encoder, encoding
from rillwork.session import shared_folder

MAGIC = b"RWIDS001"
END = 0  # the id behind every document
SHARD_IDS = 1 << 26  # a shard is closed once it holds so many ids
SHARD_DOCUMENTS = 1 << 20  # or so many documents
SAMPLE = 256  # set bits between two entries of the select structure
READ = 1 << 22  # bytes of ids read at a time, or one document
TASK_IDS = 1 << 22  # ids that a reading task takes, or one shard
INDEX = "part int, seq int, shard string, documents long, ids long"
_FOOTER = "<IQQQQqQQ8s"  # bytes an id, documents, ids, places of the two sequences, smallest doc_id, null doc_ids, values below it, magic
_HEAD = "<QQI"  # values, bound, lower bits


class EliasFano:
    """A monotone sequence of whole numbers from 0, in its coded form."""

    def __init__(self, raw: bytes):
        self.n, self.bound, self.low = struct.unpack_from(_HEAD, raw)
        at = struct.calcsize(_HEAD)
        samples, lower = 4 * -(-self.n // SAMPLE), -(-self.n * self.low // 8)
        self.samples = np.frombuffer(raw, "<u4", samples // 4, at)
        self.lower = raw[at + samples:at + samples + lower]
        self.upper = np.frombuffer(raw, np.uint8, offset=at + samples + lower)

    @staticmethod
    def coded(values: np.ndarray, bound: int) -> bytes:
        """``values`` in ascending order, none above ``bound``."""
        n = len(values)
        low = max(0, ((bound + 1) // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        places = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        upper = np.zeros((bound >> low) + n + 1, dtype=np.uint8)
        upper[places] = 1
        lower = []
        if low:
            for at in range(0, n, 1 << 16):
                few = values[at:at + (1 << 16)]
                lower.append(np.packbits((few[:, None] >> np.arange(low, dtype=np.uint64) & np.uint64(1)).astype(np.uint8), bitorder="little").tobytes())
        return b"".join([struct.pack(_HEAD, n, bound, low), places[::SAMPLE].astype("<u4").tobytes(), *lower,
                         np.packbits(upper, bitorder="little").tobytes()])

    def _set_bits(self, first: int, count: int) -> np.ndarray:
        """Places of ``count`` set bits from the ``first``-th on."""
        start = int(self.samples[first // SAMPLE])
        skip, found, base, got = first % SAMPLE, [], start // 8 * 8, 0
        at, step = start // 8, SAMPLE // 2
        while got < skip + count:
            bits = np.flatnonzero(np.unpackbits(self.upper[at:at + step], bitorder="little")) + at * 8
            if at * 8 == base:
                bits = bits[bits >= start]
            found.append(bits)
            got, at, step = got + len(bits), at + step, 2 * step
        return np.concatenate(found)[skip:skip + count]

    def values(self, first: int, count: int) -> np.ndarray:
        """``count`` values from the ``first``-th on: a select, and what follows."""
        count = min(count, self.n - first)
        if count <= 0:
            return np.zeros(0, dtype=np.uint64)
        upper = (self._set_bits(first, count) - np.arange(first, first + count)).astype(np.uint64)
        if not self.low:
            return upper
        begin, end = first * self.low, (first + count) * self.low
        bits = np.unpackbits(np.frombuffer(self.lower[begin // 8:-(-end // 8)], np.uint8), bitorder="little")
        bits = bits[begin % 8:begin % 8 + count * self.low].reshape(count, self.low)
        out = upper << np.uint64(self.low)
        for k in range(self.low):
            out |= bits[:, k].astype(np.uint64) << np.uint64(k)
        return out

    def __getitem__(self, i: int) -> int:
        return int(self.values(i, 1)[0])


class ShardWriter:
    """Writes documents to an open stream; ``close`` writes the boundaries."""

    def __init__(self, stream, width: int):
        self.stream, self.width = stream, width
        self.kind = np.dtype(f"<u{width}")
        self.sizes, self.doc_ids, self.ids, self.nulls = [], [], 0, 0

    def add(self, doc_id: int | None, ids: list[int]) -> None:
        self.stream.write(np.array(ids, dtype=self.kind).tobytes())
        self.sizes.append(len(ids))
        self.ids += len(ids)
        if doc_id is None:
            self.nulls += 1
        else:
            self.doc_ids.append(doc_id)

    def close(self) -> tuple[int, int]:
        """(documents, ids) of the shard."""
        least = self.doc_ids[0] if self.doc_ids else 0
        ends = EliasFano.coded(np.cumsum(self.sizes, dtype=np.int64), self.ids)
        spread = self.doc_ids[-1] - least if self.doc_ids else 0
        # differences of longs may need 64 bits, so they are taken without sign
        gaps = np.array(self.doc_ids, dtype=np.int64).astype(np.uint64) - np.array(least, dtype=np.int64).astype(np.uint64)
        ids_end = self.ids * self.width
        self.stream.write(ends)
        self.stream.write(EliasFano.coded(gaps, spread))
        self.stream.write(struct.pack(_FOOTER, self.width, len(self.sizes), self.ids, ids_end, ids_end + len(ends), least, self.nulls, len(self.doc_ids), MAGIC))
        self.stream.close()
        return len(self.sizes), self.ids


class Shard:
    """A shard, read by document number; only its boundaries are held."""

    def __init__(self, path: str):
        system, place = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(place)
        size, foot = self.file.size(), struct.calcsize(_FOOTER)
        self.file.seek(size - foot)
        self.width, self.documents, self.ids, ends, doc_ids, self.least, self.nulls, _, magic = struct.unpack(_FOOTER, self.file.read(foot))
        if magic != MAGIC:
            raise ValueError(f"{path} is no shard of token ids")
        self.file.seek(ends)
        self.ends = EliasFano(self.file.read(doc_ids - ends))
        self.doc_ids = EliasFano(self.file.read(size - foot - doc_ids))

    def bounds(self, first: int, count: int) -> np.ndarray:
        """Where ``count`` documents from the ``first``-th on begin, and where the last of them ends."""
        ends = self.ends.values(first, count).astype(np.int64)
        return np.concatenate([[self.ends[first - 1] if first else 0], ends]).astype(np.int64)

    def slice(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the shard."""
        self.file.seek(start * self.width)
        return np.frombuffer(self.file.read((end - start) * self.width), f"<u{self.width}").astype("<u4")

    def document(self, i: int) -> np.ndarray:
        """The ids of one document, the end id included: two selects and one read."""
        begin, end = self.bounds(i, 1).tolist()
        return self.slice(begin, end)

    def doc_id(self, i: int) -> int | None:
        return None if i >= self.doc_ids.n else self.least + self.doc_ids[i]

    def names(self, first: int, count: int) -> list[int | None]:
        known = [self.least + v for v in self.doc_ids.values(first, count).tolist()]
        return known + [None] * (min(count, self.documents - first) - len(known))

    def close(self) -> None:
        self.file.close()


def new_folder(spark: SparkSession) -> str:
    """A folder of its own in the session's shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/ids-{uuid.uuid4()}"


def write(docs: DataFrame, folder: str, tokenizer: str, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text) under ``folder``; the index (part, seq, shard, documents, ids), read from where it was written."""
    spark = docs.sparkSession
    small_batches(spark)
    system, place = fs.FileSystem.from_uri(folder)
    system.create_dir(f"{place}/shards", recursive=True)
    width = 2 if encoding(tokenizer).max_token_value < 1 << 16 else 4

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, writer, seq, path = encoder(tokenizer), None, 0, None
        part = TaskContext.get().partitionId()

        def finished() -> pa.RecordBatch:
            documents, ids = writer.close()
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([path]),
                                               pa.array([documents], pa.int64()), pa.array([ids], pa.int64())],
                                              ["part", "seq", "shard", "documents", "ids"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if writer is None:
                    path = f"{folder}/shards/{uuid.uuid4()}.ids"
                    system, place = fs.FileSystem.from_uri(path)
                    writer = ShardWriter(system.open_output_stream(place, compression=None), width)
                writer.add(doc_id, [*encode(text.as_py()), END])
                if writer.ids >= shard_ids or len(writer.sizes) >= SHARD_DOCUMENTS:
                    yield finished()
                    writer, seq = None, seq + 1
        if writer is not None:
            yield finished()

    named = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # rows with one doc_id may be many: their texts' hashes, and chance for equal texts, deal them on
    spread = named.withColumn("__h", F.xxhash64("text")).withColumn("__r", F.rand(11))
    order = [F.col("doc_id").asc_nulls_last(), F.col("__h"), F.col("__r")]
    dealt = spread.repartitionByRange(*order).sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "__h", "text")
    index = f"{folder}/index"
    dealt.select("doc_id", "text").mapInArrow(pack, INDEX).write.parquet(index)
    return spark.read.schema(INDEX).parquet(index)


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``, the ids before each shard; the driver holds one sum per task that wrote."""
    before, starts = 0, []
    for part, ids in sorted((r["part"], r["ids"]) for r in index.groupBy("part").agg(F.sum("ids").alias("ids")).collect()):
        starts.append((part, before))
        before += ids
    firsts = index.sparkSession.createDataFrame(starts, "part int, first long")
    inside = F.sum("ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("ids")
    return index.withColumn("__inside", inside).join(F.broadcast(firsts), "part").withColumn(
        "start", F.col("first") + F.col("__inside")).drop("first", "__inside")


def read(index: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the shards that ``index`` names; a task takes whole shards."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, begin in zip(batch.column("shard").to_pylist(), batch.column("start").to_pylist()):
                shard, first = Shard(path), 0
                while first < shard.documents:
                    bounds = shard.bounds(first, 4096)
                    # as many documents as fit into one reading, one at least
                    take = max(1, int(np.searchsorted(bounds, bounds[0] + READ // shard.width, side="right")) - 1)
                    bounds = bounds[:take + 1]
                    raw = memoryview(shard.slice(int(bounds[0]), int(bounds[-1])).tobytes())
                    edges = (4 * (bounds - bounds[0])).tolist()
                    checks = [zlib.crc32(raw[a:b]) for a, b in zip(edges, edges[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard.names(first, take), pa.int64()), pa.array(begin + bounds[:-1], pa.int64()),
                         pa.array(np.diff(bounds), pa.int64()), pa.array(checks, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                    first += take
                shard.close()

    size = index.agg(F.count("*").alias("shards"), F.sum("ids").alias("ids")).first()
    tasks = max(1, min(size["shards"], 1 + (size["ids"] or 0) // TASK_IDS))
    placed = with_starts(index).select("shard", "start").repartition(tasks, "shard")
    return placed.mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids_crc32 long")
