"""Product codes of vectors by Lloyd's algorithm with active entries.

Vectors become whole numbers, floor(``SCALE`` * x), and are cut into ``PARTS`` equal parts; each part
position has a codebook of ``ENTRIES`` entries. A round gives every part the nearest entry
(squared Euclidean distance, ties to the lower index) and then moves every entry to the floor of the mean of its parts.

From the second round on, a part whose entry stayed fixed keeps its stored exact distance and is compared with the *moved*
entries only: of the fixed ones its own was nearest before and still is. A moved entry wins if it is nearer, or as near with
a lower index. Parts whose entry moved are compared with all entries.

Each round is one pass over the vectors with their entries and distances, read from and written to the
shared folder; beside its rows, a task writes the sums of its own parts per entry, so the new codebooks
cost one row per task and entry. Only codebooks come to the driver: ``PARTS * ENTRIES`` entries, whatever the data.

Defined results: vectors that are null or hold a null or non-finite component are dropped. Vectors of other
lengths are filled with zeros at the end, up to the longest length of all or the next multiple of ``PARTS``. Scaled components
are held within ``LIMIT``, so squared distances fit in a long up to 4096 components a part. With fewer vectors than
entries, the codebook has as many entries as there are vectors. Null vec_ids come last in the order that the first entries are taken
by, equal ones stand in the order of their components. An error sum that leaves the range of a long is null. An empty table has no rows.
Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm.keep import kept, small_batches
from rillwork.session import shared_folder

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
LIMIT = 1 << 24
_QUICK = 1 << 20  # whole numbers up to this size have exact products in doubles, for parts of up to 2048 components
_CHUNK = 4096  # parts compared at a time

STATE = "vec_id long, label string, vector array<int>, codes array<int>, distances array<long>"
SUMS = "part int, entry int, n long, sums array<long>"


def squared_distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every point to every entry, both of whole numbers."""
    size = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    if size <= _QUICK and points.shape[1] <= 2048:
        a, b = points.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)
    out = np.zeros((len(points), len(entries)), dtype=np.int64)
    for k in range(points.shape[1]):
        gap = points[:, k:k + 1].astype(np.int64) - entries[None, :, k]
        out += gap * gap
    return out


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry of every point, ties to the lower index."""
    codes, best = np.zeros(len(points), dtype=np.int32), np.zeros(len(points), dtype=np.int64)
    for at in range(0, len(points), _CHUNK):
        found = squared_distances(points[at:at + _CHUNK], entries)
        codes[at:at + _CHUNK] = found.argmin(axis=1)
        best[at:at + _CHUNK] = found.min(axis=1)
    return codes, best


def reassigned(points: np.ndarray, codes: np.ndarray, distances: np.ndarray, entries: np.ndarray,
               moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entries after the entries ``moved`` (a flag each) have changed, given those from before."""
    codes, distances = codes.copy(), distances.copy()
    again = moved[codes]
    codes[again], distances[again] = nearest(points[again], entries)
    active, fixed = np.flatnonzero(moved), np.flatnonzero(~again)
    if len(active) and len(fixed):
        which, apart = nearest(points[fixed], entries[active])
        which = active[which]
        wins = (apart < distances[fixed]) | ((apart == distances[fixed]) & (which < codes[fixed]))
        codes[fixed[wins]], distances[fixed[wins]] = which[wins], apart[wins]
    return codes, distances


def scaled(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector array<int>) of the vectors that can be coded."""
    x = F.col("embedding").cast("array<double>")
    limit = float(LIMIT)
    whole = F.transform(x, lambda c: F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), c * SCALE))).cast("int"))
    usable = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(usable).select(F.col("vec_id").cast("long"), F.col("label").cast("string").alias("label"), whole.alias("vector"))


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """Arrays of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] if rows.ndim > 1 else 1)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rows.ravel(), kind))


class Codebooks:
    """The entries of every part position, and which of them the last round moved (all, if it is None)."""

    def __init__(self, entries: np.ndarray, moved: np.ndarray | None = None):
        self.entries, self.moved = entries, moved  # (part, entry, component), (part, entry)

    def next(self, sums: list) -> Codebooks:
        """Every entry moved to the floor of the mean of its parts; unused ones stay."""
        after = self.entries.copy()
        for part, entry, n, total in sums:
            after[part, entry] = np.floor_divide(np.array(total, dtype=np.int64), n)
        return Codebooks(after, (after != self.entries).any(axis=2))

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _pass(rows: DataFrame, books: Codebooks, path: str) -> tuple[DataFrame, DataFrame]:
    """One assignment of all parts, written under ``path``: the rows, and the sums of the parts of every entry, a row per task."""
    entries, moved = books.entries, books.moved
    parts, count, size = entries.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, uses = np.zeros(entries.shape, dtype=np.int64), np.zeros((parts, count), dtype=np.int64)
        for batch in batches:
            points = _matrix(batch.column("vector"), parts * size, np.int64).reshape(-1, parts, size)
            if moved is None:
                found = [nearest(points[:, p], entries[p]) for p in range(parts)]
            else:
                codes, far = _matrix(batch.column("codes"), parts, np.int64), _matrix(batch.column("distances"), parts, np.int64)
                found = [reassigned(points[:, p], codes[:, p], far[:, p], entries[p], moved[p]) for p in range(parts)]
            for p, (codes, _) in enumerate(found):
                np.add.at(sums[p], codes, points[:, p])
                uses[p] += np.bincount(codes, minlength=count)
            none = pa.nulls(len(batch), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(["rows"] * len(batch)), *(batch.column(c) for c in ("vec_id", "label", "vector")),
                 _lists(np.stack([c for c, _ in found], axis=1), pa.int32()), _lists(np.stack([d for _, d in found], axis=1), pa.int64()),
                 none, none, pa.nulls(len(batch), pa.int64()), pa.nulls(len(batch), pa.list_(pa.int64()))], names)
        used = np.argwhere(uses)
        if len(used):
            nulls = [pa.nulls(len(used), t) for t in (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()))]
            where = used[:, 0], used[:, 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(["sums"] * len(used)), *nulls, pa.array(used[:, 0], pa.int32()), pa.array(used[:, 1], pa.int32()),
                 pa.array(uses[where], pa.int64()), _lists(sums[where], pa.int64())], names)

    names = ["kind", "vec_id", "label", "vector", "codes", "distances", "part", "entry", "n", "sums"]
    rows.mapInArrow(assign, f"kind string, {STATE}, {SUMS}").write.partitionBy("kind").parquet(path)
    spark = rows.sparkSession
    return spark.read.schema(STATE).parquet(f"{path}/kind=rows"), spark.read.schema(SUMS).parquet(f"{path}/kind=sums")


def totals(sums: DataFrame, size: int) -> list:
    """(part, entry, n, sums) over all tasks."""
    added = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(size)])
    return [(r[0], r[1], r[2], list(r[3:])) for r in added.collect()]


def coded(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """(vec_id, label, vector, codes, distances) of every vector that can be coded, and the codebooks they refer to."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows = scaled(vectors)
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    size = max(1, -(-longest // PARTS))
    fill = F.array_repeat(F.lit(0), F.greatest(F.lit(0), PARTS * size - F.size("vector")))
    rows = rows.withColumn("vector", F.concat("vector", fill))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").collect()
    if not first:
        return rows.select("*", F.array().cast("array<int>").alias("codes"), F.array().cast("array<long>").alias("distances")), None
    books = Codebooks(np.array([r["vector"] for r in first], dtype=np.int64).reshape(-1, PARTS, size).transpose(1, 0, 2).copy())
    folder = f"{shared_folder(spark).rstrip('/')}/codes-{uuid.uuid4()}"
    state = rows
    for number in range(rounds):
        state, sums = _pass(state, books, f"{folder}/{number}")
        books = books.next(totals(sums, size))
    return _pass(state, books, f"{folder}/{rounds}")[0], books


def vector_codes(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector of ``vectors`` (vec_id, embedding, label)."""
    rows, books = coded(vectors)
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    found = rows.select("vec_id", "label", F.array_join(digits, "").alias("code"),
                        F.aggregate("distances", F.lit(0).cast("long"), lambda a, d: a + d).alias("error"))
    per_label = kept(found.groupBy("label").agg(F.try_sum("error").alias("label_error"))).withColumnRenamed("label", "__label")
    joined = found.join(per_label, F.col("label").eqNullSafe(F.col("__label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"))
