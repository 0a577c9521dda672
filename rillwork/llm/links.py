"""From shared buckets to verified links to connected components, at any bucket size.

Buckets are never expanded into all their pairs. Every member is first compared
with the smallest member of its bucket; members that this joins need no further
comparison. What stays apart inside a bucket is compared in blocks of bounded
size: signatures first, then an upper bound of the intersection from shortened
hashes of the full sets. Only pairs that this cannot rule out leave a block,
and they are verified on their full sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm.keep import kept

BLOCK = 256  # members of one block; two blocks meet in one comparison
BROADCAST_IDS = 500_000  # so many ids are sent to every executor at most, about 20 MB as a hash table
WIDE = 4096  # sets of more elements are shortened to 32 bits an element


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node of ``links`` (a, b), component the smallest id reachable.

    Alternating stars: each round points every node's greater neighbours, then
    its smaller ones, at the least neighbour, so paths shrink to half or less.
    Rounds are cut with ``checkpoint()``; the driver gets one flag per round.
    """
    edges = kept(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _is_stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(least, "u")
        edges = kept(met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .union(least.select("u", F.col("m").alias("v"))).distinct())
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select("v", F.col("v")).distinct())


def _is_stars(edges: DataFrame) -> bool:
    """True if every node has one smaller neighbour at most, which itself has none."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    odd = ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above")).where(
        "below > 1 OR (below = 1 AND above = 1)")
    return odd.isEmpty()


def in_buckets(items: DataFrame, percent: int, least_alike: float, shortened: Callable[[DataFrame], DataFrame],
               verified: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links (a, b) that join the components of all similar ``items``.

    ``items``: id, size (elements of the set), sig (binary, one byte per hash
    value), keys (array of bucket keys). ``least_alike`` is the share of equal
    signature bytes below which two items cannot be similar. ``shortened`` gives (id, size, short)
    for a table of ids, see ``shorten``; ``verified`` keeps the true links of pairs (a, b).
    Links are left out only between items that other links already join.
    """
    rows = items.select(F.explode("keys").alias("key"), "id", "size")
    first = rows.groupBy("key").agg(F.min(F.struct("id", "size")).alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = kept(rows.join(first, "key").select("key", "id", "size", "first", "n"))
    near = F.col("size") * 100 >= F.col("first.size") * percent
    near &= F.col("first.size") * 100 >= F.col("size") * percent
    stars = kept(shared.where(near & (F.col("id") != F.col("first.id"))).select(
        F.col("first.id").alias("a"), F.col("id").alias("b")).distinct())
    links = kept(verified(stars))
    label = components(links)
    apart = shared.join(label, "id", "left").select(
        "key", "id", "n", "first.id", F.coalesce("component", "id").alias("label")).toDF("key", "id", "n", "first", "label")
    split = apart.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("g")).where("l < g").select("key")
    apart = kept(apart.join(split, "key"))
    ids = kept(apart.select("id").distinct())
    sets = only(items.select("id", "size", "sig"), "id", ids).join(shortened(ids).distinct(), ["id", "size"])
    pairs = kept(_compared(apart.join(sets, "id"), percent, least_alike).distinct())
    return links.union(kept(verified(pairs)))


def only(rows: DataFrame, column: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """``rows`` whose ``column`` stands in the kept table ``ids`` (id), or with ``left_anti`` does not.

    The ids are broadcast only if they were counted to be few."""
    wanted = ids.withColumnRenamed("id", column)
    if ids.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    return rows.join(wanted, column, how)


def shorten(hashes: np.ndarray) -> bytes:
    """Distinct upper bits of sorted 64-bit hashes: 16 of each, or 32 for a set of over ``WIDE`` elements."""
    if len(hashes) > WIDE:
        return np.unique((hashes >> np.uint64(32)).astype(np.uint32)).tobytes()
    return np.unique((hashes >> np.uint64(48)).astype(np.uint16)).tobytes()


def most_shared(one: bytes, size: int, others: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Upper bounds of the elements that the set ``one`` shares with each of ``others``.

    Shared elements have equal short values; those of them that fall on one value are
    no more than either set lost by shortening.
    """
    out = np.zeros(len(others), dtype=np.int64)
    wide = np.array([size > WIDE] * len(others)) & (sizes > WIDE)
    lean = np.flatnonzero(~wide)

    def narrow(raw: bytes, n: int) -> np.ndarray:
        return np.unique((np.frombuffer(raw, np.uint32) >> 16).astype(np.uint16)) if n > WIDE else np.frombuffer(raw, np.uint16)

    if len(lean):
        mine = narrow(one, size)
        there = np.zeros(65536, dtype=np.int64)
        there[mine] = 1
        sets = [narrow(others[k], sizes[k]) for k in lean]
        length = np.array([len(s) for s in sets])
        hits = np.add.reduceat(there[np.concatenate(sets)], np.cumsum(length) - length)
        out[lean] = hits + np.minimum(size - len(mine), sizes[lean] - length)
    for k in np.flatnonzero(wide):
        mine, other = np.frombuffer(one, np.uint32), np.frombuffer(others[k], np.uint32)
        out[k] = len(np.intersect1d(mine, other, assume_unique=True)) + min(size - len(mine), sizes[k] - len(other))
    return out


def _compared(members: DataFrame, percent: int, least_alike: float) -> DataFrame:
    """Pairs of members of a bucket under different labels that may reach the threshold."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    tasks = (members.withColumn("blocks", blocks).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
                     "id", "first", "label", "size", "sig", "short"))
    # a block meets itself once: its members arrive once for every other block
    tasks = tasks.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            edges = _run_edges(table)
            yield from _pairs_of_runs(table, edges[:-1], percent, least_alike)
            rest = table.slice(edges[-2])
        if rest is not None:
            yield from _pairs_of_runs(rest, [0, len(rest)], percent, least_alike)

    return tasks.mapInArrow(compare, "a long, b long")


def _run_edges(table: pa.Table) -> list[int]:
    same = np.ones(max(len(table) - 1, 0), dtype=bool)
    for name in ("key", "i", "j"):
        v = table[name].to_numpy()
        same &= v[1:] == v[:-1]
    return [0, *(np.flatnonzero(~same) + 1).tolist(), len(table)]


def _pairs_of_runs(table: pa.Table, edges: list[int], percent: int, least_alike: float) -> Iterator[pa.RecordBatch]:
    ids, own, first, label, size = (table[c].to_numpy() for c in ("id", "own", "first", "label", "size"))
    i, j = table["i"].to_numpy(), table["j"].to_numpy()
    left, right = [], []
    for a, b in zip(edges, edges[1:]):
        if b - a < 2 or (label[a:b] == label[a]).all():
            continue
        sig = np.frombuffer(b"".join(table["sig"].slice(a, b - a).to_pylist()), dtype=np.uint8).reshape(b - a, -1)
        short = table["short"].slice(a, b - a).to_pylist()
        for x in range(b - a - 1):
            y = np.arange(x + 1, b - a)
            y = y[(label[a + y] != label[a + x]) & (ids[a + y] != first[a]) & (ids[a + x] != first[a])]
            if i[a] != j[a]:
                y = y[own[a + y] != own[a + x]]
            y = y[(size[a + y] * 100 >= size[a + x] * percent) & (size[a + x] * 100 >= size[a + y] * percent)]
            if len(y):
                y = y[(sig[y] == sig[x]).mean(axis=1) >= least_alike]
            if len(y):
                most = most_shared(short[x], int(size[a + x]), [short[k] for k in y], size[a + y])
                y = y[100 * most >= percent * (size[a + x] + size[a + y] - most)]
                left.append(np.minimum(ids[a + x], ids[a + y]))
                right.append(np.maximum(ids[a + x], ids[a + y]))
    if left:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["a", "b"])
