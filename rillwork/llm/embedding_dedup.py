"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Unit vectors are turned onto principal axes, so that a dot product gathers most
of its value in the leading dimensions. A tree of medians over the first ``BOXED`` coordinates, fitted on the
sample the axes come from, puts near vectors into one leaf, and leaves are cut into tiles; two tiles are compared only
if the boxes of those coordinates are near enough for the threshold. Tiles are numbered in the order of the tree, and what is shuffled
are the tiles that the pairs of two blocks of ``BLOCK`` tiles need, each once for a pair of blocks. Inside a pair of tiles the products of the leading dimensions
are taken for all pairs, what the rest can add is bounded by the product of the suffix norms
(Cauchy-Schwarz), and only pairs that can still reach the threshold go on to
further dimensions and at last to the exact cosine of the given values in double precision.

The axes are fitted on at most ``FIT_ROWS`` vectors, those with the smallest hashes;
any rotation gives the same links, the fit only decides how soon pairs stop.

Equal vectors are one before the comparison and count as linked with each other. A pair of
tiles gives link counts per vector and the edges of a star forest, never its pairs.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components, and rows with a null vec_id, link with nothing and are kept; vectors of
different length do not link. Rows with one vec_id are one node but count as rows
in ``n_links``. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.llm.keep import kept, numbered
from rillwork.llm.links import components

FIT_ROWS = 20_000
TILE = 2048  # vectors of one tile
BOXED = 8  # leading coordinates that a tile has a box of
BLOCK = 8  # tiles of a block
STRIP = 256  # rows of a tile compared at once
STEP = 16  # dimensions added between two looks at the bound
SLACK = 1e-9  # rounding that a bound may have
COUNTS = "a long, b long, n long"


def axes(vectors: np.ndarray) -> np.ndarray:
    """Columns: principal axes of the unit vectors, greatest variance first."""
    return np.linalg.eigh(vectors.T @ vectors)[1][:, ::-1]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that squares of great or small values stay finite."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


class Tree:
    """Leaves of a complete binary tree of medians, each along the axis in which the points of the node spread most."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.axis, self.cut = np.zeros(2**depth - 1, dtype=np.int64), np.zeros(2**depth - 1)
        inside = [np.arange(len(points))]
        for node in range(2**depth - 1):
            own = points[inside[node]]
            self.axis[node] = own.var(axis=0).argmax()
            along = own[:, self.axis[node]]
            self.cut[node] = np.median(along)
            inside += [inside[node][along <= self.cut[node]], inside[node][along > self.cut[node]]]
            if not len(inside[-1]):  # one point many times over
                inside[-1] = inside[-2]

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(points), dtype=np.int64), np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[rows, self.axis[node]] > self.cut[node])
        return node - (2**self.depth - 1)


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def surviving(x: np.ndarray, y: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) whose rotated unit vectors have a dot product that may reach ``least``."""
    d = x.shape[1]
    starts = list(range(0, d, STEP))
    suffix_x = [np.sqrt((x[:, s:] ** 2).sum(axis=1)) for s in starts] + [np.zeros(len(x))]
    suffix_y = [np.sqrt((y[:, s:] ** 2).sum(axis=1)) for s in starts] + [np.zeros(len(y))]
    for a in range(0, len(x), STRIP):
        strip = slice(a, min(a + STRIP, len(x)))
        lead = x[strip, :STEP] @ y[:, :STEP].T
        bound = np.multiply.outer(suffix_x[1][strip], suffix_y[1])
        bound += lead
        i, j = np.nonzero(bound >= least - SLACK)
        if len(i) * 8 > lead.size:  # mostly alike: whole products are cheaper than gathered ones
            i, j = np.nonzero(x[strip] @ y.T >= least - SLACK)
            yield i + a, j
            continue
        for p in range(0, len(i), 65536):
            u, v = i[p:p + 65536] + a, j[p:p + 65536]
            dot = lead[u - a, v]
            for k, s in enumerate(starts[1:], 1):
                e = slice(s, s + STEP)
                dot = dot + np.einsum("ij,ij->i", x[u, e], y[v, e])
                on = dot + suffix_x[k + 1][u] * suffix_y[k + 1][v] >= least - SLACK
                u, v, dot = u[on], v[on], dot[on]
            yield u, v


def star_forest(i: np.ndarray, j: np.ndarray, rows: int, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """For links between row i and column j: the node that each row and column is put under, as a row number."""
    over, label = np.arange(rows), np.full(columns, rows, dtype=np.int64)
    while True:
        np.minimum.at(label, j, over[i])
        before = over.copy()
        np.minimum.at(over, i, label[j])
        over = np.minimum(over, over[over])
        if (over == before).all():
            return over, label


def compare(ids_a, raw_a, weight_a, ids_b, raw_b, weight_b, turn, least: float, same: bool):
    """(edges, counts) of a pair of tiles: arrays (a, b) and (id, links of it)."""
    unit_a, unit_b = unit(raw_a), unit(raw_b)
    count_a, count_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    edges = []
    for u, v in surviving(unit_a @ turn, unit_b @ turn, least):
        if same:
            u, v = u[u < v], v[u < v]
        for p in range(0, len(u), 65536):
            i, j = u[p:p + 65536], v[p:p + 65536]
            exact = np.einsum("ij,ij->i", unit_a[i], unit_b[j]) >= least
            i, j = i[exact], j[exact]
            if len(i):
                np.add.at(count_a, i, weight_b[j])
                np.add.at(count_b, j, weight_a[i])
                over, label = star_forest(i, j, len(ids_a), len(ids_b))
                rows, columns = np.flatnonzero(over != np.arange(len(ids_a))), np.flatnonzero(label < len(ids_a))
                edges.append((ids_a[over[rows]], ids_a[rows]))
                edges.append((ids_a[label[columns]], ids_b[columns]))
    return edges, [(ids_a, count_a), (ids_b, count_b)]


def linked_vectors(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    values = F.col("embedding").cast("array<double>")
    good = (F.size("e") > 0) & F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("e", lambda v: v != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), values.alias("e"))
    usable = rows.where(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False)))
    distinct = usable.groupBy("e").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    distinct = kept(distinct.select("id", "copies", "e"))

    # axes per vector length, from a bounded sample
    place, n = F.xxhash64("id"), distinct.count()
    few = distinct.where(F.pmod(place, F.lit(2**52)) < F.lit(min(1.0, 2 * FIT_ROWS / max(n, 1)) * 2**52))
    sample = few.orderBy(place, "id").limit(FIT_ROWS).select("e")
    by_length: dict[int, list] = {}
    for batch in sample.toArrow().to_batches():
        for v in batch.column(0):
            by_length.setdefault(len(v), []).append(v.values.to_numpy())
    turns, trees = {}, {}
    for d, v in by_length.items():
        points = unit(np.array(v, dtype=np.float64))
        turns[d] = axes(points)
        leaves = min(n * len(points) / max(1, sum(map(len, by_length.values()))) / TILE, len(points) / 16)
        trees[d] = Tree((points @ turns[d])[:, :BOXED], max(0, int(np.log2(max(1.0, leaves)))))

    def turned(d: int) -> np.ndarray:
        return turns[d] if d in turns else np.eye(d)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(2)])
            leaf, first = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows)
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                points = unit(matrix(batch.column(2).take(pa.array(at)))) @ turned(int(d))[:, :BOXED]
                first[at] = points[:, 0]
                if int(d) in trees:
                    leaf[at] = trees[int(d)].leaf(points)
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int32()), pa.array(leaf), pa.array(first), *batch.columns[:3]],
                                             ["d", "leaf", "x", "id", "copies", "e"])

    placed = kept(distinct.mapInArrow(project, "d int, leaf long, x double, id long, copies long, e array<double>")
                  .repartitionByRange("d", "leaf", "x").sortWithinPartitions("d", "leaf", "x", "id"))

    most = TILE

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, number = None, TaskContext.get().partitionId() << 33
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            key = rest["leaf"].to_numpy() * 2**20 + rest["d"].to_numpy()
            edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            for a, b in zip(edges, edges[1:]):
                while b - a >= most or a < b < len(key):  # a leaf that may go on waits for its other rows
                    yield tile(rest.slice(a, min(most, b - a)), number)
                    a, number = min(a + most, b), number + 1
            rest = rest.slice(a)
        if rest is not None and len(rest):
            yield tile(rest, number)

    def tile(t: pa.Table, number: int) -> pa.RecordBatch:
        raw = matrix(t["e"].combine_chunks())
        points = unit(raw) @ turned(raw.shape[1])[:, :BOXED]
        if (raw.astype(np.float32).astype(np.float64) == raw).all():  # the given values were single precision
            raw = raw.astype(np.float32)
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), pa.array([t["d"][0].as_py()], pa.int32()), pa.array([points.min(axis=0).tolist()]),
            pa.array([points.max(axis=0).tolist()]), pa.array([t["id"].to_numpy().tobytes()], pa.binary()),
            pa.array([t["copies"].to_numpy().tobytes()], pa.binary()), pa.array([raw.tobytes()], pa.binary())],
            ["tile", "d", "low", "high", "ids", "weights", "raw"])

    tiles = kept(placed.mapInArrow(fill, "tile long, d int, low array<double>, high array<double>, ids binary, weights binary, raw binary"))
    # unit vectors with this dot product are at most so far apart, and so are any of their coordinates together
    reach = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-6
    cell = F.lit(max(reach, 1e-3))
    spans = numbered(tiles.select("tile", "d", "low", "high"), "d", "tile")
    low, high = F.floor(F.col("low")[0] / cell), F.floor(F.col("high")[0] / cell)
    left = spans.withColumn("cell", F.explode(F.sequence(low, F.floor((F.col("high")[0] + reach) / cell))))
    right = spans.withColumn("cell", F.explode(F.sequence(low, high))).select(
        F.col("pos").alias("pos_b"), "d", F.col("low").alias("low_b"), F.col("high").alias("high_b"), "cell")

    def gap(k: int) -> Column:
        """Square of what lies between two boxes along an axis; vectors of fewer dimensions have no such axis."""
        between = F.greatest(F.get("low_b", F.lit(k)) - F.get("high", F.lit(k)), F.get("low", F.lit(k)) - F.get("high_b", F.lit(k)), F.lit(0.0))
        return between * between

    near = sum((gap(k) for k in range(1, BOXED)), gap(0)) <= reach * reach
    either_way = (F.col("low_b")[0] <= F.col("high")[0] + reach) & (F.col("low")[0] <= F.col("high_b")[0] + reach)
    # the cells order tiles by their first coordinate, not by their number
    met = left.join(right, ["d", "cell"]).where(either_way & near)
    pairs = met.select("d", F.least("pos", "pos_b").alias("a"), F.greatest("pos", "pos_b").alias("b")).distinct()
    pairs = pairs.withColumn("block_a", F.floor(F.col("a") / BLOCK)).withColumn("block_b", F.floor(F.col("b") / BLOCK))
    # every tile that the pairs of two blocks need, with the tiles it is compared with
    asked = pairs.select("block_a", "block_b", F.col("a").alias("pos"), F.col("b").alias("other")).union(
        pairs.select("block_a", "block_b", F.col("b").alias("pos"), F.lit(None).cast("long").alias("other")))
    asked = asked.groupBy("block_a", "block_b", "pos").agg(F.collect_list("other").alias("others"))
    body = tiles.join(spans.select("tile", "pos"), "tile").select("pos", "d", "ids", "weights", "raw")
    loaded = asked.join(body, "pos").select("block_a", "block_b", "pos", "others", "d", "ids", "weights", "raw")

    def run(table: pa.Table) -> pa.Table:
        bodies, made = {}, []
        rows = table.select(["pos", "others", "d", "ids", "weights", "raw"]).to_pylist()
        for r in rows:
            ids = np.frombuffer(r["ids"], np.int64)
            kind = np.float32 if len(r["raw"]) == len(ids) * r["d"] * 4 else np.float64
            bodies[r["pos"]] = ids, np.frombuffer(r["raw"], kind).reshape(len(ids), r["d"]), np.frombuffer(r["weights"], np.int64), r["d"]
        for r in rows:
            for other in r["others"]:
                (ids_a, raw_a, weight_a, d), (ids_b, raw_b, weight_b, _) = bodies[r["pos"]], bodies[other]
                edges, counts = compare(ids_a, raw_a.astype(np.float64), weight_a, ids_b, raw_b.astype(np.float64), weight_b, turned(d), least, r["pos"] == other)
                made += [pa.table([pa.array(u), pa.array(v), pa.nulls(len(u), pa.int64())], ["a", "b", "n"]) for u, v in edges]
                made += [pa.table([pa.array(u[n > 0]), pa.nulls(int((n > 0).sum()), pa.int64()), pa.array(n[n > 0])], ["a", "b", "n"]) for u, n in counts]
        return pa.concat_tables(made) if made else pa.table([pa.array([], pa.int64())] * 3, ["a", "b", "n"])

    found = kept(loaded.groupBy("block_a", "block_b").applyInArrow(run, COUNTS))
    # a vec_id with several different vectors joins them
    several = usable.groupBy("vec_id").agg(F.min("e").alias("p"), F.max("e").alias("q")).where("p <> q").select("vec_id")
    groups = distinct.select("e", "id", "copies")
    bridges = usable.join(several, "vec_id").join(groups, "e").select(F.col("id").alias("a"), F.col("vec_id").alias("b"))
    label = components(found.where("n IS NULL").select("a", "b").union(bridges))
    counts = found.where("n IS NOT NULL").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    known = (groups.join(counts, "id", "left").join(label, "id", "left")
             .select("e", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    usable_row = F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False))
    result = rows.withColumn("key", F.when(usable_row, F.col("e"))).select("vec_id", "key").join(
        known.withColumnRenamed("e", "key"), "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
