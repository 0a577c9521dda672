"""Merkle manifest of a dataset, with a version of the tree for every changed leaf.

A leaf is the hash of a document's fields. Per source, leaves stand in the order of
doc_id, and every ``FAN`` consecutive nodes become one until one is left, the
subroot; the subroots, in the order of the sources, become the root in the same way.

The tree is built in aligned blocks of ``BLOCK`` nodes: one row holds a block, a task
folds it, and the blocks' roots are the nodes of the next round, so no task holds more than a block
whatever the size of a source. Nodes are never changed. A changed leaf makes a *version* by path
copying: only the ancestors of the leaf are made anew, inside its block first and then along
the way up from the block, and every other node is that of the first version. ``Manifest.versions``
lists the copied nodes of each version, ``Manifest.nodes`` the nodes they share: node ``i`` of level ``k`` of a
version is ``copied[k]`` if ``i`` is the leaf's own ancestor there, else the shared one.

On the way down every block gets the siblings on its way to the root once, for all its versions.

Defined results: a null field is hashed as ``-``; text is hashed whole, however long. Rows of one source with equal doc_ids
stand in the order of their hashes, equal rows in any, and have a leaf each. Null doc_ids stand last and are never changed.
Null is a source of its own, before the others. An empty table has no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.llm.keep import kept, numbered, small_batches

FAN = 16
ROUND = 2  # levels of the tree in a block
BLOCK = FAN ** ROUND
DIGEST = 64  # hexadecimal digits of a node
SIDES = "array<struct<left: string, right: string>>"
_SIDES = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
_HIGHEST = 15  # levels over 16 ** 15 leaves, more than a long counts


def node_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Block:
    """Consecutive nodes and what is above them, ``height`` levels up; nothing in it changes once it is made."""

    def __init__(self, nodes: list[str], height: int):
        self.levels, self.runs = [nodes], []
        for _ in range(height):
            below = self.levels[-1]
            runs = ["".join(below[i:i + FAN]) for i in range(0, len(below), FAN)]
            self.runs.append(runs)
            self.levels.append([node_of(r) for r in runs])

    def way_up(self, i: int) -> list[tuple[str, str]]:
        """The siblings before and behind the node's ancestors, level by level."""
        sides = []
        for runs in self.runs:
            i, place = divmod(i, FAN)
            sides.append((runs[i][:DIGEST * place], runs[i][DIGEST * (place + 1):]))
        return sides


def version(node: str, sides: list[tuple[str, str]]) -> list[str]:
    """The nodes that a version copies if ``node`` is new: itself and its ancestors, which keep their other children."""
    copied = [node]
    for left, right in sides:
        copied.append(node_of(left + copied[-1] + right))
    return copied


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(text: Column) -> Column:
    """The leaf of a row of ``documents`` with this text."""
    return F.sha2(F.concat(_field(F.col("doc_id").cast("long")), _field(F.col("source")), _field(F.col("lang")),
                           _field(F.col("n_chars").cast("long")), _field(text)), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _height(n: Column) -> Column:
    """Levels above ``n`` nodes."""
    return sum(((n > FAN ** k).cast("int") for k in range(_HIGHEST)), F.lit(0))


def _block_rows(nodes: DataFrame, number: int, *carried: str) -> DataFrame:
    """(tree, n, block, steps, nodes, root): aligned blocks of the nodes (tree, n, idx, digest) of one round, a row each.

    ``steps`` are the levels a block goes up in this round, ``root`` the node at its top.
    """
    entry = F.struct("idx", "digest", *carried)
    rows = (nodes.groupBy("tree", "n", F.shiftright("idx", 4 * ROUND).alias("block"))
            .agg(F.sort_array(F.collect_list(entry)).alias("nodes"))
            .withColumn("steps", F.least(F.lit(ROUND), F.greatest(F.lit(0), _height(F.col("n")) - ROUND * number))))
    names = rows.columns

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = zip(_digests(batch, "digest"), batch.column("steps").to_pylist())
            roots = [Block(nodes, steps).levels[-1][0] for nodes, steps in blocks]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(roots, pa.string())], [*names, "root"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return kept(rows.mapInArrow(fold, f"{schema}, root string"))


def _digests(batch: pa.RecordBatch, field: str) -> Iterator[list]:
    """A field of the nodes of every block."""
    column = batch.column("nodes")
    flat, ends = column.values.field(field), column.offsets.to_pylist()
    for begin, end in zip(ends, ends[1:]):
        yield flat.slice(begin, end - begin).to_pylist()


def _grown(nodes: DataFrame, most: int, *carried: str) -> list[DataFrame]:
    """The blocks of every round, up to trees of ``most`` nodes."""
    rounds = [_block_rows(nodes, 0, *carried)]
    while most > FAN ** (ROUND * len(rounds)):
        open_trees = rounds[-1].where(_height(F.col("n")) > ROUND * len(rounds))
        rounds.append(_block_rows(open_trees.select("tree", "n", F.col("block").alias("idx"), F.col("root").alias("digest")), len(rounds)))
    return rounds


def _tops(rounds: list[DataFrame]) -> DataFrame:
    """(tree, top): the node that remains of every tree."""
    done = [blocks.where((_height(F.col("n")) <= ROUND * (r + 1)) & (_height(F.col("n")) > ROUND * r if r else F.lit(True)))
            .select("tree", F.col("root").alias("top")) for r, blocks in enumerate(rounds)]
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _sides_below(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, block, sides) of every node of ``blocks``, which is a block of the round below; ``above`` has those of the blocks."""
    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees, numbers, sides = [], [], []
            rows = zip(batch.column("tree").to_pylist(), batch.column("steps").to_pylist(), _digests(batch, "idx"),
                       _digests(batch, "digest"), batch.column("sides").to_pylist())
            for tree, steps, idx, digests, up in rows:
                block, up = Block(digests, steps), [(s["left"], s["right"]) for s in up]
                for i, number in enumerate(idx):
                    trees.append(tree)
                    numbers.append(number)
                    sides.append([{"left": a, "right": b} for a, b in block.way_up(i) + up])
            yield pa.RecordBatch.from_arrays([pa.array(trees, pa.int64()), pa.array(numbers, pa.int64()),
                                              pa.array(sides, _SIDES)], ["tree", "block", "sides"])

    joined = blocks.join(above, ["tree", "block"]).select("tree", "steps", "nodes", "sides")
    return joined.mapInArrow(descend, f"tree long, block long, sides {SIDES}")


def _sides_of_blocks(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(tree, block, sides) of the blocks of round 0: the way from each block to the root of all; ``tops`` (tree, sides) has the trees'."""
    above = None
    for r in range(len(rounds) - 1, -1, -1):
        height = _height(F.col("n"))
        last = rounds[r].where((height <= ROUND * (r + 1)) & (height > ROUND * r if r else F.lit(True)))
        from_tops = last.select("tree", "block").join(tops, "tree").select("tree", "block", "sides")
        above = from_tops if above is None else above.unionByName(from_tops)
        if r:
            above = _sides_below(rounds[r], above)
    return above


@dataclass(frozen=True)
class Manifest:
    """``sources`` (tree, source, n, subroot), ``rounds`` of blocks over the documents, ``upper`` those over the subroots, ``sides``
    (tree, block, sides, subroot) of the blocks of documents, and the ``root`` (None if there are no documents)."""

    sources: DataFrame
    rounds: list[DataFrame]
    upper: list[DataFrame]
    sides: DataFrame
    root: str | None

    def nodes(self) -> DataFrame:
        """(tree, level, idx, digest): the nodes of the first version, which all versions share; tree -1 stands over the subroots."""
        def listed(number: int):
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    out = []
                    rows = zip(batch.column("tree").to_pylist(), batch.column("block").to_pylist(), batch.column("steps").to_pylist(), _digests(batch, "digest"))
                    for tree, block, steps, digests in rows:
                        for k, level in enumerate(Block(digests, steps).levels):
                            if k or not number:  # the nodes below are the roots of the round before
                                out += [(tree, ROUND * number + k, block * FAN ** (ROUND - k) + i, d) for i, d in enumerate(level)]
                    columns = list(zip(*out)) or [()] * 4
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.string()))],
                                                     ["tree", "level", "idx", "digest"])
            return run

        out = None
        for rounds in (self.rounds, self.upper):
            for number, blocks in enumerate(rounds):
                part = blocks.select("tree", "block", "steps", "nodes").mapInArrow(listed(number), "tree long, level int, idx long, digest string")
                out = part if out is None else out.unionByName(part)
        return out

    def versions(self) -> DataFrame:
        """Per document: doc_id, tree, idx, leaf, subroot, root, proof_sha256, version_leaf, copied, folded_root, verified.

        ``version_leaf`` is the changed leaf, or the leaf itself where nothing was changed; ``copied`` are the nodes of its version from
        the leaf up to ``folded_root``; it is verified if that is the root.
        """
        root = self.root
        kinds = [("doc_id", pa.int64()), ("tree", pa.int64()), ("idx", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("proof_sha256", pa.string()),
                 ("version_leaf", pa.string()), ("copied", pa.list_(pa.string())), ("folded_root", pa.string()), ("verified", pa.bool_())]

        def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                rows = zip(*(batch.column(c).to_pylist() for c in ("tree", "subroot", "steps", "sides")), *(_digests(batch, f) for f in ("idx", "doc_id", "digest", "changed")))
                for tree, subroot, steps, up, idx, ids, leaves, changed in rows:
                    block, up = Block(leaves, steps), [(s["left"], s["right"]) for s in up]
                    rest = "".join(a + b for a, b in up)
                    for i, (number, doc_id, leaf, new) in enumerate(zip(idx, ids, leaves, changed)):
                        inside = block.way_up(i)
                        copied = version(new or leaf, inside + up)
                        proof = node_of("".join(a + b for a, b in inside) + rest)
                        out.append((doc_id, tree, number, leaf, subroot, proof, new or leaf, copied, copied[-1], copied[-1] == root))
                columns = list(zip(*out)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], [n for n, _ in kinds])

        way = self.rounds[0].join(self.sides, ["tree", "block"]).select("tree", "subroot", "steps", "nodes", "sides")
        rows = way.mapInArrow(climb, "doc_id long, tree long, idx long, leaf string, subroot string, proof_sha256 string, version_leaf string, "
                                     "copied array<string>, folded_root string, verified boolean")
        return rows.withColumn("root", F.lit(root).cast("string"))


def manifest(docs: DataFrame, changed_text: Column | None = None, where: Column | None = None) -> Manifest:
    """The tree over ``docs`` (doc_id, source, lang, n_chars, text); ``changed_text`` is what the text became ``where`` it was changed."""
    spark = docs.sparkSession
    small_batches(spark)
    changed = F.lit(None).cast("string") if changed_text is None else leaf_of(changed_text)
    if where is not None:
        changed = F.when(where, changed)
    leaves = kept(docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string").alias("source"),
                              leaf_of(F.col("text")).alias("digest"), changed.alias("changed")))
    placed = numbered(leaves, "source", "doc_id", "digest")
    starts = placed.groupBy("source").agg(F.min("pos").alias("first"), F.count("*").alias("n"))
    ranked = numbered(starts.withColumn("named", F.col("source").isNotNull()), "named", "source").drop("named").withColumnRenamed("pos", "tree")
    of_source = [placed["source"].eqNullSafe(ranked["source"])]
    nodes = placed.join(ranked, of_source).select(
        "tree", "n", (F.col("pos") - F.col("first")).alias("idx"), placed["doc_id"], placed["digest"], placed["changed"])
    size = ranked.agg(F.max("n").alias("most"), F.count("*").alias("sources")).first()
    rounds = _grown(nodes, size["most"] or 0, "doc_id", "changed")
    sources = kept(ranked.join(_tops(rounds), "tree").select("tree", "source", "n", F.col("top").alias("subroot")))
    subroots = sources.select(F.lit(-1).cast("long").alias("tree"), F.lit(size["sources"]).cast("long").alias("n"),
                              F.col("tree").alias("idx"), F.col("subroot").alias("digest"))
    upper = _grown(subroots, size["sources"])
    top = _tops(upper).first()
    nothing = spark.createDataFrame([(-1, [])], f"tree long, sides {SIDES}")
    over_sources = _sides_of_blocks(upper, F.broadcast(nothing))
    of_trees = _sides_below(upper[0], over_sources).select(F.col("block").alias("tree"), "sides")
    sides = kept(_sides_of_blocks(rounds, of_trees).join(sources.select("tree", "subroot"), "tree"))
    return Manifest(sources, rounds, upper, sides, top["top"] if top else None)


def tampered(docs: DataFrame) -> Manifest:
    """The manifest of ``docs`` with the text of every document lower-cased whose crc32(doc_id) can be divided by 5."""
    where = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("long").cast("string")) % 5 == 0)
    return manifest(docs, lower_ascii(F.col("text")), where)
