"""Near-duplicate documents by min-max hashing.

Every permutation gives two signature values, its minimum and its maximum over
the shingles of a text, so a signature of 200 values takes 100 hash
evaluations per shingle. Bands of five minima or five maxima are the buckets.
Both values agree with a probability equal to the Jaccard similarity; a pair at 0.8
misses all 40 bands with probability (1 - 0.8**5)**40, about 1e-7.
Links are confirmed on the full shingle sets, recomputed from the texts.

Defined results: null and empty texts, and texts without words, have 0 shingles
and link with nothing. A null doc_id links with nothing, has a null component and
is kept. Rows that share a doc_id are one document, similar to another if any of their texts
is. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm import links
from rillwork.llm.keep import kept, small_batches
from rillwork.llm.shingles import Permutations, mix, shingle_sets

PERMUTATIONS = 100
BAND = 5
SEED = 20240501
#: Share of equal signature bytes six standard deviations below that of a pair at 0.8.
LEAST_ALIKE = 0.63


def band_keys(values: np.ndarray, band: int, kind: int) -> np.ndarray:
    """One 64-bit key per band of ``band`` values; ``kind`` keeps bands of minima and maxima apart."""
    rows = values[:len(values) // band * band].reshape(-1, band)
    key = mix(np.arange(len(rows), dtype=np.uint64) * np.uint64(2) + np.uint64(kind))
    for c in range(band):
        key = mix(key ^ rows[:, c])
    return key.view(np.int64)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, size, class, sig, keys) of every row; class names the shingle set, null if empty."""
    small_batches(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        perms = Permutations(PERMUTATIONS, SEED)
        for batch in batches:
            sizes, classes, sigs, keys = [], [], [], []
            for _, shingles in shingle_sets(batch.column(1), words):
                sizes.append(len(shingles))
                if len(shingles):
                    low, high = perms.extremes(shingles)
                    classes.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                    sigs.append(np.concatenate([low, high]).astype(np.uint8).tobytes())
                    keys.append(np.concatenate([band_keys(low, BAND, 0), band_keys(high, BAND, 1)]))
                else:
                    classes.append(None)
                    sigs.append(None)
                    keys.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(sigs, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "size", "class", "sig", "keys"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        sign, "doc_id long, size long, class binary, sig binary, keys array<long>")


def confirmed(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Of the kept ``pairs`` (a, b) of doc_ids those with 100 * intersection >= percent * union of their shingle sets."""
    ids = kept(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    texts = links.only(docs, "doc_id", ids).select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    both = (pairs.join(texts.withColumnsRenamed({"id": "b", "text": "text_b"}), "b")
            .join(texts.withColumnsRenamed({"id": "a", "text": "text_a"}), "a").select("a", "b", "text_a", "text_b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_set = None, None
        for batch in batches:
            texts_a = batch.column(2)
            true = np.zeros(batch.num_rows, dtype=bool)
            for row, other in shingle_sets(batch.column(3), words):
                text = texts_a[row].as_py()
                if text != known:
                    known, known_set = text, next(shingle_sets(pa.array([text], pa.string()), words))[1]
                shared = len(np.intersect1d(known_set, other, assume_unique=True))
                true[row] = shared and 100 * shared >= percent * (len(known_set) + len(other) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(true))

    return both.mapInArrow(check, "a long, b long").distinct()


def shortened(docs: DataFrame, words: int):
    """For ``links.in_buckets``: the shortened shingle sets of the documents with given ids."""
    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(len(shingles), links.shorten(shingles)) for _, shingles in shingle_sets(batch.column(1), words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in sets], pa.int64()),
                                              pa.array([b for _, b in sets], pa.binary())], ["id", "size", "short"])

    return lambda ids: links.only(docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")), "id", ids).mapInArrow(
        short, "id long, size long, short binary")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    signed = kept(signatures(docs, words))
    linked = signed.where("doc_id IS NOT NULL AND class IS NOT NULL")
    classes = kept(linked.groupBy("class").agg(F.min("doc_id").alias("id")))
    items = kept(linked.join(classes, "class").where("doc_id = id").dropDuplicates(["class"]).select("id", "size", "sig", "keys"))
    found = links.in_buckets(items, percent, LEAST_ALIKE, shortened(docs, words), lambda pairs: confirmed(docs, pairs, words, percent))
    # a doc_id that stands in several classes joins them
    same = linked.join(classes, "class").where("doc_id <> id").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    several = linked.groupBy("doc_id").agg(F.min("class").alias("c"), F.max("class").alias("d")).where("c < d").select(F.col("doc_id").alias("b"))
    label = links.components(found.union(same.join(several, "b").select("a", "b")))
    named = classes.join(label, "id", "left").select("class", F.coalesce("component", "id").alias("component"))
    result = signed.select("doc_id", "size", "class").join(named, "class", "left")
    component = F.coalesce("component", "doc_id")
    return result.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the document with the smallest doc_id stays.

    Rows that share a doc_id are one document; one of them stays. Rows with a null doc_id all stay.
    """
    found = kept(near_duplicates(docs, words, percent).where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(
        F.bool_and("kept").alias("kept"), F.count("*").alias("n")))
    rest = links.only(docs, "doc_id", found.where("NOT kept").select("id"), "left_anti")
    repeated = found.where("kept AND n > 1").select("id")
    if repeated.isEmpty():
        return rest
    return links.only(rest, "doc_id", repeated, "left_anti").union(links.only(rest, "doc_id", repeated).dropDuplicates(["doc_id"]))
