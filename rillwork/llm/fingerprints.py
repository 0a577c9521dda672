"""Document fingerprints by MinHash.

A fingerprint is the minimum of each of 128 universal hash permutations over the
distinct five-word shingles of a text, 16 bits of each, in hexadecimal. The
likeness of two fingerprints is the share of equal values, an estimate of the
Jaccard similarity of the shingle sets. ``similar`` finds similar documents: bands of
the signature are joined in Spark and the similarity is verified on full sets.

Defined results: a null text is an empty one; a text without words has the
fingerprint of the empty set, which is alike (1.0) to itself only; a text of
fewer than five words has its word sequence as its one shingle. Repeated
doc_ids are ordered by text. A document with a null doc_id has a place in no order, so it has no next
document: nothing replaces the end of its text and ``near_next`` is null.
Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm import links, near_dedup
from rillwork.llm.keep import kept, small_batches
from rillwork.llm.shingles import Permutations, shingle_sets

PERMUTATIONS = 128
WORDS = 5
BAND = 4  # 32 bands: a pair at 0.8 misses all with probability (1 - 0.8**4)**32, about 5e-8
SEED = 977
#: Share of equal signature bytes six standard deviations below that of a pair at 0.8.
LEAST_ALIKE = 0.59


def signatures(texts: pa.Array) -> np.ndarray:
    """One row of 128 unsigned 32-bit values per text."""
    perms = Permutations(PERMUTATIONS, SEED)
    out = np.zeros((len(texts), PERMUTATIONS), dtype=np.uint32)
    for row, shingles in shingle_sets(texts, WORDS):
        out[row] = perms.minima(shingles)
    return out


def written(signs: np.ndarray) -> list[str]:
    """Fingerprints as strings: the upper 16 bits of each value."""
    return [row.tobytes().hex() for row in (signs >> 16).astype(">u2")]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal 16-bit values, row by row."""
    return ((a >> 16) == (b >> 16)).mean(axis=1)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(written(signatures(batch.column(1))), pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        sign, "doc_id long, fingerprint string")


def similar(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, component_id) of documents joined by links of at least ``percent`` similarity.

    Equal shingle sets are one class before bands are joined. Documents without
    words or doc_id are left out.
    """
    small_batches(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        perms = Permutations(PERMUTATIONS, SEED)
        for batch in batches:
            rows, sizes, classes, sigs, keys = [], [], [], [], []
            for row, shingles in shingle_sets(batch.column(1), WORDS):
                if len(shingles):
                    low = perms.minima(shingles)
                    rows.append(row)
                    sizes.append(len(shingles))
                    classes.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                    sigs.append(low.astype(np.uint8).tobytes())
                    keys.append(near_dedup.band_keys(low, BAND, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()),
                 pa.array(sigs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "size", "class", "sig", "keys"])

    named = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id IS NOT NULL")
    signed = kept(named.mapInArrow(sign, "doc_id long, size long, class binary, sig binary, keys array<long>"))
    classes = kept(signed.groupBy("class").agg(F.min("doc_id").alias("id")))
    items = kept(signed.join(classes, "class").where("doc_id = id").dropDuplicates(["class"]).select("id", "size", "sig", "keys"))
    found = links.in_buckets(items, percent, LEAST_ALIKE, near_dedup.shortened(named, WORDS), lambda pairs: near_dedup.confirmed(named, pairs, WORDS, percent))
    label = links.components(found)
    return signed.select("doc_id", "class").join(classes, "class").join(label, "id", "left").select(
        "doc_id", F.coalesce("component", "id").alias("component_id"))


def with_next(docs: DataFrame) -> DataFrame:
    """(place, doc_id, text, lent) so that each document and its next one stand in one partition, in order.

    The documents are dealt by ranges of doc_id that begin at existing ids; the
    first of each range is lent to the range before. The driver holds one id
    per shuffle partition. Rows without doc_id have negative places.
    """
    named = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / parts for i in range(parts)]
    found = named.agg(F.min("doc_id").alias("least"), F.percentile_approx("doc_id", shares, 10 * parts).alias("starts")).first()
    starts = np.array(sorted({found["least"], *(found["starts"] or [])} - {None}), dtype=np.int64)

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        here = np.searchsorted(starts, ids.to_numpy(), side="right") - 1
        first = starts[here] == ids.to_numpy()
        ends = np.cumsum(1 + first)
        pairs = np.stack([here, (here - 1) % len(starts)], axis=1).astype(np.int32)
        return pd.Series(np.split(pairs[np.stack([np.ones_like(first), first], axis=1)], ends[:-1]))

    anywhere = F.array((-1 - F.pmod(F.xxhash64("text"), F.lit(parts))).cast("int"))
    ordered = named.where("doc_id IS NOT NULL").withColumn("places", places("doc_id"))
    dealt = ordered.union(named.where("doc_id IS NULL").withColumn("places", anywhere)).select(
        F.posexplode("places").alias("lent", "place"), "doc_id", "text")
    return dealt.repartitionById(parts, F.pmod("place", F.lit(parts))).sortWithinPartitions("place", "lent", "doc_id", "text").select(
        "place", "doc_id", "text", "lent")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and what is alike.

    The edited text: the last floor(n_chars / 4) code points are replaced by the
    first as many (or all) of the next document's text.
    """
    small_batches(docs.sparkSession)

    def digest(place, doc_id, text, following, signs, next_signs):
        edited = []
        for t, n in zip(text, following):
            cut = len(t) // 4
            edited.append(t[:len(t) - cut] + (n or "")[:cut])
        other = signatures(pa.array(edited, pa.large_string()))
        near = likeness(signs, next_signs)
        return pa.RecordBatch.from_arrays([
            pa.array(doc_id, pa.int64()), pa.array([len(t) for t in text], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array(written(signs), pa.string()), pa.array(written(other), pa.string()),
            pa.array(likeness(signs, other), pa.float64()),
            pa.array(near, pa.float64(), mask=np.array([n is None for n in following], dtype=bool))],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the last row seen, which may still get a next one
        for batch in batches:
            place, doc_id, lent = (batch.column(i).to_pylist() for i in (0, 1, 3))
            text, signs = batch.column(2).to_pylist(), signatures(batch.column(2))
            if waiting is not None:
                place, doc_id, lent, text = [waiting[0], *place], [waiting[1], *doc_id], [waiting[2], *lent], [waiting[3], *text]
                signs = np.concatenate([waiting[4], signs])
            last = len(place) - 1
            waiting = (place[last], doc_id[last], lent[last], text[last], signs[last:])
            yield from done(place, doc_id, lent, text, signs, range(last))
        if waiting is not None:
            place, doc_id, lent, text = ([v] for v in waiting[:4])
            yield from done(place, doc_id, lent, text, waiting[4], range(1))

    def done(place, doc_id, lent, text, signs, rows):
        rows = [r for r in rows if not lent[r]]
        follows = [r + 1 if r + 1 < len(place) and place[r + 1] == place[r] and place[r] >= 0 else None for r in rows]
        if rows:
            yield digest([place[r] for r in rows], [doc_id[r] for r in rows], [text[r] for r in rows],
                         [None if f is None else text[f] for f in follows], signs[rows],
                         signs[[r if f is None else f for r, f in zip(rows, follows)]])

    return with_next(docs).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
