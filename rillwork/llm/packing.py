"""Packing token sequences by cutting-stock column generation.

A document's ids, with id 0 behind them, are cut into full sequences and a rest. The rests
are a cutting-stock problem over the histogram of their lengths, which has at
most ``LENGTH`` entries whatever the corpus: a linear program chooses how often each
pattern of lengths is used, a knapsack dynamic program over its prices finds the pattern
that improves it most, until none does or the gap to the lower bound is below ``GAP``. Counts
are rounded down, and the few rests left are filled up sequence by sequence with the subset that fits best.

The plan is applied where the pieces are: pieces of one length are ranked by (hash bucket,
doc_id, start), and the rank alone tells the sequence and the place in it. Ranks are
counted per (length, bucket), so no length is gathered in one task, whatever share of
the pieces it has.

Defined results: a null or empty text is one piece, id 0 alone. Rows with equal doc_ids are
documents of their own; equal rows get equal places in any order. A null doc_id stays
null. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillwork.llm.keep import kept, small_batches
from rillwork.llm.tokens import encoder

LENGTH = 1024
BUCKETS = 4096
GAP = 0.0005  # of sequences above the lower bound at which column generation may stop
ROUNDS = 600  # at which it stops in any case; the patterns found so far are a valid plan

Pattern = tuple[int, list[tuple[int, int]]]  # times used, [(length, copies)]


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of every piece of every row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            rows, starts, sizes, checks, totals = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), 0], dtype="<u4")
                raw, n = ids.tobytes(), len(ids)
                for start in range(0, n, length):
                    rows.append(row)
                    starts.append(start)
                    sizes.append(min(length, n - start))
                    checks.append(zlib.crc32(raw[4 * start:4 * (start + length)]))
                    totals.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(v, pa.int64()) for v in (starts, sizes, checks, totals))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def dearest(prices: np.ndarray, lengths: np.ndarray, demand: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable filling of ``room`` with at most ``demand`` of each length, by dynamic programming.

    The copies of a length are split into powers of two, each taken or not.
    """
    units = []
    for i in np.flatnonzero(prices > 1e-12).tolist():
        rest, k = int(min(demand[i], room // lengths[i])), 1
        while rest > 0:
            k = min(k, rest)
            units.append((i, k, k * int(lengths[i])))
            rest, k = rest - k, 2 * k
    best, taken = np.zeros(room + 1), np.zeros((len(units), room + 1), dtype=bool)
    for u, (i, k, size) in enumerate(units):
        value = best[:room + 1 - size] + k * prices[i]
        np.greater(value, best[size:], out=taken[u, size:])
        best[size:] = np.maximum(best[size:], value)
    column, c = np.zeros(len(lengths)), room
    for u in range(len(units) - 1, -1, -1):
        if taken[u, c]:
            i, k, size = units[u]
            column[i] += k
            c -= size
    return float(best[room]), column


class Relaxation:
    """The linear program over the patterns known so far, as a basis of one pattern for each length."""

    def __init__(self, lengths: np.ndarray, demand: np.ndarray, room: int):
        alone = np.minimum(room // lengths, demand)
        self.columns, self.inverse, self.use = np.diag(alone), np.diag(1 / alone), demand / alone

    def prices(self) -> np.ndarray:
        return self.inverse.sum(axis=0)

    def enter(self, column: np.ndarray) -> None:
        """Use the pattern as often as the others allow; the one that it uses up leaves."""
        change = self.inverse @ column
        grows = np.flatnonzero(change > 1e-9)
        ratio = np.maximum(self.use[grows], 0) / change[grows]
        out, step = grows[ratio.argmin()], ratio.min()
        self.use -= step * change
        self.use[out] = step
        self.inverse[out] /= change[out]
        others = np.flatnonzero(np.abs(change) > 1e-12)
        others = others[others != out]
        self.inverse[others] -= np.multiply.outer(change[others], self.inverse[out])
        self.columns[:, out] = column


def relaxed(lengths: np.ndarray, demand: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """(columns, use) of the linear program: one pattern a column and how often each is used, not yet whole.

    It begins with the patterns of a best-fit packing; the knapsack adds what they lack.
    """
    program, at = Relaxation(lengths, demand, room), {n: i for i, n in enumerate(lengths.tolist())}
    for _, content in fitted({n: int(k) for n, k in zip(lengths.tolist(), demand)}, room):
        column = np.zeros(len(lengths))
        for n, k in content:
            column[at[n]] = k
        if program.prices() @ column > 1 + 1e-9:
            program.enter(column)
    least = float(lengths @ demand) / room
    for _ in range(ROUNDS):
        if program.use.sum() <= least * (1 + GAP):
            break
        prices = program.prices()
        value, column = dearest(np.maximum(prices, 0), lengths, demand, room)
        if value <= 1 + 1e-9:
            break
        least = max(least, float(prices @ demand) / value)  # prices / value are feasible in the dual
        program.enter(column)
    return program.columns, np.maximum(program.use, 0)


def best_subset(left: dict[int, int], room: int) -> dict[int, int]:
    """Copies of the lengths that are left whose sum comes nearest to ``room``, the greatest length among them."""
    order = sorted((n for n in left if left[n]), reverse=True)
    first = order[0]
    reach, steps = 1 << first, []
    whole = (1 << (room + 1)) - 1
    for n in order:
        spare = left[n] - (n == first)
        for _ in range(min(spare, (room - first) // n)):
            grown = (reach | reach << n) & whole
            if grown == reach:
                break
            steps.append((n, reach))
            reach = grown
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {first: 1}
    for n, before in reversed(steps):
        if not before >> total & 1:
            chosen[n] = chosen.get(n, 0) + 1
            total -= n
    return chosen


def plan(histogram: dict[int, int], room: int = LENGTH) -> list[Pattern]:
    """Patterns that use every piece of ``histogram`` (length: count) exactly once."""
    found: list[Pattern] = []
    left = {n: k for n, k in histogram.items() if k}
    if left.get(room):
        found.append((left.pop(room), [(room, 1)]))
    lengths = np.array(sorted(left), dtype=np.int64)
    if len(lengths):
        columns, use = relaxed(lengths, np.array([left[n] for n in lengths.tolist()], dtype=float), room)
        for j in np.argsort(-use, kind="stable"):
            whole = int(use[j] + 1e-6)
            pattern = {int(lengths[i]): int(columns[i, j]) for i in np.flatnonzero(columns[:, j])}
            whole = min([whole, *(left[n] // k for n, k in pattern.items())])
            if whole:
                found.append((whole, sorted(pattern.items(), reverse=True)))
                for n, k in pattern.items():
                    left[n] -= whole * k
    return found + fitted(left, room)


def fitted(left: dict[int, int], room: int) -> list[Pattern]:
    """Patterns for the pieces that are left, filled up one after another."""
    found: list[Pattern] = []
    while left := {n: k for n, k in left.items() if k}:
        chosen = best_subset(left, room)
        whole = min(left[n] // k for n, k in chosen.items())
        found.append((whole, sorted(chosen.items(), reverse=True)))
        for n, k in chosen.items():
            left[n] -= whole * k
    return found


def spans(patterns: list[Pattern]) -> dict[int, list[np.ndarray]]:
    """For each length: first rank, first sequence, copies in a sequence and offset of its runs, by rank."""
    used: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for times, content in patterns:
        offset = 0
        for n, k in content:
            rows.setdefault(n, []).append((used.get(n, 0), sequence, k, offset))
            used[n] = used.get(n, 0) + times * k
            offset += n * k
        sequence += times
    return {n: [np.array(c, dtype=np.int64) for c in zip(*r)] for n, r in rows.items()}


def packed(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """Every piece with its sequence_id and its offset there."""
    cut = pieces(docs, tokenizer, length).withColumn(
        "bucket", F.pmod(F.xxhash64(F.col("doc_id"), F.col("start")), F.lit(BUCKETS)).cast("int"))
    cut = kept(cut)
    groups = cut.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # ``length`` rows at most
    places = spans(plan(histogram, length))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")
    starts = groups.select("length", "bucket", before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens"))
    ranked = cut.withColumn("inside", inside).join(starts, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("inside") - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                first, base, copies, begin = places[int(n)]
                k = np.searchsorted(first, rank[at], side="right") - 1
                there = rank[at] - first[k]
                sequence[at] = base[k] + there // copies[k]
                offset[at] = begin[k] + there % copies[k] * n
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(
        place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
