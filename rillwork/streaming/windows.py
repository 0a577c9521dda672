"""Windowed streams. The batch functions do the work; here come the watermarks."""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, functions as F

from rillwork.functions.scalar import seconds_of
from rillwork.operators import windows
from rillwork.streaming.runner import before_end

CELL = 16  # windows that share a row of the state


def tumbling(df: DataFrame, keys: Sequence[str], ts: str, delay: str, size: str, **aggs: Column) -> DataFrame:
    return windows.tumbling(df.withWatermark(ts, delay), keys, ts, size, **aggs)


def sliding(df: DataFrame, keys: Sequence[str], ts: str, delay: str, size: str, slide: str,
            **aggs: Column) -> DataFrame:
    return windows.sliding(df.withWatermark(ts, delay), keys, ts, size, slide, **aggs)


def sliding_counts(df: DataFrame, keys: Sequence[str], ts: str, delay: str, size: str, slide: str,
                   count: str = "n") -> DataFrame:
    """Rows per key and overlapping window: disjoint panes are counted first, and pane counts are spread over windows.

    The state has a row for each cell of up to ``CELL`` windows that begin one after the other, with a sum for each of them. A row costs
    one pane; a pane of a key costs as many cells as overlap it, two if ``CELL`` windows or fewer do. A cell's windows are told together,
    when the last one closes.
    """
    length, step = seconds_of(size), seconds_of(slide)
    n = min(-(-length // step), CELL)
    panes = (df.withWatermark(ts, delay).groupBy(*keys, F.window(ts, f"{gcd(length, step)} seconds").alias("__pane"))
             .agg(F.count(F.lit(1)).alias("__n")))
    cell = F.window(F.window_time("__pane"), f"{(n - 1) * step + length} seconds", f"{n * step} seconds")
    spread = panes.select(*keys, "__pane", "__n", cell.alias("__cell"))
    begin = F.unix_micros("__cell.start")
    after = F.unix_micros("__pane.start") - begin
    inside = [(after >= i * step * 1_000_000) & (after < (i * step + length) * 1_000_000) for i in range(n)]
    cells = spread.groupBy(*keys, "__cell").agg(*[F.sum(F.when(c, F.col("__n"))).alias(f"__{i}") for i, c in enumerate(inside)])
    counts = cells.select(*keys, begin.alias("__begin"), F.posexplode(F.array(*[f"__{i}" for i in range(n)])).alias("__i", count))
    start = F.col("__begin") + F.col("__i").cast("long") * step * 1_000_000
    return counts.filter(F.col(count).isNotNull()).select(
        *keys, F.timestamp_micros(start).alias("window_start"), F.timestamp_micros(start + length * 1_000_000).alias("window_end"), count)


def session(df: DataFrame, keys: Sequence[str], ts: str, delay: str, gap: str, **aggs: Column) -> DataFrame:
    """Sessions close when the watermark has passed their last row by ``gap``."""
    grouped = df.withWatermark(ts, delay).groupBy(*keys, F.session_window(ts, gap).alias("__w"))
    return grouped.agg(*[c.alias(n) for n, c in aggs.items()]).select(
        *keys, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *aggs)


def distinct_counts(df: DataFrame, ts: str, delay: str, size: str, value: str, name: str = "uv") -> DataFrame:
    """Exact distinct values per window: the first row of each (window, value) is counted, then state is dropped."""
    firsts = (df.withWatermark(ts, delay).select(F.window(ts, size).alias("__w"), value)
              .dropDuplicates(["__w", value]))
    return (firsts.groupBy("__w").agg(F.count(F.lit(1)).alias(name))
            .select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), name))


def distinct_rows(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """The first row of every key; repeats that come within ``delay`` of it are dropped, and then the key is forgotten."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def sliding_sketch_counts(df: DataFrame, ts: str, delay: str, size: str, slide: str, value: str, name: str = "uv", log2_k: int = 12) -> DataFrame:
    """Estimated distinct values per overlapping window: the state holds a sketch of fixed size per pane and window, and no values."""
    pane = f"{gcd(seconds_of(size), seconds_of(slide))} seconds"
    panes = df.withWatermark(ts, delay).groupBy(F.window(ts, pane).alias("__pane")).agg(F.hll_sketch_agg(value, log2_k).alias("__sketch"))
    united = panes.groupBy(F.window(F.window_time("__pane"), size, slide).alias("__w")).agg(F.hll_union_agg("__sketch").alias("__sketch"))
    return united.select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), F.hll_sketch_estimate("__sketch").alias(name))


def sliding_bitmap_parts(df: DataFrame, ts: str, delay: str, size: str, slide: str, number: str, name: str = "uv") -> DataFrame:
    """Distinct whole numbers per overlapping window and bucket of numbers, from bitmaps; the sum over its buckets is a window's count.

    Null numbers come as a null bucket, to be left out of the results: a filter here would be moved before the watermark.
    """
    pane, value = f"{gcd(seconds_of(size), seconds_of(slide))} seconds", F.col(number).cast("long")
    bucket = F.bitmap_bucket_number(value).alias("__bucket")
    panes = df.withWatermark(ts, delay).groupBy(F.window(ts, pane).alias("__pane"), bucket).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("__bits"))
    united = panes.groupBy(F.window(F.window_time("__pane"), size, slide).alias("__w"), "__bucket").agg(F.bitmap_or_agg("__bits").alias("__bits"))
    return united.select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), F.col("__bucket").alias("bucket"),
                         F.bitmap_count("__bits").alias(name))


def refiring_counts(df: DataFrame, keys: Sequence[str], ts: str, size: str, bound: float, lateness: float) -> DataFrame:
    """Counts for update mode: a window reports again for each batch that adds to it, until ``bound + lateness``
    has passed."""
    return windows.tumbling(df.withWatermark(ts, f"{bound + lateness} seconds"), keys, ts, size,
                            n=F.count(F.lit(1)))


def rank_closed_windows(keys: Sequence[str], n: int, count: str = "clicks"):
    """For ``each_batch``: all counts of a window close in the same micro-batch, so it can be ranked there,
    with the batch ranking and without holding the window in state again."""
    def rank(closed: DataFrame) -> DataFrame:
        closed = closed.filter(before_end("window_end"))  # the closing row of a replay takes no rank
        return windows.top_n(closed, ["window_end"], [F.col(count).desc(), *[F.col(k).asc() for k in keys]], n)
    return rank
