"""Time, session and count windows, and top-n per window.

Windows are half open and aligned to the epoch. All of them aggregate before
the shuffle, so a hot key or a crowded window costs a few rows per map task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import gcd

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rillwork.functions.scalar import epoch_micros, floor_div, seconds_of
from rillwork.operators.ordered import Near, Running, number_rows, running, same_keys, scan


def tumbling(df: DataFrame, keys: Sequence[str], ts: str, size: str, **aggs: Column) -> DataFrame:
    """Aggregates per key and window; without keys one group per window."""
    return _flat(df.groupBy(*keys, F.window(ts, size).alias("__w")), keys, aggs)


def sliding(df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str, **aggs: Column) -> DataFrame:
    """Aggregates per key and overlapping window, for any aggregate; see ``sliding_counts``."""
    return _flat(df.groupBy(*keys, F.window(ts, size, slide).alias("__w")), keys, aggs)


def process(df: DataFrame, keys: Sequence[str], ts: str, size: str, function: Callable[[pd.DataFrame], pd.DataFrame],
            schema: str) -> DataFrame:
    """``function`` over all rows of a key and window, which carry ``window_start`` and ``window_end``.

    The rows of one (key, window) must fit into a task: what can be said as an
    aggregate belongs in ``tumbling``, which takes user accumulators as grouped-aggregate Pandas UDFs.
    """
    window = F.window(ts, size)
    rows = df.withColumn("window_start", window["start"]).withColumn("window_end", window["end"])
    return rows.groupBy(*keys, "window_start", "window_end").applyInPandas(function, schema)


def session(df: DataFrame, keys: Sequence[str], ts: str, seq: str, gap: str,
            cell: float | None = None, **aggs: Column) -> DataFrame:
    """Aggregates per key and session; a row exactly ``gap`` after the last one still belongs to it.

    The built-in session window sends every row of a key to one task. Rows of
    one cell as long as the gap always share a session, so only (key, cell)
    pairs are put in order, combined before the shuffle; sessions are then ordinary groups.
    So no row id and no other cells are needed: ``seq`` and ``cell`` stand for callers that give them.
    """
    pause = F.expr(f"interval {gap}")
    rows = df.withColumn("__gap", floor_div(epoch_micros(F.col(ts)), seconds_of(gap) * 1_000_000))
    cells = rows.groupBy(*keys, "__gap").agg(F.min(ts).alias("__from"), F.max(ts).alias("__to"))
    # A key has as many cells as gaps fit into its time, whatever its rows.
    ordered = Window.partitionBy(*keys).orderBy("__gap")
    before = F.max("__to").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("__before").isNull() | (F.col("__from") > F.col("__before") + pause), F.col("__from"))
    cells = cells.withColumn("__before", before).withColumn("__opens", opens)
    cells = cells.withColumn("window_start", F.max("__opens").over(ordered))
    cells = cells.select(*[F.col(k).alias("__s_" + k) for k in [*keys, "__gap"]], "window_start")
    return (rows.join(cells, same_keys([*keys, "__gap"], "__s_")).groupBy(*keys, "window_start")
            .agg((F.max(ts) + pause).alias("window_end"), *[c.alias(n) for n, c in aggs.items()]))


def _flat(grouped, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    return grouped.agg(*[c.alias(n) for n, c in aggs.items()]).select(
        *keys, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *aggs)


def _panes(ts: str, size: str, slide: str) -> tuple[Column, int, int, int]:
    """Number of the row's pane since the epoch, panes per window, panes per slide, and microseconds per pane.

    A pane is as long as the greatest common divisor, so any size goes with any slide.
    """
    whole, step = seconds_of(size), seconds_of(slide)
    length = gcd(whole, step)
    return floor_div(epoch_micros(F.col(ts)), length * 1_000_000), whole // length, step // length, length * 1_000_000


def _pane_time(pane: Column, length: int, kind: T.DataType) -> Column:
    return F.timestamp_micros(pane * length).cast(kind)


def sliding_counts(df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str, name: str = "n") -> DataFrame:
    """Row counts per key and overlapping window, built from panes.

    Rows are first counted in disjoint panes; only the pane counts are spread
    over the windows they belong to. Every row is handled once instead of size/slide times.
    """
    pane, per_window, step, length = _panes(ts, size, slide)
    counts = df.groupBy(*keys, pane.alias("__pane")).agg(F.count(F.lit(1)).alias(name))
    # Whole numbers as window keys keep the second aggregation in generated code.
    windows_ago = F.explode(F.array(*[F.lit(i) for i in range(-(-per_window // step))]))
    spread = counts.select(*keys, name, "__pane", windows_ago.alias("__i"))
    spread = spread.withColumn("__first", floor_div(F.col("__pane"), step) - F.col("__i"))
    if per_window % step:
        spread = spread.filter(F.col("__first") * step + per_window > F.col("__pane"))
    totals = spread.groupBy(*keys, "__first").agg(F.sum(name).alias(name))
    kind, first = df.schema[ts].dataType, F.col("__first") * step
    return totals.select(*keys, _pane_time(first, length, kind).alias("window_start"),
                         _pane_time(first + per_window, length, kind).alias("window_end"), name)


def distinct_counts(df: DataFrame, ts: str, size: str, value: Column, name: str = "uv") -> DataFrame:
    """Exact distinct values per window; duplicates are dropped before the shuffle."""
    return tumbling(df, [], ts, size, **{name: F.count_distinct(value)})


def sliding_distinct_counts(df: DataFrame, ts: str, size: str, slide: str, value: Column, name: str = "uv",
                            cell: float | None = None) -> DataFrame:
    """Exact distinct values per overlapping window, without copying rows into windows.

    A value seen in a pane belongs to the windows that start up to ``size``
    earlier. Those its previous sight already belongs to are left out, so each
    (value, window) counts once, as a range of windows with two ends; the
    counts are the running balance of range ends along time.
    """
    pane, per_window, step, length = _panes(ts, size, slide)
    seen = df.select(pane.alias("__pane"), value.alias("__v")).dropDuplicates()
    seen = scan(seen, ["__v"], ["__pane"], {"__last": Running("max", F.col("__pane"), exclusive=True)}, cell)
    newest = floor_div(F.col("__pane"), step)
    first = F.greatest(floor_div(F.col("__pane") - per_window, step) + 1, floor_div(F.col("__last"), step) + 1)
    ends = seen.filter(first <= newest).select(F.explode(F.array(
        F.struct(first.alias("at"), F.lit(1).alias("change")),
        F.struct((newest + 1).alias("at"), F.lit(-1).alias("change")))).alias("e")).select("e.*")
    # One row per pane from here on, so one task folds them: their number follows the span of time and not the rows.
    balance, along = ends.groupBy("at").agg(F.sum("change").alias("change")), Window.orderBy("at")
    levels = balance.select("at", F.sum("change").over(along).alias(name), F.lead("at").over(along).alias("__next"))
    starts = (levels.filter(F.col(name) > 0)
              .select(name, F.explode(F.sequence(F.col("at"), F.col("__next") - 1)).alias("__first")))
    kind = df.schema[ts].dataType
    begin = F.col("__first") * step
    return starts.select(_pane_time(begin, length, kind).alias("window_start"),
                         _pane_time(begin + per_window, length, kind).alias("window_end"), name)


def approx_distinct_counts(df: DataFrame, ts: str, size: str, value: Column, rsd: float = 0.02,
                           name: str = "uv") -> DataFrame:
    """Distinct values per window from a sketch of fixed size."""
    return tumbling(df, [], ts, size, **{name: F.approx_count_distinct(value, rsd)})


def distinct_counts_per_row(df: DataFrame, ts: str, seq: str, size: str, value: Column, name: str = "uv",
                            cell: float | None = None) -> DataFrame:
    """For every row, the distinct values its window has seen up to and including the row.

    The first sight of a value is found by an aggregate, not by sorting the
    window; first sights then travel as extra rows through one running count.
    """
    rows = df.withColumn("__start", F.window(ts, size)["start"]).withColumn("__v", value)
    firsts = (rows.groupBy("__start", "__v").agg(F.min(F.struct(ts, seq)).alias("__f"))
              .select("__start", F.col(f"__f.{ts}").alias(ts), F.col(f"__f.{seq}").alias(seq),
                      F.lit(0).alias("__row")))
    both = rows.select("__start", ts, seq, F.lit(1).alias("__row")).unionByName(firsts)
    first_seen = F.when(F.col("__row") == 0, 1)
    counted = running(both, ["__start"], [ts, seq, "__row"], {name: Running("count", first_seen)}, cell)
    return (counted.filter(F.col("__row") == 1)
            .select(F.col("__start").alias("window_start"), ts, seq, name))


def count_tumbling(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int,
                   cell: float | None = None, **aggs: Column) -> DataFrame:
    """Aggregates over every ``n`` consecutive rows of a key; an incomplete last group is not emitted."""
    numbered = number_rows(df, keys, order, "__rn", cell)
    numbered = numbered.withColumn("window_no", floor_div(F.col("__rn") - 1, n))
    return (numbered.groupBy(*keys, "window_no")
            .agg(F.count(F.lit(1)).alias("__size"), *[c.alias(k) for k, c in aggs.items()])
            .filter(F.col("__size") == n).drop("__size"))


def count_sliding(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, slide: int, value: Column,
                  name: str = "values", cell: float | None = None) -> DataFrame:
    """Fires on every ``slide``-th row of a key with ``value`` of the last ``size`` rows or fewer, newest first."""
    seen = scan(df, keys, order, {"fired_at_row": Running("count", F.lit(1)),
                                  "__before": Near(value, size - 1, backward=True)}, cell)
    return (seen.filter(F.col("fired_at_row") % slide == 0)
            .withColumn(name, F.concat(F.array(value), "__before")).drop("__before"))


def check_limit(df: DataFrame, n: int) -> None:
    """Raise if a rank limit is so great that Spark would not filter before the shuffle."""
    most = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n > most:
        raise ValueError(f"a limit of {n} is above spark.sql.optimizer.windowGroupLimitThreshold ({most}); raise that setting first")


def top_n(df: DataFrame, group: Sequence[str], by: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group; ``by`` should end in a key so that ties are settled.

    The rank filter reaches the map side, so a group ships at most ``n`` rows per task, while ``n`` is within
    ``spark.sql.optimizer.windowGroupLimitThreshold``; a greater ``n`` is refused.
    """
    check_limit(df, n)
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*by))
    return df.withColumn(rank, place).filter(F.col(rank) <= n).withColumn(rank, F.col(rank).cast("long"))


def hottest(df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str, n: int = 3,
            count: str = "clicks") -> DataFrame:
    """The ``n`` keys with most rows in each sliding window."""
    counts = sliding_counts(df, keys, ts, size, slide, count).drop("window_start")
    return top_n(counts, ["window_end"], [F.col(count).desc(), *[F.col(k).asc() for k in keys]], n)


def sliding_bitmap_counts(df: DataFrame, ts: str, size: str, slide: str, number: str, name: str = "uv") -> DataFrame:
    """Distinct whole numbers (user numbers, from 0 on) per overlapping window, from bitmaps.

    A pane has a bitmap of fixed size for every bucket of numbers that occurs in it; windows unite the bitmaps of their panes, and the
    buckets' counts are added. No row is copied into windows, and a row of the second step stands for up to 32 768 numbers. Null numbers count nowhere.
    """
    pane, per_window, step, length = _panes(ts, size, slide)
    value = F.col(number).cast("long")
    bitmaps = df.filter(value.isNotNull()).groupBy(pane.alias("__pane"), F.bitmap_bucket_number(value).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("__bits"))
    united = _over_windows(bitmaps, per_window, step).groupBy("__first", "__bucket").agg(F.bitmap_or_agg("__bits").alias("__bits"))
    counts = united.groupBy("__first").agg(F.sum(F.bitmap_count("__bits")).alias(name))
    return _windows_of(counts, df.schema[ts].dataType, per_window, step, length, name)


def sliding_sketch_counts(df: DataFrame, ts: str, size: str, slide: str, value: str, name: str = "uv", log2_k: int = 12) -> DataFrame:
    """Estimated distinct values per overlapping window: a sketch of fixed size per pane, united over the panes of a window.

    The standard error is about 1.04 / sqrt(2 ** log2_k), 1.6 % by default.
    """
    pane, per_window, step, length = _panes(ts, size, slide)
    sketches = df.groupBy(pane.alias("__pane")).agg(F.hll_sketch_agg(value, log2_k).alias("__sketch"))
    united = _over_windows(sketches, per_window, step).groupBy("__first").agg(F.hll_union_agg("__sketch").alias("__sketch"))
    return _windows_of(united.select("__first", F.hll_sketch_estimate("__sketch").alias(name)), df.schema[ts].dataType, per_window, step, length, name)


def _over_windows(panes: DataFrame, per_window: int, step: int) -> DataFrame:
    """Every pane once for each window it is in, told by ``__first``, the number of the window's start."""
    ago = F.explode(F.array(*[F.lit(i) for i in range(-(-per_window // step))]))
    spread = panes.select("*", ago.alias("__i")).withColumn("__first", floor_div(F.col("__pane"), step) - F.col("__i"))
    return spread.filter(F.col("__first") * step + per_window > F.col("__pane")) if per_window % step else spread


def _windows_of(counts: DataFrame, kind, per_window: int, step: int, length: int, name: str) -> DataFrame:
    first = F.col("__first") * step
    return counts.select(_pane_time(first, length, kind).alias("window_start"), _pane_time(first + per_window, length, kind).alias("window_end"), name)
