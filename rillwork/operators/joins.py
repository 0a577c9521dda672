"""Joins bounded by time, reconciliation of two sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rillwork.functions.scalar import epoch_micros, floor_div


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                  lower: float, upper: float) -> DataFrame:
    """Pairs of one key with ``left_ts + lower <= right_ts <= left_ts + upper`` (seconds, both ends included).

    Time is cut into cells as long as the interval, and the cell joins the key:
    a right row is looked for in the two cells its partners can lie in, so a
    key with many rows is spread over its cells and never paired with itself in
    full. Each pair is met once, because a left row has one cell.
    ``keys`` exist on both sides; other column names must differ.
    """
    lo, hi = int(lower * 1_000_000), int(upper * 1_000_000)
    cell = max(hi - lo, 1)
    l_at, r_at = epoch_micros(F.col(left_ts)), epoch_micros(F.col(right_ts))
    lefts = left.withColumn("__cell", floor_div(l_at, cell))
    first, last = floor_div(r_at - hi, cell), floor_div(r_at - lo, cell)
    rights = right.withColumn("__cell", F.explode(F.sequence(first, last)))
    gap = r_at - l_at
    return lefts.join(rights, [*keys, "__cell"]).filter((gap >= lo) & (gap <= hi)).drop("__cell")


def stream_interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                         lower: float, upper: float, left_delay: str, right_delay: str) -> DataFrame:
    """The same between two streams; the bound and the watermarks let old rows leave the state.

    Column names must differ; the right key is ``right_<key>``.
    """
    lefts, rights = left.withWatermark(left_ts, left_delay), right.withWatermark(right_ts, right_delay)
    return lefts.join(rights, F.expr(
        f"{key} = right_{key} AND {right_ts} >= {left_ts} + interval {lower} seconds "
        f"AND {right_ts} <= {left_ts} + interval {upper} seconds"))


def reconcile(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str) -> DataFrame:
    """Keys present on both sides, with the value of each (which may be null); null and empty keys never match.

    Each key occurs at most once per side, so both sides go through a single
    grouping: one shuffle, combined on the map side, no join.
    """
    kinds = {left_value: left.schema[left_value].dataType, right_value: right.schema[right_value].dataType}

    def side(rows: DataFrame, value: str, is_left: bool) -> DataFrame:
        other = right_value if is_left else left_value
        return rows.select(F.col(key), F.col(value), F.lit(None).cast(kinds[other]).alias(other),
                           F.lit(is_left).alias("__left")).select(key, left_value, right_value, "__left")

    tagged = side(left, left_value, True).unionByName(side(right, right_value, False))
    known = F.col(key).isNotNull() & (F.col(key).cast("string") != "")
    return (tagged.filter(known).groupBy(key)
            .agg(F.min(left_value).alias(left_value), F.min(right_value).alias(right_value),
                 F.max("__left").alias("__on_left"), F.min("__left").alias("__only_left"))
            .filter(F.col("__on_left") & ~F.col("__only_left")).drop("__on_left", "__only_left"))
