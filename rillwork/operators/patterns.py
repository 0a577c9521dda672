"""Event patterns inside a key, ordered by time and row id.

A match carries one struct per step with the chosen columns. ``within`` is in
seconds and strict: a match that spans the limit or more is no match.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rillwork.functions.scalar import epoch_micros, seconds
from rillwork.operators.joins import interval_join
from rillwork.operators.ordered import Running, neighbours, running


def begin(df: DataFrame, *where: Column) -> DataFrame:
    """A single step; several conditions must all hold."""
    for condition in where:
        df = df.filter(condition)
    return df


def either(df: DataFrame, *where: Column) -> DataFrame:
    """A single step with alternatives."""
    condition = where[0]
    for other in where[1:]:
        condition = condition | other
    return df.filter(condition)


def _in_time(first: str, last: str, ts: str, within: float | None) -> Column:
    if within is None:
        return F.lit(True)
    return F.col(f"{last}.{ts}") < F.col(f"{first}.{ts}") + seconds(within)


def _step(columns: Sequence[str]) -> Column:
    return F.struct(*columns)


def next_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column, second: Column,
             columns: Sequence[str], within: float | None = None,
             cell: float | None = None) -> DataFrame:
    """Strict contiguity: the row right after a ``first`` row must be a ``second`` row."""
    rows = df.select(*keys, _step(columns).alias("first"), first.alias("__is_first"), second.alias("__is_second"),
                     *[c for c in order if c not in keys])
    rows = neighbours(rows, keys, order, F.struct(F.col("first").alias("step"), "__is_second"), 1, "__next",
                      cell=cell)
    following = F.get("__next", F.lit(0))
    return (rows.filter(F.col("__is_first") & following["__is_second"])
            .select(*keys, "first", following["step"].alias("second"))
            .filter(_in_time("first", "second", order[0], within)))


def _with_follower(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column, second: Column,
                   columns: Sequence[str], cell: float | None) -> DataFrame:
    """``first`` rows with the nearest later ``second`` row, null if there is none."""
    rows = df.filter(first | second).select(
        *keys, *[c for c in order if c not in keys], first.alias("__is_first"), second.alias("__is_second"),
        _step(columns).alias("first"))
    nearest = Running("last", F.when(F.col("__is_second"), F.col("first")), backward=True, exclusive=True)
    rows = running(rows, keys, order, {"second": nearest}, cell)
    return rows.filter("__is_first").select(*keys, "first", "second")


def followed_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column, second: Column,
                columns: Sequence[str], within: float | None = None,
                cell: float | None = None) -> DataFrame:
    """Relaxed contiguity: each ``first`` row with the nearest later ``second`` row."""
    return (_with_follower(df, keys, order, first, second, columns, cell)
            .filter(F.col("second").isNotNull() & _in_time("first", "second", order[0], within)))


def timed_out(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column, second: Column,
              columns: Sequence[str], within: float, cell: float | None = None) -> DataFrame:
    """``first`` rows that no ``second`` row follows in time: the partial matches that ran out."""
    return (_with_follower(df, keys, order, first, second, columns, cell)
            .filter(F.col("second").isNull() | ~_in_time("first", "second", order[0], within))
            .select(*keys, "first"))


def followed_by_any(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column, second: Column,
                    columns: Sequence[str], within: float) -> DataFrame:
    """Each ``first`` row with every later ``second`` row in time; the limit keeps the result finite."""
    ts = order[0]

    def side(where: Column, step: str) -> DataFrame:
        return df.filter(where).select(*keys, F.col(ts).alias(f"__{step}_ts"), F.struct(*order).alias(f"__{step}_at"),
                                       _step(columns).alias(step))

    pairs = interval_join(side(first, "first"), side(second, "second"), keys, "__first_ts", "__second_ts", 0, within)
    later = (F.col("__second_at") > F.col("__first_at")) & (
        epoch_micros(F.col("__second_ts")) - epoch_micros(F.col("__first_ts")) < int(within * 1_000_000))
    return pairs.filter(later).select(*keys, "first", "second")


def times_range(df: DataFrame, keys: Sequence[str], order: Sequence[str], where: Column, columns: Sequence[str],
                least: int, most: int, within: float | None = None,
                cell: float | None = None) -> DataFrame:
    """Every run of ``least`` to ``most`` successive matching rows, rows in between being ignored.

    Gives the number of rows ``times`` and the first and last of them.
    """
    rows = df.filter(where).select(*keys, *[c for c in order if c not in keys], _step(columns).alias("first"))
    rows = neighbours(rows, keys, order, F.col("first"), most - 1, "__later", cell=cell)
    reach = F.least(F.lit(most), F.size("__later") + 1)
    rows = (rows.filter(reach >= least)
            .select(*keys, "first", "__later", F.explode(F.sequence(F.lit(least), reach)).alias("times")))
    last = F.when(F.col("times") == 1, F.col("first")).otherwise(F.get("__later", F.col("times") - 2))
    return (rows.select(*keys, "times", "first", last.alias("last"))
            .filter(_in_time("first", "last", order[0], within)))


def times(df: DataFrame, keys: Sequence[str], order: Sequence[str], where: Column, columns: Sequence[str], n: int,
          within: float | None = None, cell: float | None = None) -> DataFrame:
    """Every ``n`` successive matching rows."""
    return times_range(df, keys, order, where, columns, n, n, within, cell).drop("times")
