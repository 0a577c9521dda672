"""Keyed totals and running aggregates (one result per input row)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rillwork.functions.scalar import money
from rillwork.operators.ordered import Running, running


def counts(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_of(df: DataFrame, keys: Sequence[str], column: str, name: str = "n") -> DataFrame:
    """Non-null values of a column per key."""
    return df.groupBy(*keys).agg(F.count(column).alias(name))


def total(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_total(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    return df.agg(F.count_distinct(column).alias(name))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, name: str,
                cell: float | None = None, digits: int = 2, precision: int = 18) -> DataFrame:
    """Sum of an amount of ``digits`` decimals up to each row, exact whatever the row order of the input.

    Values are rounded to that; one of more than ``precision`` digits is null.
    """
    out = running(df, keys, order, {name: Running("sum", money(F.col(column), digits, precision))}, cell)
    return out.withColumn(name, F.col(name).cast("double"))


def running_extreme(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, fold: str, name: str,
                    keep_first: Sequence[str] = (), cell: float | None = None) -> DataFrame:
    """Minimum or maximum of one column up to each row; ``keep_first`` columns show the key's first row."""
    specs = {name: Running(fold, F.col(column))}
    specs.update({f"first_{c}": Running("first", F.struct(c)) for c in keep_first})
    out = running(df, keys, order, specs, cell)
    for c in keep_first:
        out = out.withColumn(f"first_{c}", F.col(f"first_{c}.{c}"))
    return out


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "n",
                  where: Column | None = None, cell: float | None = None) -> DataFrame:
    """Rows (matching ``where``) of the key up to each row."""
    value = F.lit(1) if where is None else F.when(where, 1)
    return running(df, keys, order, {name: Running("count", value)}, cell)


def running_distinct(df: DataFrame, order: Sequence[str], column: str, name: str = "uv",
                     cell: float | None = None) -> DataFrame:
    """For every row of the whole input, the distinct values of ``column`` seen up to it."""
    firsts = (df.groupBy(column).agg(F.min(F.struct(*order)).alias("__f"))
              .select(*[F.col(f"__f.{o}").alias(o) for o in order], F.lit(0).alias("__row")))
    both = df.select(*order, F.lit(1).alias("__row")).unionByName(firsts)
    counted = running(both, [], [*order, "__row"], {name: Running("count", F.when(F.col("__row") == 0, 1))},
                      cell)
    return counted.filter(F.col("__row") == 1).drop("__row")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The last row of each key, as a store with last-write-wins would hold it."""
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("__last"))
            .select(*keys, *[F.col(f"__last.{c}").alias(c) for c in columns]))


def changelog(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "n",
              cell: float | None = None) -> DataFrame:
    """Count per key as a change log: each row takes back the old count (add = false) and adds the new one."""
    counted = running_count(df, keys, order, "__n", cell=cell)
    new = F.col("__n")
    add = F.struct(F.lit(True).alias("add"), new.alias(name))
    take_back = F.struct(F.lit(False).alias("add"), (new - 1).alias(name))
    changes = F.when(new == 1, F.array(add)).otherwise(F.array(take_back, add))
    return counted.select(*keys, *order, F.explode(changes).alias("__c")).select(*keys, *order, "__c.*")
