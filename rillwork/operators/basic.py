"""Projection, filtering, routing, merging and partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def words(lines: DataFrame, column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per word of a line split on single spaces; empty words are dropped."""
    return (lines.select(*keep, F.explode(F.split(F.col(column), " ")).alias("word"))
            .filter(F.col("word") != ""))


def with_one(df: DataFrame, key: str) -> DataFrame:
    """Rows as (key, 1)."""
    return df.select(key, F.lit(1).alias("one"))


def joined_key(df: DataFrame, columns: Sequence[str], name: str = "key", sep: str = "_") -> DataFrame:
    """Several dimensions as one text key; grouping by the columns themselves is cheaper."""
    return df.withColumn(name, F.concat_ws(sep, *columns))


def rename(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename all columns by position."""
    return df.toDF(*names)


def emit_each(df: DataFrame, items: Column, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of an array; rows with an empty array vanish."""
    return df.select(*keep, F.explode(items).alias(name))


def emit_if(df: DataFrame, condition: Column, item: Column, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row where the condition holds, none elsewhere."""
    return df.filter(condition).select(*keep, item.alias(name))


def label(df: DataFrame, rules: Sequence[tuple[Column, Sequence[str]]], otherwise: Sequence[str],
          name: str = "labels") -> DataFrame:
    """Give each row the label set of the first rule that holds."""
    def label_set(labels: Sequence[str]) -> Column:
        return F.array(*[F.lit(x) for x in labels])

    chosen = F.when(rules[0][0], label_set(rules[0][1]))
    for condition, labels in rules[1:]:
        chosen = chosen.when(condition, label_set(labels))
    return df.withColumn(name, chosen.otherwise(label_set(otherwise)))


def labelled(df: DataFrame, wanted: str, name: str = "labels") -> DataFrame:
    """Rows that carry a label, among others or alone."""
    return df.filter(F.array_contains(name, wanted))


def route(df: DataFrame, rules: Sequence[tuple[str, Column]], otherwise: str = "main", name: str = "tag") -> DataFrame:
    """Tag each row with the output it belongs to; read an output with ``output``."""
    chosen = F.when(rules[0][1], rules[0][0])
    for tag, condition in rules[1:]:
        chosen = chosen.when(condition, tag)
    return df.withColumn(name, chosen.otherwise(otherwise))


def output(df: DataFrame, tag: str, name: str = "tag") -> DataFrame:
    return df.filter(F.col(name) == tag).drop(name)


def connect(left: DataFrame, right: DataFrame, left_map: dict[str, Column], right_map: dict[str, Column]) -> DataFrame:
    """Two inputs of different types, each mapped by its own projection to one output type."""
    return (left.select(*[c.alias(n) for n, c in left_map.items()])
            .unionByName(right.select(*[c.alias(n) for n, c in right_map.items()])))


def merge(*inputs: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept."""
    out = inputs[0]
    for df in inputs[1:]:
        out = out.unionByName(df)
    return out


def merge_distinct(*inputs: DataFrame) -> DataFrame:
    """The distinct rows of all inputs; on a stream this keeps every row as state."""
    return merge(*inputs).dropDuplicates()


def partition_by_key(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Rows of one key in one partition. Grouping does this by itself; only for sinks that need it."""
    return df.repartition(partitions, *keys) if partitions else df.repartition(*keys)


def shuffle(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Even redistribution that ignores the content; the content is unchanged."""
    return df.repartition(partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
