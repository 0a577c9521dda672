"""Rows shaped for the stores they go to, and the writers that need a driver or jar on the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def topic_messages(df: DataFrame, key: str, fields: Sequence[str], sep: str = ",") -> DataFrame:
    """(key, value) messages; the value is the fields joined by ``sep``."""
    return df.select(F.col(key).cast("string").cast("binary").alias("key"),
                     F.concat_ws(sep, *fields).cast("binary").alias("value"))


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def documents(df: DataFrame, name: str = "document", **fields: Column) -> DataFrame:
    """One JSON document per row."""
    return df.select(F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias(name))


def table_rows(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Rows with exactly the columns, names and types of the target table."""
    return df.select(*[c.alias(n) for n, c in columns.items()])


def append_jdbc(rows: DataFrame, url: str, table: str, batch_rows: int = 10_000, **options: str) -> None:
    """Append in batches, each partition over its own connection with one prepared statement."""
    rows.write.options(batchsize=str(batch_rows), **options).jdbc(url, table, mode="append")
