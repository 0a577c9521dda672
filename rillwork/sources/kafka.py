"""Topic input. The connector jar is chosen at submit time; decoding needs none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rillwork.sources.files import parse_delimited


def topic_stream(spark: SparkSession, servers: str, topic: str, group: str, start: str = "latest") -> DataFrame:
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
            .option("kafka.group.id", group).option("startingOffsets", start).load())


def decode_values(messages: DataFrame, schema: T.StructType, sep: str = ",") -> DataFrame:
    """UTF-8 message values as typed records."""
    return parse_delimited(messages.select(F.col("value").cast("string").alias("value")), schema, sep)
