"""Text, delimited and web-log inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rillwork.functions.scalar import parse_time


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A text file as rows with one column ``value``."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream over the files of a folder."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def parse_delimited(lines: DataFrame, schema: T.StructType, sep: str = ",", column: str = "value",
                    bad_rows: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Typed record per line; ``bad_rows`` names a column that keeps lines that do not parse."""
    options = {"sep": sep}
    wanted = schema
    if bad_rows:
        wanted = T.StructType([*schema.fields, T.StructField(bad_rows, T.StringType())])
        options["columnNameOfCorruptRecord"] = bad_rows
    row = F.from_csv(F.col(column), wanted.simpleString()[len("struct<"):-1].replace(":", " "), options)
    return lines.select(*(keep or []), row.alias("__row")).select(*(keep or []), "__row.*")


def parse_web_log(lines: DataFrame, column: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Space-separated access-log line: ip, user, -, time, -, method, url."""
    part: Column = F.split(F.col(column), " ")
    return lines.select(
        *(keep or []),
        part[0].alias("ip"), part[1].alias("user_id"), parse_time(part[3]).alias("ts"),
        part[5].alias("method"), part[6].alias("url"))


def delimited_table(spark: SparkSession, path: str, schema: T.StructType, name: str, sep: str = ",") -> DataFrame:
    """Register a delimited file as a named table."""
    df = spark.read.schema(schema).option("sep", sep).csv(path)
    df.createOrReplaceTempView(name)
    return df


def named_view(df: DataFrame, name: str, columns: list[str] | None = None) -> DataFrame:
    """Name a batch or streaming DataFrame, optionally renaming its columns by position."""
    out = df.toDF(*columns) if columns else df
    out.createOrReplaceTempView(name)
    return out


def from_rows(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """Literal rows."""
    return spark.createDataFrame(rows, schema)
