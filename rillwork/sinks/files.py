"""File outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.streaming import StreamingQuery


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "append") -> None:
    df.write.mode(mode).option("sep", sep).csv(path)


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The store after ``changes``: the row with the greatest ``order`` wins for each key."""
    columns = current.columns
    rows = current.unionByName(changes)
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.col(order)).alias("__row"))
            .select(*[F.col(f"__row.{c}").alias(c) for c in columns]))


def merge_batch(batch: DataFrame, number: int, store: str, keys: list[str], order: Sequence[str]) -> None:
    """The store under ``store`` after batch ``number``, as a version of its own.

    A version is written whole under its number from the last one committed before it, and only then named in the list of
    commits, so a batch that is run again after a failure replaces what it had written, and readers never see a half-written version.
    Of rows with one key the one with the greatest ``order`` counts, also against the store.
    """
    spark = batch.sparkSession
    batch = batch.withColumn(_ORDER, F.struct(*order))
    before = _committed(spark, store, number)
    if before is not None:
        after = upsert(spark.read.schema(batch.schema).parquet(f"{store}/version={before}"), batch, keys, _ORDER)
    else:
        after = upsert(batch.limit(0), batch, keys, _ORDER)
    after.write.mode("overwrite").parquet(f"{store}/version={number}")
    spark.range(1).write.mode("overwrite").parquet(f"{store}/commits/version={number}")


_ORDER = "__order"


def _committed(spark: SparkSession, store: str, before: int | None = None) -> int | None:
    """The last committed version, below ``before`` if that is given."""
    try:
        commits = spark.read.parquet(f"{store}/commits").select(F.col("version").cast("long").alias("v"))
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    if before is not None:
        commits = commits.filter(F.col("v") < before)
    return commits.agg(F.max("v")).first()[0]


def upsert_stream(df: DataFrame, store: str, checkpoint: str, keys: list[str], order: Sequence[str]) -> StreamingQuery:
    """Merge the rows of a stream into a store of the latest row of every key, until the input that is there is through."""
    def write(batch: DataFrame, number: int) -> None:
        merge_batch(batch, number, store, keys, order)

    return df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """The last committed version of a store."""
    version = _committed(spark, store)
    if version is None:
        raise FileNotFoundError(f"no version of {store} has been committed")
    return spark.read.parquet(f"{store}/version={version}").drop(_ORDER)
