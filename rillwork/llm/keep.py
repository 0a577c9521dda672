"""Cutting lineage in the folder that the driver and all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillwork.session import shared_folder


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the checkpoint folder of the session."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of a few megabytes, as a Python worker and the JVM beside it hold several of them at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``pos``, its place from 0 without gaps in the order of the columns ``order``, nulls last.

    Sorted by ranges, so no task gets all rows; the driver gets one count per
    range. Kept, as the ranges come from a sample and must not change between uses.
    """
    by = [F.col(c).asc_nulls_last() for c in order]
    placed = kept(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("id", F.monotonically_increasing_id()))
    part = F.shiftright("id", 33).cast("int")
    counts = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, starts = 0, []
    for p in sorted(counts):
        starts.append((p, before))
        before += counts[p]
    starts = df.sparkSession.createDataFrame(starts, "part int, start long")
    return placed.withColumn("part", part).join(F.broadcast(starts), "part").withColumn(
        "pos", F.col("start") + F.col("id") - F.shiftleft(F.col("part").cast("long"), 33)).drop("part", "start", "id")
