"""Running a streaming plan over the input that is there, and reading back what it wrote.

Results and checkpoints go to the folder all executors share, never through the
driver's memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from rillwork.session import configure, shared_folder

# Later than any row; an own row with this time closes all windows of a bounded replay.
FAR = "9000-01-01 00:00:00"
CLOSING = "__closing"  # the column that marks this row
BATCH = "batch_id"
TASKS = 2  # partitions of the state for each core of the cluster


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/rillwork-{name}-{uuid4().hex}"


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """A stream that starts in here has ``TASKS`` partitions a core at most, whatever its input.

    Every micro-batch opens and commits each partition of the state, so their number is a cost of its own. A stream keeps the
    settings it was started with; those of the session come back.
    """
    name = "spark.sql.shuffle.partitions"
    asked = spark.conf.get(name)
    spark.conf.set(name, str(min(int(asked), TASKS * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, asked)


def start(df: DataFrame, path: str, checkpoint: str, mode: str = "append", trigger: dict | None = None,
          each_batch: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Start a query that writes parquet under ``path``.

    Appended rows use the exactly-once file sink. Updated rows, and batches that
    go through ``each_batch`` first, are written once per micro-batch under its
    number, so a batch that is run again after a failure replaces itself.
    """
    configure(df.sparkSession)
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if mode == "append" and each_batch is None:
        with state_partitions(df.sparkSession):
            return writer.format("parquet").option("path", path).start()

    def write(batch: DataFrame, number: int) -> None:
        out = each_batch(batch) if each_batch else batch
        out.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    with state_partitions(df.sparkSession):
        return writer.foreachBatch(write).start()


def read_results(spark: SparkSession, path: str, schema: T.StructType, with_batch: bool = False) -> DataFrame:
    columns = [*schema.fields, T.StructField(BATCH, T.LongType())] if with_batch else schema.fields
    return spark.read.schema(T.StructType(list(columns))).parquet(path).select([c.name for c in columns])


def drain(df: DataFrame, name: str, mode: str = "append",
          each_batch: Callable[[DataFrame], DataFrame] | None = None,
          result_schema: T.StructType | None = None) -> DataFrame:
    """Process all input there is, then stop; windows that the watermark has not passed stay open.

    In update mode the result has one row per update and its ``batch_id``.
    """
    spark = df.sparkSession
    path, checkpoint = new_folder(spark, name), new_folder(spark, name + "-checkpoint")
    query = start(df, path, checkpoint, mode, {"availableNow": True}, each_batch)
    query.awaitTermination()
    return read_results(spark, path, result_schema or df.schema, mode != "append")


def replay(source: DataFrame, ts: str, plan: Callable[[DataFrame], DataFrame], name: str, mode: str = "append",
           each_batch: Callable[[DataFrame], DataFrame] | None = None,
           result_schema: T.StructType | None = None, feed: Sequence[Callable[[], None]] = ()) -> DataFrame:
    """Process a bounded stream to its end, so that every window closes and every timer fires.

    ``feed`` brings the input part by part: each part is put where ``source`` reads and processed before the next. The query rests
    meanwhile, as the files of a part do not come at once: a batch of some of them would move the watermark past rows of the others.
    After all input is through, one more row arrives whose time is ``FAR``, whose column ``CLOSING`` is true and
    whose other columns are null; ``plan`` sets the watermark and its results
    for that row must be dropped by the caller, from the results that come back:
    inside ``plan`` such a filter would be moved below the watermark, which
    then would not see the row.
    """
    spark = source.sparkSession
    end = new_folder(spark, name + "-end")
    source = source.withColumn(CLOSING, F.lit(False))
    schema = source.schema
    spark.createDataFrame([], schema).write.parquet(end)
    out = plan(source.unionByName(spark.readStream.schema(schema).parquet(end)))
    path, checkpoint = new_folder(spark, name), new_folder(spark, name + "-checkpoint")
    values = {ts: FAR, CLOSING: True}
    last = spark.range(1).select(*[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])

    def close() -> None:
        last.write.mode("append").parquet(end)

    query = None
    try:
        for bring in feed or [lambda: None]:
            if query:
                query.stop()
            bring()
            query = start(out, path, checkpoint, mode, each_batch=each_batch)
            query.processAllAvailable()  # also what the watermark has closed by then
        close()
        query.processAllAvailable()
    finally:
        if query:
            query.stop()
    return read_results(spark, path, result_schema or out.schema, mode != "append")


def last_update(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The table that a change log of updates leaves behind: the newest row of each key."""
    values = [c for c in updates.columns if c not in {*keys, BATCH}]
    return (updates.groupBy(*keys).agg(F.max_by(F.struct(*values), BATCH).alias("__v"))
            .select(*keys, *[F.col(f"__v.{c}").alias(c) for c in values]))


def before_end(column: str) -> "F.Column":
    """True for results that do not stem from the closing row of ``replay``."""
    return F.col(column) < F.lit(FAR).cast("timestamp")
