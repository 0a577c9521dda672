"""What a replay costs and keeps: parts of the input, partitions and rows of the state, micro-batches."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rillwork.operators import windows as batch_windows
from rillwork.plans import stateful
from rillwork.schemas import EVENT
from rillwork.streaming import processors as p, runner, windows

BEGIN = datetime(2024, 1, 1)
KINDS = "event_id long, user_id long, ts timestamp"


@pytest.fixture
def started(monkeypatch):
    """The streams that are started."""
    held, start = [], runner.start

    def kept(*args, **options):
        held.append(start(*args, **options))
        return held[-1]

    monkeypatch.setattr(runner, "start", kept)
    return held


def test_a_part_whose_files_come_one_by_one_is_one_batch(spark, tmp_path):
    """The second file of the part is earlier than all of the first."""
    path = str(tmp_path / "in")
    spark.createDataFrame([], KINDS).write.parquet(path)

    def bring():
        for number, hour in enumerate((10, 1)):
            spark.createDataFrame([(number, 1, BEGIN + timedelta(hours=hour))], KINDS).coalesce(1).write.mode("append").parquet(path)
            time.sleep(4)

    stream = spark.readStream.schema(KINDS).parquet(path)
    out = runner.replay(stream, "ts", lambda df: p.keyed(df, ["user_id"], "ts", "0 seconds", ["event_id"], p.LateSplit()), "parts", feed=[bring])
    assert sorted((r["event_id"], r["tag"]) for r in out.collect()) == [(0, "on_time"), (1, "on_time")]


def test_partitions_of_the_state_go_by_cores(spark, tmp_path, started):
    rows = spark.range(100).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"), F.timestamp_seconds("id").alias("ts"))
    rows.write.parquet(str(tmp_path / "in"))
    asked = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        out = runner.replay(stream, "ts", lambda df: p.keyed(df, ["user_id"], "ts", "0 seconds", ["event_id"], p.OnceAfterFirst(10)), "partitions")
        assert out.count() == 7
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", asked)
    used = {o["numShufflePartitions"] for b in started[0].recentProgress for o in b["stateOperators"]}
    assert used == {runner.TASKS * spark.sparkContext.defaultParallelism}


@pytest.mark.parametrize("size, slide", [("1 hour", "5 minutes"), ("50 minutes", "20 minutes"), ("2 hours", "4 minutes"), ("1 hour", "1 hour")])
def test_sliding_counts_of_cells(spark, tmp_path, started, size, slide):
    """The rows of the batch form, with two rows of state a pane or, beyond ``CELL`` windows, few."""
    rows = [(i, [1, 2, None][i % 3], BEGIN + timedelta(minutes=(i * i * 7) % 600, seconds=i % 60)) for i in range(60)]
    df = spark.createDataFrame(rows, KINDS)
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(KINDS).parquet(str(tmp_path / "in"))
    out = runner.replay(stream, "ts", lambda d: windows.sliding_counts(d, ["user_id"], "ts", "20 hours", size, slide), "cells")
    got = out.filter(runner.before_end("window_end"))
    expected = batch_windows.sliding(df, ["user_id"], "ts", size, slide, n=F.count(F.lit(1)))
    columns = ["user_id", "window_start", "window_end", "n"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, expected.select(columns).collect()))
    updated = sum(b["stateOperators"][0]["numRowsUpdated"] for b in started[0].recentProgress if b["stateOperators"])
    assert updated <= 60 * (4 if size == "2 hours" else 2)


def test_batches_of_a_change_log_do_not_grow_with_its_files(spark, tmp_path, started):
    """The log of 32 users in up to 8 files, each a task of its own."""
    rows = [(i, BEGIN + timedelta(minutes=i), i % 32, "view", 1.0, "{}") for i in range(70)]
    spark.createDataFrame(rows, EVENT).write.parquet(f"{tmp_path}/events.parquet")
    name, asked = "spark.sql.files.minPartitionNum", spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(name, "100")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        out = stateful.retract_counts_stream(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", asked)
    assert sorted(map(tuple, out)) == [(2, 26), (3, 6)]
    with_rows = [b for b in started[1].recentProgress if b["numInputRows"] > 0]
    assert 1 < len(with_rows) <= 4
