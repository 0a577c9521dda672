"""Streams over several small files: disorder, late rows, restarts; the batch results are the measure."""

import random
import subprocess
import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rillwork.operators import guards, patterns, windows as batch_windows
from rillwork.operators.windows import hottest
from rillwork.streaming import processors as p, runner, windows

T0 = datetime(2024, 1, 1)
SCHEMA = "id long, user_id long, ts timestamp, kind string"


def at(s):
    return T0 + timedelta(seconds=s)


def put(spark, folder, name, rows):
    """One file per call, so one micro-batch per call."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def source(spark, folder):
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
            .parquet(str(folder)))


def run(df, tmp_path, mode="append"):
    out = str(tmp_path / "out")
    runner.start(df, out, str(tmp_path / "check"), mode, {"availableNow": True}).awaitTermination()
    return runner.read_results(df.sparkSession, out, df.schema, mode != "append")


def tuples(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


@pytest.fixture()
def folder(tmp_path):
    f = tmp_path / "in"
    f.mkdir()
    return f


def counts(df, delay):
    return windows.tumbling(df, [], "ts", delay, "5 seconds", n=F.count(F.lit(1)))


def test_window_waits_for_the_bound_and_drops_late_rows(spark, folder, tmp_path):
    put(spark, folder, "a", [(1, 1, at(1), "x"), (2, 1, at(7), "x")])    # watermark 4
    put(spark, folder, "b", [(3, 1, at(3), "x"), (4, 1, at(9), "x")])    # row 3 is in time; watermark 6
    put(spark, folder, "c", [(5, 1, at(20), "x")])                        # closes the first two windows
    put(spark, folder, "d", [(6, 1, at(2), "x"), (7, 1, at(21), "x")])   # row 6 is late
    got = run(counts(source(spark, folder), "3 seconds"), tmp_path)
    assert tuples(got, "window_start", "n") == [(at(0), 2), (at(5), 2)]


def test_refiring_window_reports_again(spark, folder, tmp_path):
    put(spark, folder, "a", [(1, 1, at(1), "x"), (2, 1, at(8), "x")])    # bound passed for the first window
    put(spark, folder, "b", [(3, 1, at(3), "x"), (4, 1, at(9), "x")])    # within lateness
    put(spark, folder, "c", [(5, 1, at(20), "x")])
    put(spark, folder, "d", [(6, 1, at(21), "x")])
    put(spark, folder, "e", [(7, 1, at(2), "x")])                         # beyond it
    got = run(windows.refiring_counts(source(spark, folder), [], "ts", "5 seconds", 3, 2), tmp_path, "update")
    first = [(r[1]) for r in tuples(got.filter(F.col("window_start") == at(0)), "batch_id", "n")]
    assert first == [1, 2]


def test_late_rows_go_to_the_side(spark, folder, tmp_path):
    put(spark, folder, "a", [(1, 1, at(10), "x")])
    put(spark, folder, "b", [(2, 1, at(5), "x"), (3, 1, at(30), "x")])
    put(spark, folder, "c", [(4, 1, at(12), "x"), (5, 1, at(60), "x")])
    rows = source(spark, folder).withColumnRenamed("id", "event_id")
    got = run(p.keyed(rows, ["user_id"], "ts", "2 seconds", ["event_id"], p.LateSplit()), tmp_path)
    assert tuples(got, "event_id", "tag") == [(1, "on_time"), (2, "late"), (3, "on_time"), (4, "late")]


def test_slower_watermark_rules(spark, tmp_path):
    fast, slow = tmp_path / "fast", tmp_path / "slow"
    put(spark, fast, "a", [(1, 1, at(1), "x"), (2, 1, at(100), "x")])
    put(spark, slow, "a", [(3, 1, at(2), "x"), (4, 1, at(12), "x")])
    both = (source(spark, fast).withWatermark("ts", "0 seconds")
            .unionByName(source(spark, slow).withWatermark("ts", "1 second")))
    agg = both.groupBy(F.window("ts", "5 seconds").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    got = run(agg.select(F.col("w.start").alias("s"), "n"), tmp_path)
    assert tuples(got) == [(at(0), 2)]


def random_rows(n, kinds, seed, keys=4):
    """(rows in arrival order): disorder of up to 20 s."""
    rnd = random.Random(seed)
    rows = [(i, rnd.randrange(1, keys), at(rnd.randrange(600)), rnd.choice(kinds)) for i in range(n)]
    return sorted(rows, key=lambda r: (r[2] + timedelta(seconds=rnd.randrange(20)), r[0]))


def put_in_parts(spark, folder, rows, parts):
    step = -(-len(rows) // parts)
    for i in range(parts):
        put(spark, folder, f"part{i}", rows[i * step:(i + 1) * step])


def replay(spark, folder, plan, name):
    return runner.replay(source(spark, folder), "ts", plan, name)


def test_processors_equal_batch_over_disordered_files(spark, folder):
    rows = random_rows(120, ["a", "b", "c"], 5)
    put_in_parts(spark, folder, rows, 4)
    batch = spark.createDataFrame(rows, SCHEMA)
    a, b = F.col("kind") == "a", F.col("kind") == "b"

    def marked(df):
        return df.withColumn("is_first", a).withColumn("is_second", b).withColumnRenamed("id", "event_id")

    got = replay(spark, folder, lambda df: p.keyed(marked(df), ["user_id"], "ts", "25 seconds",
                                                   ["is_first", "is_second", "event_id"], p.FollowedBy(60)), "follow")
    args = (["user_id"], ["ts", "id"], a, b, ["id", "ts"])
    match = patterns.followed_by(batch, *args, 60)
    late = patterns.timed_out(batch, *args, 60)
    assert tuples(got.filter("tag = 'match'"), "first_id", "second_id") == tuples(match, "first.id", "second.id")
    assert tuples(got.filter("tag = 'timeout'"), "first_id") == tuples(late, "first.id")

    got = replay(spark, folder, lambda df: p.keyed(marked(df), ["user_id"], "ts", "25 seconds",
                                                   ["is_first", "is_second", "event_id"], p.NextRow(50)), "next")
    assert tuples(got, "first_id", "second_id") == tuples(
        patterns.next_row(batch, *args, 50), "first.id", "second.id")


def test_daily_limit_resets_per_key(spark, folder):
    rows = [(i, u, datetime(2024, 1, 1, 23, 59, 30) + timedelta(seconds=10 * i), "x") for i in range(6) for u in (1, 2)]
    put_in_parts(spark, folder, rows, 3)
    got = replay(spark, folder, lambda df: p.keyed(df.withColumnRenamed("id", "event_id"), ["user_id"], "ts",
                                                   "5 seconds", ["event_id"], p.DailyLimit(2)), "limit")
    batch = spark.createDataFrame(rows, SCHEMA)
    kept = guards.below_daily_limit(batch, ["user_id"], "ts", ["ts", "id"], 2)
    told = guards.limit_alarms(batch, ["user_id"], "ts", ["ts", "id"], 2)
    assert tuples(got.filter("tag = 'pass'"), "user_id", "event_id") == tuples(kept, "user_id", "id")
    assert tuples(got.filter("tag = 'alarm'"), "user_id", "event_id") == tuples(told, "user_id", "id")


def test_payment_watch_corrects_itself(spark, folder):
    put(spark, folder, "a", [(0, 1, at(0), "create"), (0, 2, at(0), "create"), (1, 3, at(5), "pay")])
    put(spark, folder, "b", [(1, 1, at(50), "pay"), (9, 9, at(200), "create")])
    put(spark, folder, "c", [(1, 2, at(250), "pay"), (9, 8, at(300), "create")])
    got = replay(spark, folder, lambda df: p.keyed(df.select("ts", "kind", "id", F.col("user_id").alias("order_id")),
                                                   ["order_id"], "ts", "0 seconds", ["kind", "id"],
                                                   p.PaymentWatch(100, 10_000)), "pay")
    said = tuples(got.filter("order_id < 4"), "order_id", "no", "status")
    assert said == [(1, 1, "paid"), (2, 1, "timeout"), (2, 2, "late"), (3, 1, "missing_create")]


def test_state_survives_a_restart(spark, folder, tmp_path):
    def plan():
        rows = source(spark, folder).withColumnRenamed("id", "event_id").withColumn("cents", F.lit(1).cast("long"))
        return p.keyed(rows, ["user_id"], "ts", "0 seconds", ["cents", "event_id"], p.CountWindow(3))

    put(spark, folder, "a", [(1, 1, at(1), "x"), (2, 1, at(2), "x"), (3, 1, at(3), "x")])
    run(plan(), tmp_path)
    put(spark, folder, "b", [(4, 1, at(4), "x"), (5, 1, at(5), "x"), (6, 1, at(6), "x"), (7, 1, at(99), "x")])
    got = run(plan(), tmp_path)
    assert tuples(got, "window_no", "cents") == [(0, 3), (1, 3)]
    assert tuples(run(plan(), tmp_path), "window_no") == [(0,), (1,)]  # nothing new, nothing twice


def test_null_keys_are_keys(spark, folder):
    rows = [(i, None if i % 2 else 1, at(i), "x") for i in range(10)]
    put_in_parts(spark, folder, rows, 2)
    got = replay(spark, folder, lambda df: p.keyed(df.withColumnRenamed("id", "event_id"), ["user_id"], "ts", "20 seconds",
                                                   ["event_id"], p.LateSplit()), "null-keys")
    assert tuples(got, "event_id", "tag") == [(i, "on_time") for i in range(10)]


def test_null_items_are_ranked_like_others(spark, folder):
    rows = [(i, None if i < 5 else i % 3, at(60 * i), "x") for i in range(12)]
    put_in_parts(spark, folder, rows, 3)
    batch = hottest(spark.createDataFrame(rows, SCHEMA), ["user_id"], "ts", "1 hour", "20 minutes")
    out = runner.replay(source(spark, folder).select("ts", "user_id"), "ts", lambda df: windows.sliding_counts(
        df, ["user_id"], "ts", "5 minutes", "1 hour", "20 minutes", "clicks").select("window_end", "user_id", "clicks"), "null-items",
        each_batch=windows.rank_closed_windows(["user_id"], 3),
        result_schema=spark.createDataFrame([], "window_end timestamp, user_id long, clicks long, rank long").schema)
    key = F.coalesce("user_id", F.lit(-1))
    assert tuples(out, "window_end", key, "clicks", "rank") == tuples(batch, "window_end", key, "clicks", "rank")


@pytest.mark.parametrize("size,slide", [("1 hour", "5 minutes"), ("50 minutes", "20 minutes"), ("30 minutes", "20 minutes")])
def test_sliding_counts_equal_the_builtin_window(spark, size, slide):
    rnd = random.Random(4)
    df = spark.createDataFrame([(i, rnd.choice([None, 1, 2]), at(rnd.randrange(20000)), "x") for i in range(300)], SCHEMA)
    want = batch_windows.sliding(df, ["user_id"], "ts", size, slide, n=F.count(F.lit(1)))
    ours = batch_windows.sliding_counts(df, ["user_id"], "ts", size, slide)
    key = F.coalesce("user_id", F.lit(-1))
    assert tuples(ours, key, "window_start", "window_end", "n") == tuples(want, key, "window_start", "window_end", "n")
    uv = batch_windows.sliding_distinct_counts(df, "ts", size, slide, F.col("user_id"), "uv")
    plain = batch_windows.sliding(df.filter("user_id IS NOT NULL"), [], "ts", size, slide, uv=F.count_distinct("user_id"))
    known = batch_windows.sliding_distinct_counts(df.filter("user_id IS NOT NULL"), "ts", size, slide, F.col("user_id"), "uv")
    assert tuples(known, "window_start", "uv") == tuples(plain, "window_start", "uv") and uv.count() >= known.count()


def test_a_limit_that_spark_does_not_filter_early_is_refused(spark):
    df = spark.createDataFrame([(1, 1, at(0), "x")], SCHEMA)
    with pytest.raises(ValueError):
        guards.below_daily_limit(df, ["user_id"], "ts", ["ts", "id"], 5000)


def test_daily_limit_forgets_the_day_before(spark, folder, tmp_path):
    """A key that comes back the next day begins anew, and its state is gone at midnight."""
    limit = p.DailyLimit(1)
    memory, _ = limit.on_row((1,), None, {"at": 5, "event_id": 1})
    assert limit.deadline(memory) == 86_400_000_000 - 1 and limit.on_time((1,), memory, limit.deadline(memory)) == (None, ())


def test_reconcile_as_a_stream_equals_batch(spark, folder):
    rows = [(1, 1, at(0), "l"), (0, 1, at(30), "r"), (1, 2, at(5), "l"), (0, 3, at(9), "r"), (1, None, at(9), "l"), (0, None, at(12), "r"), (1, 4, at(0), "l"), (0, 4, at(500), "r")]
    put_in_parts(spark, folder, sorted(rows, key=lambda r: r[2]), 3)
    got = replay(spark, folder, lambda df: p.keyed(df.select("ts", F.col("user_id").alias("key"), (F.col("kind") == "l").alias("is_left"), "id"),
                                                   ["key"], "ts", "40 seconds", ["is_left", "id"], p.Reconcile(100)), "reconcile")
    said = sorted((r["key"] or -1, r["tag"]) for r in got.collect())
    assert said == [(-1, "match"), (1, "match"), (2, "only_left"), (3, "only_right"), (4, "only_left"), (4, "only_right")]


CONSOLE = """
import sys
from rillwork.session import local_session
spark = local_session("1", 1)
rows = spark.readStream.schema("id long, kind string").parquet(sys.argv[1])
rows.writeStream.format("console").option("checkpointLocation", sys.argv[2]).trigger(availableNow=True).start().awaitTermination()
"""


def test_console_prints_the_rows(spark, folder, tmp_path):
    """The sink prints in the JVM, so another process is run and what it prints is read."""
    put(spark, folder, "a", [(42, 1, at(1), "printed")])
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-c", CONSOLE, f"{folder}/a", str(tmp_path / "c")], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "| 42|printed|" in done.stdout
