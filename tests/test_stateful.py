"""Null rows in keyed streams, and stream forms with state of their own beside batch or plain loops."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rillwork.operators import folds, guards, windows as batch_windows
from rillwork.sinks import files as sinks
from rillwork.sources import roles
from rillwork.streaming import processors as p, runner, windows

T0 = datetime(2024, 1, 1)
SCHEMA = "id long, user_id long, ts timestamp, kind string, vc double, cents long"


def at(s):
    return None if s is None else T0 + timedelta(seconds=s)


def put(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def source(spark, folder):
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))
            .withColumnRenamed("id", "event_id"))


def row(i, user, s, kind="x", vc=1.0, cents=1):
    return i, user, at(s), kind, vc, cents


def keyed(spark, folder, keys, columns, processor, name, delay="0 seconds", **renamed):
    rows = source(spark, folder)
    for new, old in renamed.items():
        rows = rows.withColumnRenamed(old, new)
    return runner.replay(rows.select("ts", *keys, *columns), "ts", lambda df: p.keyed(df, keys, "ts", delay, columns, processor), name)


def test_rows_without_a_time_do_not_stop_a_stream(spark, tmp_path):
    put(spark, tmp_path / "in", "a", [row(1, 1, 5), row(2, 1, None), row(3, None, None), row(4, None, 7)])
    put(spark, tmp_path / "in", "b", [row(5, 1, 20), row(6, 2, None)])
    got = keyed(spark, tmp_path / "in", ["user_id"], ["event_id"], p.LateSplit(), "undated")
    assert sorted((r["event_id"], r["tag"]) for r in got.collect()) == [
        (1, "on_time"), (2, "undated"), (3, "undated"), (4, "on_time"), (5, "on_time"), (6, "undated")]
    for processor in (p.OnceAfterFirst(5), p.DailyLimit(1), p.NearFirst(100)):
        assert keyed(spark, tmp_path / "in", ["user_id"], ["event_id"], processor, "plain").count() > 0


def test_rows_of_the_year_9000_are_rows(spark, tmp_path):
    far = datetime(9000, 1, 1, 0, 0, 5)
    spark.createDataFrame([(1, 1, at(1), "x", 1.0, 1), (2, 1, far, "x", 1.0, 1)], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / "a"))
    got = keyed(spark, tmp_path / "in", ["user_id"], ["event_id"], p.LateSplit(), "far")
    # the closing row is told by its column, so a row of its year is neither lost nor late
    assert sorted(r["event_id"] for r in got.collect()) == [1, 2]


def test_null_values_count_as_in_batch(spark, tmp_path):
    rng = random.Random(2)
    rows = [row(i, rng.choice([1, 2, None]), 10 * i, "x", rng.choice([None, float("nan"), 1.0, 2.0, 3.0]), rng.choice([None, 5, 7])) for i in range(60)]
    for k in range(3):
        put(spark, tmp_path / "in", f"p{k}", rows[20 * k:20 * k + 20])
    batch = spark.createDataFrame(rows, SCHEMA)
    key = F.coalesce("user_id", F.lit(-1))
    got = keyed(spark, tmp_path / "in", ["user_id"], ["cents", "event_id"], p.CountWindow(4), "count")
    want = batch_windows.count_tumbling(batch, ["user_id"], ["ts", "id"], 4, cents=F.sum("cents"))
    assert sorted(map(tuple, got.select(key, "window_no", "cents").collect()), key=str) == sorted(map(tuple, want.select(key, "window_no", "cents").collect()), key=str)
    got = keyed(spark, tmp_path / "in", ["id"], ["vc", "event_id"], p.RisingAlarm(35), "rising", id="user_id")
    known = batch.filter("vc IS NOT NULL")
    want = guards.rising_alarms(known, ["user_id"], "ts", "id", "vc", 35)
    said = sorted((r["id"] or -1, r["alarm_at"]) for r in got.collect())
    assert said == sorted((r["user_id"] or -1, int((r["alarm_at"] - datetime(1970, 1, 1)).total_seconds() * 1e6)) for r in want.collect())
    ring = keyed(spark, tmp_path / "in", ["user_id"], ["cents", "event_id"], p.CountSlide(3, 2), "ring")
    fired = batch_windows.count_sliding(batch, ["user_id"], ["ts", "id"], 3, 2, F.struct("cents"))
    assert sorted((str(r["user_id"]), r["fired_at_row"], r["cents"]) for r in ring.collect()) == sorted(
        (str(r["user_id"]), r["fired_at_row"], [v["cents"] for v in r["values"]]) for r in fired.collect())


def test_other_kinds_are_no_payments(spark, tmp_path):
    put(spark, tmp_path / "in", "a", [row(1, 1, 0, "create"), row(2, 1, 5, "cancel"), row(3, 2, 0, "create"), row(4, 2, 1, None), row(5, 2, 9, "pay"), row(6, 3, 1, "other")])
    got = keyed(spark, tmp_path / "in", ["order_id"], ["kind", "event_id"], p.PaymentWatch(100, 10_000), "pay", order_id="user_id")
    assert sorted((r["order_id"], r["status"]) for r in got.collect()) == [(1, "timeout"), (2, "paid")]
    batch = spark.createDataFrame([row(1, 1, 0, "create"), row(2, 1, 5, "cancel"), row(3, 2, 0, "create"), row(4, 2, 1, None), row(5, 2, 9, "pay")], SCHEMA)
    assert sorted((r["user_id"], r["status"]) for r in guards.payment_status(batch, "user_id", "kind", "ts", 100).collect()) == [(1, "timeout"), (2, "paid")]


@pytest.mark.parametrize("size", [1, 3, 50])
def test_processors_do_not_depend_on_batches(spark, tmp_path, size):
    """One row a batch or all at once: the same rows, also where a key's rows of one hour come in several packs."""
    rng = random.Random(size)
    rows = [row(i, rng.choice([1, 2]), rng.randrange(20_000), "x", float(rng.randrange(9)), i) for i in range(24)]
    rows.sort(key=lambda r: (r[2] + timedelta(seconds=rng.randrange(400)), r[0]))
    for k in range(0, len(rows), -(-len(rows) // min(size, 4))):
        put(spark, tmp_path / "in", f"p{k}", rows[k:k + -(-len(rows) // min(size, 4))])
    got = keyed(spark, tmp_path / "in", ["user_id"], ["event_id"], p.DailyLimit(5), "limit", "500 seconds")
    batch = spark.createDataFrame(rows, SCHEMA)
    want = guards.below_daily_limit(batch, ["user_id"], "ts", ["ts", "id"], 5)
    assert sorted((r["user_id"], r["event_id"]) for r in got.filter("tag = 'pass'").collect()) == sorted((r["user_id"], r["id"]) for r in want.collect())


def test_a_fold_sees_rows_in_order(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b", None]), rng.randrange(50), rng.choice([None, *range(9)])) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, k string, t int, v int").repartition(5)

    def step(memory, r):
        memory = f"{memory or ''}{'-' if r['v'] is None else r['v']}"[-6:]
        return memory, memory

    for keys in (["k"], []):
        got = {r["id"]: r["seen"] for r in folds.fold(df, keys, ["t", "id"], ["v"], step, "string", "seen").collect()}
        memory, want = {}, {}
        for r in sorted(rows, key=lambda r: (r[2], r[0])):
            k = r[1] if keys else 0
            memory[k], want[r[0]] = step(memory.get(k), {"v": r[3]})
        assert got == want
    assert folds.fold(df.limit(0), ["k"], ["t", "id"], ["v"], step, "string").count() == 0


def test_sketches_are_near_the_exact_counts(spark):
    folder = "/root/testdata/sf0.01"
    exact = {(r["window_start"], r["window_end"]): r["uv"] for r in batch_windows.sliding_distinct_counts(
        roles.events(spark, folder).filter("event_type = 'view'"), "ts", "1 hour", "10 minutes", F.col("user_id")).collect()}
    for key in ("uv_sketch_sliding", "uv_sketch_stream"):
        found = {(r["window_start"], r["window_end"]): r["uv"] for r in entry.queries()[key](spark, folder).collect()}
        assert found.keys() == exact.keys()
        assert all(abs(found[w] - n) <= max(1, 0.1 * n) for w, n in exact.items())
    many = spark.range(400_000).select(F.timestamp_seconds(F.col("id") % 7200).alias("ts"), (F.col("id") % 50_000).alias("user_id"))
    for r in batch_windows.sliding_sketch_counts(many, "ts", "1 hour", "10 minutes", "user_id").filter("uv > 20000").collect():
        assert abs(r["uv"] - 50_000) < 0.07 * 50_000 or r["uv"] < 50_000


def test_bitmaps_count_numbers_of_several_buckets(spark):
    rng = random.Random(4)
    rows = [(T0 + timedelta(seconds=rng.randrange(9000)), rng.choice([None, rng.randrange(200_000), 5])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "ts timestamp, n long")
    for size, slide in (("1 hour", "20 minutes"), ("50 minutes", "20 minutes")):
        got = batch_windows.sliding_bitmap_counts(df, "ts", size, slide, "n")
        want = batch_windows.sliding(df.filter("n IS NOT NULL"), [], "ts", size, slide, uv=F.count_distinct("n"))
        assert sorted(map(tuple, got.select("window_start", "window_end", "uv").collect())) == sorted(map(tuple, want.select("window_start", "window_end", "uv").collect()))


def test_a_batch_that_is_run_again_changes_nothing(spark, tmp_path):
    store = str(tmp_path / "store")

    def batch(*rows):
        return spark.createDataFrame(rows, "k string, n long, t long")

    sinks.merge_batch(batch(("a", 1, 1), ("b", 2, 1), (None, 9, 1)), 0, store, ["k"], ["t"])
    second = batch(("a", 5, 3), ("a", 4, 2), ("b", 7, 0), ("c", 1, 1))
    for _ in range(2):
        sinks.merge_batch(second, 1, store, ["k"], ["t"])
        assert sorted(map(tuple, sinks.read_store(spark, store).collect()), key=str) == [("a", 5, 3), ("b", 2, 1), ("c", 1, 1), (None, 9, 1)]
    # a version that was written but not committed is not read
    batch(("z", 0, 0)).withColumn("__order", F.struct("t")).write.parquet(f"{store}/version=7")
    assert sinks.read_store(spark, store).count() == 4
    with pytest.raises(FileNotFoundError):
        sinks.read_store(spark, str(tmp_path / "none"))


def test_state_of_bounded_dedupe_stays_flat(spark, tmp_path):
    """Keys leave the state when the watermark has passed them; a repeat within the bound is dropped, one after it is a row again."""
    folder = tmp_path / "in"
    for k in range(6):
        put(spark, folder, f"p{k}", [row(i, 1, 100 * k + i % 10) for i in range(10 * k, 10 * k + 10)] + ([row(10 * k - 1, 1, 100 * k)] if k else []))
    out = windows.distinct_rows(source(spark, folder), ["event_id"], "ts", "50 seconds").select("event_id", "ts")
    query = runner.start(out, str(tmp_path / "out"), str(tmp_path / "check"), "append", {"availableNow": True})
    query.awaitTermination()
    sizes = [b["stateOperators"][0]["numRowsTotal"] for b in query.recentProgress if b["stateOperators"]]
    assert max(sizes) <= 30
    assert spark.read.parquet(str(tmp_path / "out")).count() >= 60


def test_late_partners_of_an_outer_join(spark):
    """Every signup once per purchase in time or once alone, whatever part its partner came with."""
    folder = "/root/testdata/sf0.001"
    found = entry.queries()["left_join_stream"](spark, folder)
    alone = found.filter("purchase_id IS NULL")
    assert alone.count() > 0 and found.filter("purchase_id IS NOT NULL").count() > 0
    assert alone.join(found.filter("purchase_id IS NOT NULL"), "signup_id", "left_semi").count() == 0


def test_arriving_events_lose_nothing(spark, tmp_path):
    """Null ids and times and repeated ids are rows; no part is written by one task alone if the log is read by several."""
    rows = [(i if i % 9 else None, datetime(2024, 1, 1) + timedelta(seconds=37 * i) if i % 7 else None, i % 3, "view", 1.0, "{}") for i in range(200)] + [
        (5, datetime(2024, 1, 1), 1, "view", 1.0, "{}")] * 3
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    df.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    arriving = roles.arriving_events(spark, str(tmp_path))
    for bring in arriving.parts:
        bring()
    out = str(tmp_path / "out")
    query = arriving.rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.parquet(out).count() == len(rows)
