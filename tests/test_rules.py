"""Operators on small hand-written rows with results worked out by hand."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rillwork import schemas
from rillwork.functions import scalar as sc
from rillwork.operators import aggregate, basic, chains, guards, joins, lateness, patterns, windows
from rillwork.sinks import encode, files as out_files
from rillwork.sources import files, kafka

T0 = datetime(2019, 2, 1, 18, 2, 0)


def at(s):
    return T0 + timedelta(seconds=s)


def tuples(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


@pytest.fixture(scope="module")
def sensor(spark):
    """(seq, id, ts, vc): two sensors with falls and a pause."""
    rows = [(1, "s1", 0, 10), (2, "s1", 1, 20), (3, "s2", 2, 55), (4, "s1", 4, 30), (5, "s2", 5, 85),
            (6, "s1", 7, 25), (7, "s1", 8, 25), (8, "s2", 9, 60), (9, "s1", 14, 90)]
    return spark.createDataFrame([(q, i, at(s), v) for q, i, s, v in rows], "seq int, id string, ts timestamp_ntz, vc int")


def test_word_count(spark, tmp_path):
    (tmp_path / "w.txt").write_text("hi all\nhi you  all\n\nhi\n")
    words = basic.words(files.read_lines(spark, str(tmp_path / "w.txt")))
    assert tuples(aggregate.counts(words, "word")) == [("all", 2), ("hi", 3), ("you", 1)]


def test_bad_lines_are_kept_aside(spark):
    lines = spark.createDataFrame([("s1,100,5",), ("s1,x,5",)], "value string")
    got = files.parse_delimited(lines, schemas.WATER_SENSOR, bad_rows="bad")
    assert tuples(got.filter("bad IS NULL"), "id", "ts", "vc") == [("s1", 100, 5)]
    assert tuples(got.filter("bad IS NOT NULL"), "bad") == [("s1,x,5",)]


def test_web_log_line(spark):
    line = "83.149.9.216 u1 - 17/05/2015:10:05:03 +0000 GET /a/b.png"
    row = files.parse_web_log(spark.createDataFrame([(line,)], "value string")).first()
    assert tuple(row) == ("83.149.9.216", "u1", datetime(2015, 5, 17, 10, 5, 3), "GET", "/a/b.png")


def test_messages_round_trip(spark, sensor):
    rows = sensor.select("id", F.col("seq").cast("long").alias("ts"), "vc")
    messages = encode.topic_messages(rows, "id", ["id", "ts", "vc"])
    assert tuples(kafka.decode_values(messages, schemas.WATER_SENSOR)) == tuples(rows)


def test_delimited_table_and_insert(spark, sensor, tmp_path):
    path = str(tmp_path / "t")
    rows = sensor.select("id", F.col("seq").cast("long").alias("ts"), "vc")
    out_files.write_delimited(rows, path, "|")
    table = files.delimited_table(spark, path, schemas.WATER_SENSOR, "delimited", "|")
    assert tuples(table) == tuples(rows)
    assert tuples(spark.sql("SELECT count(*) FROM delimited")) == [(9,)]


def test_upsert_keeps_newest(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], "id string, vc int, no int")
    new = spark.createDataFrame([("a", 9, 2), ("c", 3, 2)], "id string, vc int, no int")
    assert tuples(out_files.upsert(old, new, ["id"], "no")) == [("a", 9, 2), ("b", 2, 1), ("c", 3, 2)]


def test_labels_and_routes(sensor):
    marked = basic.label(sensor, [(F.col("vc") < 50, ["normal"]), (F.col("vc") < 80, ["warn", "high"])],
                         ["alarm", "high"])
    assert tuples(basic.labelled(marked, "high"), "seq") == [(3,), (5,), (8,), (9,)]
    assert tuples(basic.labelled(marked, "alarm"), "seq") == [(5,), (9,)]
    routed = basic.route(sensor, [("alarm", F.col("vc") > 80)])
    assert tuples(basic.output(routed, "alarm"), "seq") == [(5,), (9,)]
    assert basic.output(routed, "main").count() == 7


def test_keys_land_together(sensor):
    placed = basic.partition_by_key(sensor, "id", partitions=4).withColumn("p", F.spark_partition_id())
    assert placed.groupBy("id").agg(F.count_distinct("p").alias("n")).filter("n > 1").count() == 0
    assert tuples(basic.shuffle(sensor, 3)) == tuples(sensor)


def test_tumbling_windows(sensor):
    got = windows.tumbling(sensor, ["id"], "ts", "5 seconds", n=F.count(F.lit(1)))
    assert tuples(got, "id", "window_start", "n") == [
        ("s1", at(0), 3), ("s1", at(5), 2), ("s1", at(10), 1), ("s2", at(0), 1), ("s2", at(5), 2)]


def test_sliding_counts_equal_builtin(sensor):
    ours = windows.sliding_counts(sensor, ["id"], "ts", "6 seconds", "2 seconds")
    builtin = windows.sliding(sensor, ["id"], "ts", "6 seconds", "2 seconds", n=F.count(F.lit(1)))
    assert tuples(ours, "id", "window_start", "window_end", "n") == tuples(builtin, "id", "window_start", "window_end", "n")
    # a size that is no multiple of the slide is counted in panes of their greatest common divisor
    odd = windows.sliding_counts(sensor, ["id"], "ts", "5 seconds", "2 seconds")
    assert tuples(odd, "id", "window_start", "window_end", "n") == tuples(
        windows.sliding(sensor, ["id"], "ts", "5 seconds", "2 seconds", n=F.count(F.lit(1))), "id", "window_start", "window_end", "n")


@pytest.mark.parametrize("per_segment", [None, 3])
def test_sliding_distinct_counts_equal_builtin(sensor, per_segment):
    ours = windows.sliding_distinct_counts(sensor, "ts", "6 seconds", "2 seconds", F.col("vc") % 3, "uv", per_segment)
    builtin = windows.sliding(sensor, [], "ts", "6 seconds", "2 seconds", uv=F.count_distinct(F.col("vc") % 3))
    assert tuples(ours) == tuples(builtin)


@pytest.mark.parametrize("per_segment", [None, 3])
def test_session_joins_at_exactly_the_gap(sensor, per_segment):
    got = windows.session(sensor, ["id"], "ts", "seq", "3 seconds", per_segment, n=F.count(F.lit(1)))
    assert tuples(got) == [("s1", at(0), at(11), 5), ("s1", at(14), at(17), 1),
                           ("s2", at(2), at(8), 2), ("s2", at(9), at(12), 1)]


@pytest.mark.parametrize("per_segment", [None, 2])
def test_count_windows(sensor, per_segment):
    whole = windows.count_tumbling(sensor, ["id"], ["ts", "seq"], 3, per_segment, total=F.sum("vc"))
    assert tuples(whole) == [("s1", 0, 60), ("s1", 1, 140), ("s2", 0, 200)]
    fired = windows.count_sliding(sensor, ["id"], ["ts", "seq"], 3, 2, F.col("vc"), cell=per_segment)
    assert tuples(fired, "id", "fired_at_row", "values") == [
        ("s1", 2, [20, 10]), ("s1", 4, [25, 30, 20]), ("s1", 6, [90, 25, 25]), ("s2", 2, [85, 55])]


def test_approximate_distinct_is_close(spark):
    rows = spark.range(20000).select(F.lit(T0).cast("timestamp_ntz").alias("ts"), (F.col("id") % 5000).alias("u"))
    uv = windows.approx_distinct_counts(rows, "ts", "1 hour", F.col("u"), 0.02).first()["uv"]
    assert abs(uv - 5000) < 5000 * 0.06


def test_top_n_settles_ties_by_key(spark):
    rows = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, "c", 4), (2, "z", 1)], "w int, k string, n int")
    got = windows.top_n(rows, ["w"], [F.col("n").desc(), F.col("k").asc()], 2)
    assert tuples(got) == [(1, "a", 5, 1), (1, "b", 5, 2), (2, "z", 1, 1)]


def test_changelog(sensor):
    got = aggregate.changelog(sensor.filter("id = 's2'").select("id", "ts", "seq"), ["id"], ["ts", "seq"])
    assert tuples(got, "seq", "add", "n") == [(3, True, 1), (5, False, 1), (5, True, 2), (8, False, 2), (8, True, 3)]


def test_running_distinct(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c")], "seq int, u string")
    for per_segment in (None, 2):
        assert tuples(aggregate.running_distinct(rows, ["seq"], "u", "uv", per_segment)) == [(1, 1), (2, 2), (3, 2), (4, 3)]


def test_latest(sensor):
    assert tuples(aggregate.latest(sensor, ["id"], ["ts", "seq"], ["vc"])) == [("s1", 90), ("s2", 60)]


def test_poly_hash(spark):
    def by_hand(text):
        h = 0
        for c in text:
            h = h * 61 + ord(c)
        return h & (2**30 - 1)

    words = ["", "a", "204871", "a longer text that wraps around 30 bits"]
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", sc.poly_hash(F.col("w")).alias("h"))
    assert {r["w"]: r["h"] for r in df.collect() if r["w"]} == {w: by_hand(w) for w in words if w}


# --- joins -----------------------------------------------------------------------------------

def test_interval_join_includes_both_ends(spark):
    left = spark.createDataFrame([("k", 1, at(100))], "k string, l int, lts timestamp_ntz")
    right = spark.createDataFrame([("k", s, at(s)) for s in (94, 95, 100, 105, 106)] + [("x", 0, at(100))],
                                  "k string, r int, rts timestamp_ntz")
    assert tuples(joins.interval_join(left, right, ["k"], "lts", "rts", -5, 5), "l", "r") == [(1, 95), (1, 100), (1, 105)]


def test_interval_join_equals_plain_join(spark):
    def side(n, step, name):
        return spark.range(n).select((F.col("id") % 3).alias("k"), F.col("id").alias(name), (
            F.lit(T0).cast("timestamp_ntz") + sc.seconds(1) * (F.col("id") * step % 97)).alias(name + "ts"))

    a, b = side(60, 7, "a"), side(80, 11, "b")
    ours = joins.interval_join(a, b, ["k"], "ats", "bts", -4, 9)
    plain = a.join(b, "k").filter("bts BETWEEN ats - INTERVAL 4 SECOND AND ats + INTERVAL 9 SECOND")
    assert tuples(ours, "a", "b") == tuples(plain, "a", "b")


def test_reconcile_ignores_empty_keys(spark):
    orders = spark.createDataFrame([("", 1), ("t1", 2), ("t2", 3), (None, 4)], "tx string, o int")
    receipts = spark.createDataFrame([("", 7), ("t2", 8), ("t3", 9)], "tx string, r int")
    assert tuples(joins.reconcile(orders, receipts, "tx", "o", "r")) == [("t2", 3, 8)]


def test_reconcile_keeps_keys_with_a_null_value(spark):
    orders = spark.createDataFrame([("t1", None), ("t2", 3), ("t3", 4)], "tx string, o int")
    receipts = spark.createDataFrame([("t1", 7), ("t2", None), ("t4", 9)], "tx string, r int")
    assert tuples(joins.reconcile(orders, receipts, "tx", "o", "r").fillna(-1)) == [("t1", -1, 7), ("t2", 3, -1)]


# --- patterns --------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def steps(spark):
    """One key: a b a a c b a ..."""
    rows = [("k", i, at(i * 10), kind) for i, kind in enumerate("abaacbab")] + [("other", 100, at(0), "a")]
    return spark.createDataFrame(rows, "k string, id int, ts timestamp_ntz, kind string")


A, B, ID = "kind = 'a'", "kind = 'b'", ["id", "ts"]


def pairs(df, second="second"):
    return tuples(df, "first.id", f"{second}.id")


@pytest.mark.parametrize("per_segment", [None, 2])
def test_patterns(steps, per_segment):
    args = (["k"], ["ts", "id"], F.expr(A), F.expr(B), ID)
    kw = {"cell": per_segment}
    assert pairs(patterns.next_row(steps, *args, **kw)) == [(0, 1), (6, 7)]
    assert pairs(patterns.followed_by(steps, *args, **kw)) == [(0, 1), (2, 5), (3, 5), (6, 7)]
    # 2 -> 5 takes exactly 30 s, so it is out.
    assert pairs(patterns.followed_by(steps, *args, 30, **kw)) == [(0, 1), (3, 5), (6, 7)]
    assert tuples(patterns.timed_out(steps, *args, 30, **kw), "k", "first.id") == [("k", 2), ("other", 100)]
    assert pairs(patterns.followed_by_any(steps, *args, 51)) == [(0, 1), (0, 5), (2, 5), (2, 7), (3, 5), (3, 7), (6, 7)]
    assert pairs(patterns.followed_by_any(steps, *args, 50)) == [(0, 1), (2, 5), (3, 5), (3, 7), (6, 7)]
    assert pairs(patterns.times(steps, *args[:2], F.expr(A), ID, 2, **kw), "last") == [(0, 2), (2, 3), (3, 6)]
    ranged = patterns.times_range(steps, *args[:2], F.expr(A), ID, 1, 3, 31, **kw)
    assert tuples(ranged, "times", "first.id", "last.id") == [
        (1, 0, 0), (1, 2, 2), (1, 3, 3), (1, 6, 6), (1, 100, 100), (2, 0, 2), (2, 2, 3), (2, 3, 6), (3, 0, 3)]


# --- lateness and guards ---------------------------------------------------------------------

@pytest.mark.parametrize("per_segment", [None, 2])
def test_lateness(spark, per_segment):
    """Windows of 5 s, bound 3 s, lateness 2 s, arrivals in row order."""
    rows = [(i, at(s)) for i, s in enumerate([1, 4, 8, 3, 9, 4, 10, 2, 12])]
    df = spark.createDataFrame(rows, "arrival int, ts timestamp_ntz")
    got = lateness.classify(df, ["arrival"], "ts", "5 seconds", 3, 2, per_segment)
    # The watermark reaches 5 with row 2, 6 with row 4 and 7 with row 6; the first window closes at 7.
    assert [r[0] for r in got.orderBy("arrival").select("status").collect()] == [
        "on_time", "on_time", "on_time", "refire", "on_time", "refire", "on_time", "late", "on_time"]
    fired = lateness.firings(df, ["arrival"], "ts", "5 seconds", 3, 2, per_segment)
    assert tuples(fired.filter(F.col("window_start") == at(0)).fillna(-1), "refired_by", "n") == [(-1, 2), (3, 3), (5, 4)]


def test_daily_limit(spark):
    day = datetime(2020, 9, 4, 23, 59, 50)
    rows = [(i, "u", day + timedelta(seconds=i)) for i in range(16)]  # 10 before midnight, 6 after
    df = spark.createDataFrame(rows, "id int, u string, ts timestamp_ntz")
    assert tuples(guards.below_daily_limit(df, ["u"], "ts", ["ts", "id"], 4), "id") == [
        (0,), (1,), (2,), (3,), (10,), (11,), (12,), (13,)]
    assert tuples(guards.limit_alarms(df, ["u"], "ts", ["ts", "id"], 4), "id") == [(4,), (14,)]


def test_failures_compare_with_the_first(spark):
    rows = [(1, "u", at(0)), (2, "u", at(2)), (3, "u", at(3)), (4, "v", at(9)), (5, None, at(0)), (6, None, at(1))]
    df = spark.createDataFrame(rows, "id int, u string, ts timestamp_ntz")
    got = guards.repeated_failures(df, ["u"], "ts", ["ts", "id"])
    assert tuples(got, "id") == [(2,), (6,)]


def test_payment_status(spark):
    limit = guards.PAY_SECONDS
    rows = [(1, "create", at(0)), (1, "pay", at(limit)), (2, "create", at(0)), (2, "pay", at(limit + 1)),
            (3, "create", at(0)), (4, "pay", at(5)), (5, "pay", at(0)), (5, "create", at(60)),
            (6, "create", None), (6, "pay", at(5))]
    df = spark.createDataFrame(rows, "o int, kind string, ts timestamp_ntz")
    assert tuples(guards.payment_status(df, "o", "kind", "ts"), "o", "status") == [
        (1, "paid"), (2, "late"), (3, "timeout"), (4, "missing_create"), (5, "paid"), (6, "paid")]


def alarms_by_loop(rows, hold):
    """The state machine of one key, row by row."""
    out, height, due = [], 0, None
    for t, v in rows:
        if due is not None and due < t:
            out.append(due)
            due = None
        if v < height:
            due = None
        elif due is None:
            due = t + hold
        height = v
    return out + ([due] if due is not None else [])


@pytest.mark.parametrize("per_segment,batch", [(None, 10000), (25, 10000), (None, 7), (25, 3), (6, 10000)])
def test_rising_alarms_equal_loop(spark, monkeypatch, per_segment, batch):
    long = []
    monkeypatch.setattr(guards, "long_chains", lambda *a: long.append(a) or chains.long_chains(*a))
    rnd = random.Random(11)
    rows, no = [], 0
    for key, fall in (("steady", 0.01), ("normal", 0.3), ("calm", 0.0), (None, 0.1)):
        t, v = 0, 5
        for _ in range(120):
            t += rnd.choice([0, 1, 1, 2, 3, 9 if key == "normal" else 4])
            v = max(v + (-2 if rnd.random() < fall else rnd.choice([0, 1])), 0)
            rows.append((no, key, at(t), v, t))
            no += 1
    df = spark.createDataFrame(rows, "seq int, k string, ts timestamp_ntz, v int, t int").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = tuples(guards.rising_alarms(df, ["k"], "ts", "seq", "v", 5, per_segment, 20 if per_segment else 10**6)
                     .select(F.coalesce("k", F.lit("none")).alias("k"), "alarm_at"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = []
    for key in ("steady", "normal", "calm", None):
        want += [(key or "none", at(a)) for a in alarms_by_loop([(r[4], r[3]) for r in rows if r[1] == key], 5)]
    assert got == sorted(want)
    assert bool(long) == (per_segment is not None)
