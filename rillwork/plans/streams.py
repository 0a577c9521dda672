"""The streaming forms, run over the test tables to their end and checked like the batch ones."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from rillwork.operators import basic
from rillwork.operators.joins import stream_interval_join
from rillwork.plans.analyses import (ARRIVED_SQL, CLICK_LIMIT, CLICKS_SQL, DAY, HOT_PAGES_SQL, HOUR, HOURS, LINE_WORDS_SQL, NEXT_SQL,
                                     NTH_SQL, PAYMENT_SQL, RISING_SQL, VIEWS_SQL, document_lines, follow_sql, slots_sql, top3_sql)
from rillwork.plans.registry import query
from rillwork.sources import roles
from rillwork.sources.files import parse_web_log, stream_lines
from rillwork.streaming import processors as p, runner, windows

NO_DELAY = "0 seconds"


def without_zone(df: DataFrame) -> DataFrame:
    """Event times as the batch queries show them."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp"
                       else F.col(f.name) for f in df.schema.fields])


def at_micros(column: str):
    return F.timestamp_micros(column).cast("timestamp_ntz")


def hourly_sql(where: str, having: str) -> str:
    return f"""
SELECT * FROM (SELECT {HOURS} AS window_start, {HOURS} + INTERVAL '1 hour' AS window_end, count(*) AS n
               FROM events WHERE {where} GROUP BY 1, 2) WHERE {having}"""


# --- rows and running results ----------------------------------------------------------------

@query("append_stream", "SELECT user_id AS id, value AS vc, ts FROM events WHERE value > 50")
def append_stream(spark, folder):
    rows = roles.stream_events(spark, folder).filter("value > 50").select(
        F.col("user_id").alias("id"), F.col("value").alias("vc"), "ts")
    return without_zone(runner.drain(rows, "append"))


@query("word_count_stream", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def word_count_stream(spark, folder):
    schema = roles.table(spark, folder, "documents").schema
    lines = spark.readStream.schema(schema).parquet(f"{folder}/documents.parque[t]")
    counts = basic.words(lines, "text").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return runner.last_update(runner.drain(counts, "words", "update"), ["word"])


@query("word_count_text_stream", LINE_WORDS_SQL)
def word_count_text_stream(spark, folder):
    """Words of text files, a quarter of the files a micro-batch."""
    path = document_lines(spark, folder)
    files = len(spark.read.text(path).inputFiles())
    lines = stream_lines(spark, path, max(1, -(-files // 4)))
    counts = basic.words(lines).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return runner.last_update(runner.drain(counts, "text-words", "update"), ["word"])


@query("latest_per_key_stream", "SELECT user_id AS id, arg_max(value, event_id) AS vc FROM events GROUP BY user_id")
def latest_per_key_stream(spark, folder):
    newest = F.max_by("value", F.struct("ts", "event_id")).alias("vc")
    latest = roles.stream_events(spark, folder).groupBy(F.col("user_id").alias("id")).agg(newest)
    return runner.last_update(runner.drain(latest, "latest", "update"), ["id"])


@query("checkpointed_stream", "SELECT event_id, user_id, event_type FROM events")
def checkpointed_stream(spark, folder):
    """Stopped after the first half of the input, started again from its checkpoint for the rest."""
    rows = roles.events(spark, folder)
    middle = rows.agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0]
    source, path = runner.new_folder(spark, "restart-in"), runner.new_folder(spark, "restart-out")
    checkpoint = runner.new_folder(spark, "restart-checkpoint")
    for part in (F.col("event_id") <= middle, F.col("event_id") > middle):
        rows.filter(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source).select("event_id", "user_id", "event_type")
        runner.start(stream, path, checkpoint, trigger={"availableNow": True}).awaitTermination()
    return runner.read_results(spark, path, stream.schema)


# --- watermarks ------------------------------------------------------------------------------

def hourly(df: DataFrame, delay: str) -> DataFrame:
    return windows.tumbling(df, [], "ts", delay, "1 hour", n=F.count(F.lit(1)))


@query("watermark_ascending", hourly_sql("true", "window_end <= (SELECT max(ts) FROM events)"))
def watermark_ascending(spark, folder):
    return without_zone(runner.drain(hourly(roles.stream_events(spark, folder), NO_DELAY), "ascending"))


@query("watermark_bounded", hourly_sql("true", "window_end <= (SELECT max(ts) - INTERVAL 5 HOUR FROM events)"))
def watermark_bounded(spark, folder):
    return without_zone(runner.drain(hourly(roles.stream_events(spark, folder), "5 hours"), "bounded"))


@query("bounded_flush", hourly_sql("true", "true"))
def bounded_flush(spark, folder):
    source = roles.stream_events(spark, folder).select("ts", "event_id")
    out = runner.replay(source, "ts", lambda df: hourly(df, "5 hours"), "flush")
    return without_zone(out.filter(runner.before_end("window_start")))


@query("watermark_min_policy", hourly_sql("event_type IN ('view', 'purchase')", """
window_end <= least((SELECT max(ts) FROM events WHERE event_type = 'view'),
                    (SELECT max(ts) - INTERVAL 9 HOUR FROM events WHERE event_type = 'purchase'))"""))
def watermark_min_policy(spark, folder):
    """Two inputs with watermarks of their own: windows close by the slower one."""
    rows = roles.stream_events(spark, folder)
    views = rows.filter("event_type = 'view'").select("ts").withWatermark("ts", NO_DELAY)
    purchases = rows.filter("event_type = 'purchase'").select("ts").withWatermark("ts", "9 hours")
    both = (views.unionByName(purchases).groupBy(F.window("ts", "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n"))
    return without_zone(runner.drain(both, "two-watermarks"))


# --- windows, joins and ranking --------------------------------------------------------------

# Rows of ``arriving_events`` come up to an hour late.
LATEST = "1 hour"


def hottest_stream(spark, folder: str, role, keys: list[str], kinds: str, slide: str, name: str) -> DataFrame:
    """Top 3 of every sliding hour over several micro-batches with disorder; ``role`` makes the rows of events."""
    arriving = roles.arriving_events(spark, folder)
    source = role(arriving.rows)

    def closed_windows(df: DataFrame) -> DataFrame:
        counts = windows.sliding_counts(df, keys, "ts", LATEST, "1 hour", slide, "clicks")
        return counts.select("window_end", *keys, "clicks")

    ranked = spark.createDataFrame([], f"window_end timestamp, {kinds}, clicks long, rank long").schema
    return without_zone(runner.replay(source.select("ts", *keys), "ts", closed_windows, name,
                                      each_batch=windows.rank_closed_windows(keys, 3), result_schema=ranked, feed=arriving.parts))


@query("hot_items_stream", top3_sql(slots_sql(VIEWS_SQL, "item_id", 60, 5), "item_id"))
def hot_items_stream(spark, folder):
    return hottest_stream(spark, folder, roles.views_of_items, ["item_id"], "item_id int", "5 minutes", "hot-items")


@query("hot_pages_stream", HOT_PAGES_SQL)
def hot_pages_stream(spark, folder):
    pages = roles.table(spark, folder, "pages")

    def hits(rows: DataFrame) -> DataFrame:
        return parse_web_log(roles.web_log_lines(rows, pages)).withColumn("ts", F.col("ts").cast("timestamp"))

    return hottest_stream(spark, folder, hits, ["url"], "url string", "10 minutes", "hot-pages")


@query("hot_ads_stream", top3_sql(slots_sql(CLICKS_SQL, "province, ad_id", 60, 10), "province, ad_id"))
def hot_ads_stream(spark, folder):
    region = roles.table(spark, folder, "region")
    return hottest_stream(spark, folder, lambda rows: roles.ad_clicks(rows, region), ["province", "ad_id"], "province string, ad_id int", "10 minutes", "hot-ads")


@query("uv_hourly_stream", f"""
SELECT {HOURS} AS window_start, {HOURS} + INTERVAL '1 hour' AS window_end, count(DISTINCT user_id) AS uv
FROM events WHERE event_type = 'view' GROUP BY 1, 2""")
def uv_hourly_stream(spark, folder):
    views = roles.stream_events(spark, folder).filter("event_type = 'view'").select("ts", "user_id")
    out = runner.replay(views, "ts", lambda df: windows.distinct_counts(df, "ts", NO_DELAY, "1 hour", "user_id"), "uv")
    return without_zone(out.filter(runner.before_end("window_start")))


@query("session_window_stream", """
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL '3 hours' AS window_end, count(*) AS n
FROM (SELECT *, sum(CASE WHEN ts <= prev + INTERVAL '3 hours' THEN 0 ELSE 1 END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid
      FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events))
GROUP BY user_id, sid""")
def session_window_stream(spark, folder):
    rows = roles.stream_events(spark, folder).select("ts", "user_id")
    out = runner.replay(rows, "ts", lambda df: windows.session(
        df, ["user_id"], "ts", NO_DELAY, "3 hours", n=F.count(F.lit(1))), "sessions")
    return without_zone(out.filter(runner.before_end("window_start")))


@query("allowed_lateness_stream", hourly_sql("true", "true"))
def allowed_lateness_stream(spark, folder):
    """Every batch that adds to a window reports it again; the last report is the full count."""
    rows = roles.stream_events(spark, folder)
    updates = runner.drain(windows.refiring_counts(rows, [], "ts", "1 hour", 180, 120), "refiring", "update")
    return without_zone(runner.last_update(updates, ["window_start", "window_end"]))


@query("interval_join_stream", """
SELECT s.user_id, s.event_id AS signup_id, p.event_id AS purchase_id
FROM events s JOIN events p ON s.user_id = p.user_id AND s.event_type = 'signup' AND p.event_type = 'purchase'
AND p.ts BETWEEN s.ts - INTERVAL 1 HOUR AND s.ts + INTERVAL 1 HOUR""")
def interval_join_stream(spark, folder):
    rows = roles.stream_events(spark, folder)
    signups = rows.filter("event_type = 'signup'").select(
        "user_id", F.col("event_id").alias("signup_id"), F.col("ts").alias("signup_ts"))
    purchases = rows.filter("event_type = 'purchase'").select(
        F.col("user_id").alias("right_user_id"), F.col("event_id").alias("purchase_id"),
        F.col("ts").alias("purchase_ts"))
    pairs = stream_interval_join(signups, purchases, "user_id", "signup_ts", "purchase_ts", -HOUR, HOUR,
                                 NO_DELAY, NO_DELAY)
    return runner.drain(pairs.select("user_id", "signup_id", "purchase_id"), "interval-join")


# --- keyed state and timers ------------------------------------------------------------------

def replay_keyed(source: DataFrame, keys: list[str], columns: list[str], processor: p.InOrder, name: str) -> DataFrame:
    return runner.replay(source.select("ts", *keys, *columns), "ts",
                         lambda df: p.keyed(df, keys, "ts", NO_DELAY, columns, processor), name)


@query("event_time_timer", """
SELECT user_id, min(ts) + INTERVAL 1 HOUR AS fired_at FROM events GROUP BY user_id""")
def event_time_timer(spark, folder):
    out = replay_keyed(roles.stream_events(spark, folder), ["user_id"], ["event_id"], p.OnceAfterFirst(HOUR), "timer")
    return out.withColumn("fired_at", at_micros("fired_at"))


@query("processing_time_timer", "SELECT user_id, count(*) AS set_rows FROM events GROUP BY user_id")
def processing_time_timer(spark, folder):
    """Runs until a batch starts after the timers of all rows are due."""
    wait = 1000
    rows = roles.stream_events(spark, folder).select("user_id", "event_id")
    fired = rows.groupBy("user_id").transformWithState(
        statefulProcessor=p.AlarmClock(wait), outputStructType=p.AlarmClock.output_schema, outputMode="Append",
        timeMode="ProcessingTime")
    path = runner.new_folder(spark, "alarm-clock")
    query = runner.start(fired, path, path + "-checkpoint", trigger={"processingTime": "500 milliseconds"})

    def began(progress) -> float:
        return datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00")).timestamp()

    try:
        done = False
        while not done and query.isActive:
            time.sleep(0.3)
            seen = query.recentProgress
            with_rows = [began(b) for b in seen if b["numInputRows"] > 0]
            done = bool(with_rows) and began(seen[-1]) > max(with_rows) + 2 * wait / 1000
        if query.exception():
            raise query.exception()
    finally:
        query.stop()
    # One row per firing; rows of a key that came in different batches set different timers.
    return runner.read_results(spark, path, fired.schema).groupBy("user_id").agg(F.sum("set_rows").alias("set_rows"))


@query("keyed_state_api", """
SELECT user_id, event_type, of_type, n, newest FROM (
  SELECT user_id, event_type, count(*) AS of_type FROM events GROUP BY 1, 2) JOIN (
  SELECT user_id, max(rn) AS n, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id)
         FILTER (WHERE back <= 3) AS newest
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn,
               row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS back FROM events)
  GROUP BY user_id) USING (user_id)""")
def keyed_state_api(spark, folder):
    rows = roles.stream_events(spark, folder).select("user_id", "event_id", "event_type")
    state = rows.groupBy("user_id").transformWithState(
        statefulProcessor=p.StateKinds(3), outputStructType=p.StateKinds.output_schema, outputMode="Update",
        timeMode="None")
    return runner.last_update(runner.drain(state, "state-kinds", "update"), ["user_id", "event_type"])


@query("with_state_shortcuts", """
SELECT user_id, event_id, n, previous FROM (
  SELECT user_id, event_id, row_number() OVER w AS n, lag(event_type) OVER w AS previous, event_type
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE previous <> event_type""")
def with_state_shortcuts(spark, folder):
    """Keeps the rows whose type differs from the row before, with their number: 0 or 1 row out per row in."""
    def step(memory, row):
        n, previous = memory or (0, None)
        changed = previous is not None and previous != row["event_type"]
        return (n + 1, row["event_type"]), [(row["event_id"], n + 1, previous)] if changed else []

    processor = p.WithState(step, "n long, previous string",
                            "user_id long, event_id long, n long, previous string")
    return replay_keyed(roles.stream_events(spark, folder), ["user_id"], ["event_type", "event_id"], processor, "shortcut")


def limited_clicks(spark, folder, name: str) -> DataFrame:
    """Clicks per user and ad within the daily limit, and the alarms."""
    arriving = roles.arriving_events(spark, folder)
    clicks = roles.ad_clicks(arriving.rows, roles.table(spark, folder, "region"))
    limit = p.DailyLimit(CLICK_LIMIT, "user_id long, ad_id int")
    return runner.replay(clicks.select("ts", "user_id", "ad_id", "event_id"), "ts", lambda df: p.keyed(
        df, ["user_id", "ad_id"], "ts", LATEST, ["event_id"], limit), name, feed=arriving.parts)


@query("blacklist_stream", f"""
SELECT event_id, ts AS at, user_id, ad_id, CASE WHEN nth <= {CLICK_LIMIT} THEN 'pass' ELSE 'alarm' END AS tag
FROM ({NTH_SQL}) WHERE nth <= {CLICK_LIMIT} + 1""")
def blacklist_stream(spark, folder):
    return limited_clicks(spark, folder, "daily-limit").withColumn("at", at_micros("at"))


@query("clicks_after_blacklist_stream", slots_sql(f"SELECT ts, user_id, ad_id FROM ({NTH_SQL}) WHERE nth <= {CLICK_LIMIT}", "user_id, ad_id", 60, 5))
def clicks_after_blacklist_stream(spark, folder):
    """The clicks that the first stream let pass are the input of a second one, which counts them."""
    target = runner.new_folder(spark, "passed")
    passed = limited_clicks(spark, folder, "passing").filter("tag = 'pass'")
    passed.select(F.timestamp_micros("at").alias("ts"), "user_id", "ad_id").write.parquet(target)
    rows = spark.readStream.schema("ts timestamp, user_id long, ad_id int").parquet(target)
    out = runner.replay(rows, "ts", lambda df: windows.sliding_counts(
        df, ["user_id", "ad_id"], "ts", LATEST, "1 hour", "5 minutes", "clicks").select("window_end", "user_id", "ad_id", "clicks"), "counted")
    return without_zone(out.filter(runner.before_end("window_end")))


@query("late_side_output_stream", f"""
WITH a AS (SELECT event_id, user_id, ts, epoch_us(arrival) AS came FROM ({ARRIVED_SQL}) JOIN (SELECT event_id, user_id FROM events) USING (event_id)),
b AS (SELECT *, ((came - min(came) OVER ()) * 4) // (max(came) OVER () - min(came) OVER () + 1) AS part FROM a),
w AS (SELECT part, max(max(ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM b GROUP BY part)
SELECT event_id, user_id, CASE WHEN ts <= date_trunc('milliseconds', newest - INTERVAL 10 MINUTE) THEN 'late' ELSE 'on_time' END AS tag
FROM b JOIN w USING (part)""")
def late_side_output_stream(spark, folder):
    """Four micro-batches by arrival and a bound of ten minutes: what the batches before have passed is late."""
    arriving = roles.arriving_events(spark, folder)
    out = runner.replay(arriving.rows.select("ts", "user_id", "event_id"), "ts", lambda df: p.keyed(
        df, ["user_id"], "ts", "10 minutes", ["event_id"], p.LateSplit()), "late", feed=arriving.parts)
    return out.select("event_id", "user_id", "tag")


@query("reconcile_stream", """
SELECT coalesce(o_orderkey, l_orderkey) AS tx_id, o_orderdate AS ordered, received,
       CASE WHEN o_orderkey IS NULL THEN 'only_right' WHEN received IS NULL THEN 'only_left' ELSE 'match' END AS tag
FROM orders FULL JOIN (SELECT l_orderkey, min(l_shipdate) AS received FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def reconcile_stream(spark, folder):
    """Two inputs, one state per transaction; the bound is longer than these tables are apart."""
    def side(name: str, key: str, ts: str, is_left: bool) -> DataFrame:
        schema = roles.table(spark, folder, name).schema
        return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]").select(
            F.col(ts).cast("timestamp").alias("ts"), F.col(key).alias("key"), F.lit(is_left).alias("is_left"), F.lit(int(is_left)).alias("seq"))

    both = side("orders", "o_orderkey", "o_orderdate", True).unionByName(side("lineitem", "l_orderkey", "l_shipdate", False))
    out = replay_keyed(both, ["key"], ["is_left", "seq"], p.Reconcile(40 * 365 * DAY), "reconcile")
    return out.select(F.col("key").alias("tx_id"), at_micros("left_at").alias("ordered"), at_micros("right_at").alias("received"), "tag")


@query("order_timeout_stream", PAYMENT_SQL)
def order_timeout_stream(spark, folder):
    def side(name: str, key: str, ts: str, kind: str) -> DataFrame:
        schema = roles.table(spark, folder, name).schema
        return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]").select(
            F.col(ts).cast("timestamp").alias("ts"), F.col(key).alias("order_id"), F.lit(kind).alias("kind"))

    rows = (side("orders", "o_orderkey", "o_orderdate", "create")
            .unionByName(side("lineitem", "l_orderkey", "l_shipdate", "pay"))
            .withColumn("seq", F.when(F.col("kind") == "create", 0).otherwise(1)))
    # Kept long enough to learn of every late payment in these tables.
    watch = p.PaymentWatch(90 * DAY, 40 * 365 * DAY)
    out = replay_keyed(rows, ["order_id"], ["kind", "seq"], watch, "payments")
    last = out.groupBy("order_id").agg(F.max_by(F.struct("created", "paid", "status"), "at").alias("r"))
    return last.select("order_id", at_micros("r.created").alias("created"), at_micros("r.paid").alias("paid"), "r.status")


@query("rising_alarm_stream", RISING_SQL)
def rising_alarm_stream(spark, folder):
    rows = roles.sensor(roles.stream_events(spark, folder))
    out = replay_keyed(rows, ["id"], ["vc", "seq"], p.RisingAlarm(12 * HOUR), "rising")
    return out.withColumn("alarm_at", at_micros("alarm_at"))


@query("login_fail_pattern_stream", f"""
SELECT user_id, first_id, second_id FROM ({NEXT_SQL})
WHERE event_type = 'error' AND second_type = 'error' AND second_ts < first_ts + INTERVAL 6 HOUR""")
def login_fail_pattern_stream(spark, folder):
    failed = F.col("event_type") == "error"
    rows = (roles.stream_events(spark, folder).withColumn("is_first", failed).withColumn("is_second", failed))
    return replay_keyed(rows, ["user_id"], ["is_first", "is_second", "event_id"], p.NextRow(6 * HOUR), "logins")


@query("pattern_followed_by_stream", follow_sql(
    """user_id, event_id AS first_id, CASE WHEN second_ts < s.ts + INTERVAL 12 HOUR THEN second_id END AS second_id,
       CASE WHEN second_ts < s.ts + INTERVAL 12 HOUR THEN 'match' ELSE 'timeout' END AS tag""", "true"))
def pattern_followed_by_stream(spark, folder):
    rows = (roles.stream_events(spark, folder).filter("event_type IN ('signup', 'purchase')")
            .withColumn("is_first", F.col("event_type") == "signup")
            .withColumn("is_second", F.col("event_type") == "purchase"))
    return replay_keyed(rows, ["user_id"], ["is_first", "is_second", "event_id"], p.FollowedBy(12 * HOUR), "follow")


@query("count_window_stream", """
SELECT user_id, (rn - 1) // 3 AS window_no, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
GROUP BY 1, 2 HAVING count(*) = 3""")
def count_window_stream(spark, folder):
    rows = roles.stream_events(spark, folder).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    return replay_keyed(rows, ["user_id"], ["cents", "event_id"], p.CountWindow(3), "count-window")
