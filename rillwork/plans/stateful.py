"""Patterns of several steps, user folds, and stream forms with state of their own: change logs, rings, sketches, outer joins, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rillwork.functions import scalar as sc
from rillwork.operators import automaton, folds, windows as batch_windows
from rillwork.plans.analyses import COUNT_SLIDE_SQL, DAY, FIRST_FAILURE_SQL, HOUR, ORDER, RETRACT_SQL, VIEWS_SQL, events, is_type, slots_sql, typed
from rillwork.plans.registry import query
from rillwork.plans.streams import LATEST, NO_DELAY, at_micros, replay_keyed, without_zone
from rillwork.sinks import files as sinks
from rillwork.sources import roles
from rillwork.streaming import processors as p, runner, windows

# --- patterns of several steps ---------------------------------------------------------------

IDS = ["event_id"]


def funnel() -> automaton.Pattern:
    """A view, a click right after it, and the next purchase, within two days."""
    return automaton.begin("view", is_type("view")).next("click", is_type("click")).followed_by("purchase", is_type("purchase")).lasting(2 * DAY)


FUNNEL_SQL = """
WITH RECURSIVE n AS (SELECT user_id, event_id, ts, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
r AS (
    SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY rn) AS next_ts,
        min(CASE WHEN event_type = 'purchase' THEN rn END) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS buy
    FROM n),
walk(user_id, first_ts, step, rn, ids) AS (
    SELECT user_id, ts, 1, rn, [event_id] FROM r WHERE event_type = 'view'
    UNION ALL
    SELECT w.user_id, w.first_ts, w.step + 1, x.rn, list_append(w.ids, x.event_id)
    FROM walk w JOIN r cur ON cur.user_id = w.user_id AND cur.rn = w.rn
        JOIN r x ON x.user_id = w.user_id AND x.rn = CASE WHEN w.step = 1 THEN w.rn + 1 ELSE cur.buy END
    WHERE w.step < 3 AND x.event_type = CASE WHEN w.step = 1 THEN 'click' ELSE 'purchase' END AND x.ts < w.first_ts + INTERVAL 2 DAY)
SELECT user_id, 'match' AS tag, ids[1] AS view_id, ids[2] AS click_id, ids[3] AS purchase_id FROM walk WHERE step = 3
UNION ALL
SELECT w.user_id, 'timeout', ids[1], ids[2], NULL
FROM walk w JOIN r cur ON cur.user_id = w.user_id AND cur.rn = w.rn LEFT JOIN r b ON b.user_id = w.user_id AND b.rn = cur.buy
WHERE w.step = 1 AND coalesce(cur.next_ts >= w.first_ts + INTERVAL 2 DAY, true)
   OR w.step = 2 AND coalesce(b.ts >= w.first_ts + INTERVAL 2 DAY, true)"""


@query("pattern_three_steps", FUNNEL_SQL)
def pattern_three_steps(spark, folder):
    found = automaton.matches(typed(spark, folder), ["user_id"], ORDER, funnel(), IDS)
    return found.select("user_id", "tag", *[F.col(f"{s}.event_id").alias(f"{s}_id") for s in ("view", "click", "purchase")])


def watched(spark, folder, pattern: automaton.Pattern, name: str) -> DataFrame:
    """(user_id, tag, steps, ids) of the matches in the event stream."""
    rows = roles.stream_events(spark, folder).withColumn("hits", pattern.hits())
    return replay_keyed(rows, ["user_id"], ["hits", "event_id"], p.PatternWatch(pattern.machine()), name)


@query("pattern_three_steps_stream", FUNNEL_SQL)
def pattern_three_steps_stream(spark, folder):
    found = watched(spark, folder, funnel(), "three-steps")
    return found.select("user_id", "tag", *[F.get("ids", F.lit(i)).alias(f"{s}_id") for i, s in enumerate(("view", "click", "purchase"))])


def mixed() -> automaton.Pattern:
    """Two or three errors, others in between, and every purchase after them, within two days."""
    return automaton.begin("error", is_type("error")).times(2, 3).followed_by_any("purchase", is_type("purchase")).lasting(2 * DAY)


MIXED_SQL = """
WITH RECURSIVE e AS (
    SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE event_type = 'error'),
walk(user_id, first_id, first_ts, times, last_id, last_ts, rn) AS (
    SELECT user_id, event_id, ts, 1, event_id, ts, rn FROM e
    UNION ALL
    SELECT w.user_id, w.first_id, w.first_ts, w.times + 1, e.event_id, e.ts, e.rn FROM walk w JOIN e ON e.user_id = w.user_id AND e.rn = w.rn + 1
    WHERE w.times < 3 AND e.ts < w.first_ts + INTERVAL 2 DAY)
SELECT w.user_id, w.times, w.first_id, w.last_id, q.event_id AS purchase_id
FROM walk w JOIN events q ON q.user_id = w.user_id AND q.event_type = 'purchase' AND (q.ts, q.event_id) > (w.last_ts, w.last_id)
    AND q.ts < w.first_ts + INTERVAL 2 DAY
WHERE w.times >= 2"""


@query("pattern_mixed", MIXED_SQL)
def pattern_mixed(spark, folder):
    found = automaton.matches(typed(spark, folder), ["user_id"], ORDER, mixed(), IDS).filter("tag = 'match'")
    return found.select("user_id", F.size("error").alias("times"), F.col("error")[0]["event_id"].alias("first_id"),
                        F.element_at("error", -1)["event_id"].alias("last_id"), F.col("purchase.event_id").alias("purchase_id"))


@query("pattern_mixed_stream", MIXED_SQL)
def pattern_mixed_stream(spark, folder):
    found = watched(spark, folder, mixed(), "mixed").filter("tag = 'match'")
    return found.select("user_id", (F.size("ids") - 1).alias("times"), F.col("ids")[0].alias("first_id"), F.element_at("ids", -2).alias("last_id"),
                        F.element_at("ids", -1).alias("purchase_id"))


# --- folds of user functions -----------------------------------------------------------------

SMOOTH_SQL = """
WITH RECURSIVE r AS (
    SELECT user_id, event_id, CAST(round(value * 100) AS BIGINT) AS cents, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
walk(user_id, event_id, rn, smooth) AS (
    SELECT user_id, event_id, rn, cents FROM r WHERE rn = 1
    UNION ALL
    SELECT r.user_id, r.event_id, r.rn, CAST(floor((3 * w.smooth + r.cents) / 4) AS BIGINT) FROM walk w JOIN r ON r.user_id = w.user_id AND r.rn = w.rn + 1)
SELECT user_id, event_id, smooth FROM walk"""


def smoothed(memory, row):
    """A reduce that is no sum: three parts of what was and one of what comes, in whole cents."""
    if row["cents"] is None:
        return memory, memory
    memory = row["cents"] if memory is None else (3 * memory + row["cents"]) // 4
    return memory, memory


@query("keyed_fold", SMOOTH_SQL)
def keyed_fold(spark, folder):
    rows = events(spark, folder).select("user_id", "ts", "event_id", F.round(F.col("value") * 100).cast("long").alias("cents"))
    return folds.fold(rows, ["user_id"], ORDER, ["cents"], smoothed, "long", "smooth").select("user_id", "event_id", "smooth")


@query("keyed_fold_stream", SMOOTH_SQL)
def keyed_fold_stream(spark, folder):
    def step(memory, row):
        smooth, _ = smoothed(memory[0] if memory else None, row)
        return (smooth,), [(row["event_id"], smooth)]

    rows = roles.stream_events(spark, folder).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    return replay_keyed(rows, ["user_id"], ["cents", "event_id"], p.WithState(step, "smooth long", "user_id long, event_id long, smooth long"), "fold")


# --- change logs -----------------------------------------------------------------------------

@query("retract_stream", RETRACT_SQL)
def retract_stream(spark, folder):
    """Every row takes back the count its key had and sets the new one, as ``retract_changelog`` does in batch."""
    out = replay_keyed(roles.stream_events(spark, folder), ["event_type"], ["event_id"], p.Retract("event_type string"), "retract")
    return out.select("event_type", at_micros("at").alias("ts"), "event_id", F.col("added").alias("add"), "n")


@query("retract_counts_stream", "SELECT n, count(*) AS users FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1) GROUP BY 1")
def retract_counts_stream(spark, folder):
    """The change log of one stream under a second aggregate: how many users have how many rows, as rows are taken back and set.

    A quarter of the log's files is a micro-batch, as every one reads and writes all of the state's partitions.
    """
    target = runner.new_folder(spark, "changes")
    changes = replay_keyed(roles.stream_events(spark, folder), ["user_id"], ["event_id"], p.Retract("user_id long"), "changes")
    changes.select("n", "added").write.parquet(target)
    files = len(spark.read.parquet(target).inputFiles())
    rows = spark.readStream.schema("n long, added boolean").option("maxFilesPerTrigger", max(1, -(-files // 4))).parquet(target)
    users = rows.groupBy("n").agg(F.sum(F.when(F.col("added"), 1).otherwise(-1)).alias("users"))
    return runner.last_update(runner.drain(users, "users", "update"), ["n"]).filter("users > 0")


@query("login_fail_state_stream", FIRST_FAILURE_SQL)
def login_fail_state_stream(spark, folder):
    fails = roles.logins(roles.stream_events(spark, folder)).filter("failed")
    out = replay_keyed(fails, ["user_id"], ["event_id"], p.NearFirst(2 * DAY), "first-failure")
    return out.select("user_id", "event_id", at_micros("at").alias("ts"), at_micros("first_at").alias("first_ts"))


# --- windows ---------------------------------------------------------------------------------

@query("count_window_sliding_stream", COUNT_SLIDE_SQL)
def count_window_sliding_stream(spark, folder):
    rows = roles.stream_events(spark, folder).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    out = replay_keyed(rows, ["user_id"], ["cents", "event_id"], p.CountSlide(3, 2), "count-slide")
    total = F.aggregate("cents", F.lit(0).cast("long"), lambda s, x: s + F.coalesce(x, F.lit(0)))
    return out.select("user_id", "fired_at_row", F.size("cents").cast("long").alias("n"), (total / 100).alias("total"))


@query("table_tumble_stream", """
SELECT user_id AS id, time_bucket(INTERVAL '5 minutes', ts) AS window_start, count(*) AS n FROM events GROUP BY 1, 2""")
def table_tumble_stream(spark, folder):
    """SQL over a stream that is registered as a view."""
    def plan(df: DataFrame) -> DataFrame:
        df.withWatermark("ts", LATEST).createOrReplaceTempView("sensor_stream")
        return spark.sql("SELECT id, window.start AS window_start, count(*) AS n FROM sensor_stream GROUP BY id, window(ts, '5 minutes')")

    arriving = roles.arriving_events(spark, folder)
    out = runner.replay(roles.sensor(arriving.rows).select("ts", "id"), "ts", plan, "sql-tumble", feed=arriving.parts)
    return without_zone(out.filter(runner.before_end("window_start")))


@query("table_slide_stream", slots_sql(VIEWS_SQL, "item_id", 60, 5))
def table_slide_stream(spark, folder):
    """Panes and then windows in SQL over a stream that is registered as a view."""
    def plan(df: DataFrame) -> DataFrame:
        df.withWatermark("ts", LATEST).createOrReplaceTempView("views_stream")
        return spark.sql("""
            SELECT item_id, window.end AS window_end, sum(n) AS clicks
            FROM (SELECT item_id, window AS pane, count(*) AS n FROM views_stream GROUP BY item_id, window(ts, '5 minutes'))
            GROUP BY item_id, window(window_time(pane), '1 hour', '5 minutes')""")

    arriving = roles.arriving_events(spark, folder)
    out = runner.replay(roles.views_of_items(arriving.rows).select("ts", "item_id"), "ts", plan, "sql-slide", feed=arriving.parts)
    return without_zone(out.filter(runner.before_end("window_end")))


# --- distinct users from panes ---------------------------------------------------------------

def sliding_users_sql(size: int, slide: int) -> str:
    """Distinct users of every sliding window, in minutes."""
    begin = f"time_bucket(INTERVAL '{slide} minutes', ts) - to_minutes({slide} * i)"
    return f"""
SELECT {begin} AS window_start, {begin} + INTERVAL '{size} minutes' AS window_end, count(DISTINCT user_id) AS uv
FROM events, range({size // slide}) r(i) WHERE event_type = 'view' GROUP BY 1, 2"""


def views_of_users(df: DataFrame) -> DataFrame:
    return df.filter(is_type("view")).select("ts", "user_id")


@query("uv_bitmap_panes", sliding_users_sql(60, 20))
def uv_bitmap_panes(spark, folder):
    """Bitmaps of user numbers in buckets, one for each pane, united over the panes of a window."""
    return batch_windows.sliding_bitmap_counts(views_of_users(events(spark, folder)), "ts", "1 hour", "20 minutes", "user_id", "uv")


@query("uv_bitmap_panes_stream", sliding_users_sql(60, 20))
def uv_bitmap_panes_stream(spark, folder):
    """The state holds bitmaps, whose size does not grow with the rows."""
    arriving = roles.arriving_events(spark, folder)
    out = runner.replay(views_of_users(arriving.rows), "ts", lambda df: windows.sliding_bitmap_parts(
        df, "ts", LATEST, "1 hour", "20 minutes", "user_id"), "bitmaps", feed=arriving.parts)
    counts = out.filter(runner.before_end("window_start") & F.col("bucket").isNotNull()).groupBy("window_start", "window_end").agg(F.sum("uv").alias("uv"))
    return without_zone(counts)


@query("uv_sketch_sliding")
def uv_sketch_sliding(spark, folder):
    """An estimate from sketches of panes; the tests bound its error."""
    return batch_windows.sliding_sketch_counts(views_of_users(events(spark, folder)), "ts", "1 hour", "10 minutes", "user_id", "uv")


@query("uv_sketch_stream")
def uv_sketch_stream(spark, folder):
    arriving = roles.arriving_events(spark, folder)
    out = runner.replay(views_of_users(arriving.rows), "ts", lambda df: windows.sliding_sketch_counts(
        df, "ts", LATEST, "1 hour", "10 minutes", "user_id", "uv"), "sketches", feed=arriving.parts)
    return without_zone(out.filter(runner.before_end("window_start")))


# --- joins and sinks -------------------------------------------------------------------------

@query("left_join_stream", """
SELECT s.user_id, s.event_id AS signup_id, p.event_id AS purchase_id FROM (SELECT * FROM events WHERE event_type = 'signup') s
LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON p.user_id = s.user_id AND p.ts BETWEEN s.ts AND s.ts + INTERVAL 6 HOUR""")
def left_join_stream(spark, folder):
    """Signups with the purchases of six hours, or alone once no purchase can come in time any more.

    The join's key has a cell of six hours beside the user: a signup is in its own cell, a purchase in its own and the one before, so
    a row meets rows near it in time and not all that the state holds of its user.
    """
    def plan(df: DataFrame) -> DataFrame:
        def side(event_type: str) -> DataFrame:  # the closing row moves both watermarks
            return df.filter(is_type(event_type) | F.col(runner.CLOSING))

        cell = sc.floor_div(sc.epoch_micros(F.col("ts")), 6 * HOUR * 1_000_000)
        signups = side("signup").select("user_id", cell.alias("cell"), F.col("event_id").alias("signup_id"),
                                        F.col("ts").alias("signup_ts")).withWatermark("signup_ts", LATEST)
        # the join asks for a key here, which the closing row must have to get to the watermark
        key = F.when(F.col(runner.CLOSING), -1).otherwise(F.col("user_id"))
        purchases = side("purchase").select(key.alias("right_user_id"), F.explode(F.array(cell, cell - 1)).alias("right_cell"),
                                            F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts")).withWatermark("purchase_ts", LATEST)
        return signups.join(purchases, F.expr("user_id = right_user_id AND cell = right_cell AND purchase_ts >= signup_ts AND purchase_ts <= signup_ts + interval 6 hours"),
                            "left").select("user_id", "signup_id", "purchase_id", "signup_ts")

    arriving = roles.arriving_events(spark, folder)
    out = runner.replay(arriving.rows.select("ts", "user_id", "event_id", "event_type"), "ts", plan, "left-join", feed=arriving.parts)
    return out.filter(runner.before_end("signup_ts")).select("user_id", "signup_id", "purchase_id")


@query("union_distinct_stream", """
SELECT event_id, user_id, event_type FROM events WHERE value < 50 UNION
SELECT event_id, user_id, event_type FROM events WHERE event_type = 'purchase'""")
def union_distinct_stream(spark, folder):
    """Two inputs in one; a row that comes by both is kept once, and is forgotten when the watermark has passed it."""
    arriving = roles.arriving_events(spark, folder)
    columns = ["ts", "event_id", "user_id", "event_type"]
    cheap, bought = arriving.rows.filter("value < 50").select(*columns), arriving.rows.filter(is_type("purchase")).select(*columns)
    out = runner.replay(cheap.unionByName(bought), "ts", lambda df: windows.distinct_rows(df, ["event_id"], "ts", LATEST).select(*columns),
                        "union", feed=arriving.parts)
    return out.filter(runner.before_end("ts")).select("event_id", "user_id", "event_type")


@query("upsert_stream", """
SELECT user_id AS id, value AS vc, event_id AS seq
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back FROM events) WHERE back = 1""")
def upsert_stream(spark, folder):
    """A store of the latest reading of every sensor, written by a stream of four micro-batches with disorder."""
    arriving = roles.arriving_events(spark, folder)
    readings = roles.sensor(arriving.rows).select("id", "vc", "ts", "seq")
    store = runner.new_folder(spark, "store")
    checkpoint = runner.new_folder(spark, "store-checkpoint")
    for bring in arriving.parts:
        bring()
        sinks.upsert_stream(readings, store, checkpoint, ["id"], ["ts", "seq"]).awaitTermination()
    return sinks.read_store(spark, store).select("id", "vc", "seq")
