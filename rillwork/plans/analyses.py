"""Queries for joins, aggregates, windows, top-n, patterns, lateness and the guards."""

from __future__ import annotations

from uuid import uuid4

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from rillwork.functions import scalar as sc
from rillwork.operators import aggregate, basic, guards, joins, lateness, patterns, windows
from rillwork.plans.basics import SENSOR_SQL, sensor
from rillwork.plans.registry import query
from rillwork.session import shared_folder
from rillwork.sources import roles
from rillwork.sources.files import read_lines

ITEM_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
HOUR = 3600
DAY = 24 * HOUR
ORDER = ["ts", "event_id"]


def events(spark: SparkSession, folder: str) -> DataFrame:
    return roles.events(spark, folder)


def is_type(event_type: str):
    return F.col("event_type") == event_type


# --- joins -----------------------------------------------------------------------------------

@query("reconcile_match", """
SELECT o_orderkey AS tx_id, o_orderdate AS ordered, received
FROM orders JOIN (SELECT l_orderkey, min(l_shipdate) AS received FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def reconcile_match(spark, folder):
    orders = roles.table(spark, folder, "orders").select(F.col("o_orderkey").alias("tx_id"),
                                                         F.col("o_orderdate").alias("ordered"))
    receipts = roles.table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("tx_id"),
                                                             F.col("l_shipdate").alias("received"))
    return joins.reconcile(orders, receipts, "tx_id", "ordered", "received")


@query("interval_join", """
SELECT s.user_id, s.event_id AS signup_id, p.event_id AS purchase_id, s.ts AS signup_ts, p.ts AS purchase_ts
FROM events s JOIN events p ON s.user_id = p.user_id AND s.event_type = 'signup' AND p.event_type = 'purchase'
AND p.ts BETWEEN s.ts - INTERVAL 1 HOUR AND s.ts + INTERVAL 1 HOUR""")
def interval_join(spark, folder):
    rows = events(spark, folder)

    def side(event_type: str) -> DataFrame:
        return rows.filter(is_type(event_type)).select(
            "user_id", F.col("event_id").alias(f"{event_type}_id"), F.col("ts").alias(f"{event_type}_ts"))

    return joins.interval_join(side("signup"), side("purchase"), ["user_id"], "signup_ts", "purchase_ts", -HOUR, HOUR)


@query("left_join", """
SELECT o_orderkey, o_orderstatus, l_linenumber, l_quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def left_join(spark, folder):
    orders = roles.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    lines = roles.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").drop("l_orderkey")


@query("inner_join", """
SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def inner_join(spark, folder):
    customer, nation = roles.table(spark, folder, "customer"), roles.table(spark, folder, "nation")
    return (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
            .select("c_custkey", "c_name", "n_name"))


@query("semi_join_in", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def semi_join_in(spark, folder):
    customer = roles.table(spark, folder, "customer").select("c_custkey", "c_name")
    finished = roles.table(spark, folder, "orders").filter("o_orderstatus = 'F'").select("o_custkey")
    return customer.join(finished, F.col("c_custkey") == F.col("o_custkey"), "left_semi")


# --- totals and running aggregates -----------------------------------------------------------

@query("word_count", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def word_count(spark, folder):
    return aggregate.counts(basic.words(roles.table(spark, folder, "documents"), "text"), "word")


RUNNING = "OVER (PARTITION BY id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)"


LINE_WORDS_SQL = r"""
SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '[ \r\n]')) AS word FROM documents)
WHERE word <> '' GROUP BY word"""


def document_lines(spark: SparkSession, folder: str) -> str:
    """A folder of text files with the lines of all documents; the files grow in number with the lines and not in size."""
    target = f"{shared_folder(spark)}/lines-{uuid4().hex}"
    roles.table(spark, folder, "documents").select("text").filter("text IS NOT NULL").hint("rebalance").write.text(target)
    return target


@query("word_count_text", LINE_WORDS_SQL)
def word_count_text(spark, folder):
    """Words of text files, read as text."""
    return aggregate.counts(basic.words(read_lines(spark, document_lines(spark, folder))), "word")


@query("rolling_sum", f"""
SELECT seq, id, CAST(sum(CAST(vc AS DECIMAL(18,2))) {RUNNING} AS DOUBLE) AS total FROM ({SENSOR_SQL})""")
def rolling_sum(spark, folder):
    return (aggregate.running_sum(sensor(spark, folder), ["id"], ["ts", "seq"], "vc", "total")
            .select("seq", "id", "total"))


@query("rolling_min", f"SELECT seq, id, min(vc) {RUNNING} AS low FROM ({SENSOR_SQL})")
def rolling_min(spark, folder):
    return (aggregate.running_extreme(sensor(spark, folder), ["id"], ["ts", "seq"], "vc", "min", "low")
            .select("seq", "id", "low"))


@query("rolling_max", f"""
SELECT seq, id, max(vc) {RUNNING} AS high, first_value(ts) {RUNNING} AS first_ts FROM ({SENSOR_SQL})""")
def rolling_max(spark, folder):
    return (aggregate.running_extreme(sensor(spark, folder), ["id"], ["ts", "seq"], "vc", "max", "high", ["ts"])
            .select("seq", "id", "high", "first_ts"))


@query("keyed_reduce", f"""
SELECT seq, id, first_value(ts) {RUNNING} AS since, ts,
       CAST(sum(CAST(vc AS DECIMAL(18,2))) {RUNNING} AS DOUBLE) AS vc
FROM ({SENSOR_SQL})""")
def keyed_reduce(spark, folder):
    from rillwork.operators.ordered import Running, running
    out = running(sensor(spark, folder), ["id"], ["ts", "seq"],
                  {"since": Running("first", F.col("ts")), "sum": Running("sum", sc.money(F.col("vc")))})
    return out.select("seq", "id", "since", "ts", F.col("sum").cast("double").alias("vc"))


@query("group_count", "SELECT user_id AS id, count(value) AS cnt FROM events GROUP BY user_id")
def group_count(spark, folder):
    return aggregate.count_of(sensor(spark, folder), ["id"], "vc", "cnt")


@query("running_count", f"SELECT seq, id, count(*) {RUNNING} AS n FROM ({SENSOR_SQL})")
def running_count(spark, folder):
    return aggregate.running_count(sensor(spark, folder), ["id"], ["ts", "seq"]).select("seq", "id", "n")


@query("pv_total", "SELECT count(*) AS pv FROM events WHERE event_type = 'view'")
def pv_total(spark, folder):
    return aggregate.total(events(spark, folder).filter(is_type("view")), "pv")


@query("uv_total", "SELECT count(DISTINCT user_id) AS uv FROM events WHERE event_type = 'view'")
def uv_total(spark, folder):
    return aggregate.distinct_total(events(spark, folder).filter(is_type("view")), "user_id", "uv")


@query("uv_running", """
SELECT event_id, ts, sum(CASE WHEN nth = 1 THEN 1 ELSE 0 END) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
       ::BIGINT AS uv
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM events
      WHERE event_type = 'view')""")
def uv_running(spark, folder):
    views = events(spark, folder).filter(is_type("view")).select("event_id", "ts", "user_id")
    return aggregate.running_distinct(views, ORDER, "user_id").select("event_id", "ts", "uv")


@query("uv_approx")
def uv_approx(spark, folder):
    return windows.approx_distinct_counts(events(spark, folder).filter(is_type("view")), "ts", "1 hour",
                                          F.col("user_id"))


MARKETING_SQL = "SELECT event_type AS behavior, 'ch' || CAST(user_id % 4 AS VARCHAR) AS channel FROM events"


@query("channel_downloads", f"""
SELECT channel, count(*) AS n FROM ({MARKETING_SQL}) WHERE behavior = 'signup' GROUP BY 1""")
def channel_downloads(spark, folder):
    return aggregate.counts(roles.marketing(events(spark, folder)).filter("behavior = 'signup'"), "channel")


@query("channel_behavior_counts", f"SELECT channel, behavior, count(*) AS n FROM ({MARKETING_SQL}) GROUP BY 1, 2")
def channel_behavior_counts(spark, folder):
    return aggregate.counts(roles.marketing(events(spark, folder)), "channel", "behavior")


@query("behavior_counts", f"SELECT behavior, count(*) AS n FROM ({MARKETING_SQL}) GROUP BY 1")
def behavior_counts(spark, folder):
    return aggregate.counts(roles.marketing(events(spark, folder)), "behavior")


CLICKS_SQL = f"""
SELECT event_id, ts, user_id, {ITEM_SQL} % 20 AS ad_id, r_name AS province
FROM events JOIN region ON r_regionkey = user_id % 5 WHERE event_type = 'click'"""


def ad_clicks(spark: SparkSession, folder: str) -> DataFrame:
    return roles.ad_clicks(events(spark, folder), roles.table(spark, folder, "region"))


@query("province_ad_clicks", f"SELECT province, ad_id, count(*) AS n FROM ({CLICKS_SQL}) GROUP BY 1, 2")
def province_ad_clicks(spark, folder):
    return aggregate.counts(ad_clicks(spark, folder), "province", "ad_id")


RETRACT_SQL = """
SELECT event_type, ts, event_id, add, CASE WHEN add THEN n ELSE n - 1 END AS n
FROM (SELECT *, count(*) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM events),
     (VALUES (true), (false)) c(add) WHERE add OR n > 1"""


@query("retract_changelog", RETRACT_SQL)
def retract_changelog(spark, folder):
    return aggregate.changelog(events(spark, folder).select("event_type", "ts", "event_id"), ["event_type"], ORDER)


# --- windows ---------------------------------------------------------------------------------

HOURS = "time_bucket(INTERVAL '1 hour', ts)"
MONEY = "CAST(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS DOUBLE)"


@query("tumbling_window", f"""
SELECT event_type, {HOURS} AS window_start, {HOURS} + INTERVAL '1 hour' AS window_end, count(*) AS n
FROM events GROUP BY 1, 2, 3""")
def tumbling_window(spark, folder):
    return windows.tumbling(events(spark, folder), ["event_type"], "ts", "1 hour", n=F.count(F.lit(1)))


@query("odd_sliding_counts", """
SELECT * FROM (SELECT event_type, time_bucket(INTERVAL '20 minutes', ts) - to_minutes(20 * i) AS window_start,
       time_bucket(INTERVAL '20 minutes', ts) - to_minutes(20 * i) + INTERVAL '50 minutes' AS window_end, count(*) AS n
FROM events, range(3) r(i) WHERE time_bucket(INTERVAL '20 minutes', ts) - to_minutes(20 * i) + INTERVAL '50 minutes' > ts GROUP BY 1, 2, 3)""")
def odd_sliding_counts(spark, folder):
    """A window that is no multiple of its slide, from panes of ten minutes."""
    return windows.sliding_counts(events(spark, folder), ["event_type"], "ts", "50 minutes", "20 minutes")


@query("window_user_accumulator", f"""
SELECT event_type, {HOURS} AS window_start, {HOURS} + INTERVAL '1 hour' AS window_end,
       CAST(max(CAST(round(value * 100) AS BIGINT)) - min(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS spread
FROM events GROUP BY 1, 2, 3""")
def window_user_accumulator(spark, folder):
    """A user's own aggregate in a window."""
    @F.pandas_udf("long")
    def spread(cents: pd.Series) -> int | None:
        known = cents.dropna()
        return int(known.max() - known.min()) if len(known) else None

    rows = events(spark, folder).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    return windows.tumbling(rows, ["event_type"], "ts", "1 hour", spread=spread("cents"))


@query("window_user_process", f"""
SELECT event_type, {HOURS} AS window_start, {HOURS} + INTERVAL '1 hour' AS window_end, arg_min(event_id, struct_pack(a := ts, b := event_id)) AS first_id,
       arg_max(event_id, struct_pack(a := ts, b := event_id)) AS last_id
FROM events GROUP BY 1, 2, 3""")
def window_user_process(spark, folder):
    """A user's own function over all rows of a window."""
    def ends(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["ts", "event_id"])
        first, last = rows.iloc[0], rows.iloc[-1]
        return pd.DataFrame([(first["event_type"], first["window_start"], first["window_end"], first["event_id"], last["event_id"])],
                            columns=["event_type", "window_start", "window_end", "first_id", "last_id"])

    rows = events(spark, folder).select("event_id", "event_type", "ts")
    return windows.process(rows, ["event_type"], "ts", "1 hour", ends,
                           "event_type string, window_start timestamp_ntz, window_end timestamp_ntz, first_id long, last_id long")


@query("sliding_window", """
SELECT event_type, time_bucket(INTERVAL '5 minutes', ts) - to_minutes(5 * i) AS window_start,
       time_bucket(INTERVAL '5 minutes', ts) - to_minutes(5 * i) + INTERVAL '1 hour' AS window_end, count(*) AS n
FROM events, range(12) r(i) GROUP BY 1, 2, 3""")
def sliding_window(spark, folder):
    return windows.sliding_counts(events(spark, folder), ["event_type"], "ts", "1 hour", "5 minutes")


@query("session_window", """
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL '3 hours' AS window_end, count(*) AS n
FROM (SELECT *, sum(CASE WHEN ts <= prev + INTERVAL '3 hours' THEN 0 ELSE 1 END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid
      FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events))
GROUP BY user_id, sid""")
def session_window(spark, folder):
    rows = events(spark, folder).select("user_id", "ts", "event_id")
    return windows.session(rows, ["user_id"], "ts", "event_id", "3 hours", n=F.count(F.lit(1)))


@query("processing_time_window", """
SELECT time_bucket(INTERVAL '1 hour', arrival) AS window_start,
       time_bucket(INTERVAL '1 hour', arrival) + INTERVAL '1 hour' AS window_end, count(*) AS n
FROM (SELECT ts + to_seconds((event_id * 7919) % 3600) AS arrival FROM events) GROUP BY 1, 2""")
def processing_time_window(spark, folder):
    return windows.tumbling(roles.in_arrival_order(events(spark, folder)), [], "arrival", "1 hour",
                            n=F.count(F.lit(1)))


@query("count_window_tumbling", """
SELECT user_id, (rn - 1) // 3 AS window_no, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, max(ts) AS last_ts
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
GROUP BY 1, 2 HAVING count(*) = 3""")
def count_window_tumbling(spark, folder):
    rows = events(spark, folder).select("user_id", "ts", "event_id", "value")
    return windows.count_tumbling(rows, ["user_id"], ORDER, 3, total=F.sum(sc.money(F.col("value"))).cast("double"),
                                  last_ts=F.max("ts"))


COUNT_SLIDE_SQL = """
SELECT user_id, rn AS fired_at_row, n, total FROM (
  SELECT user_id, row_number() OVER w AS rn,
         count(*) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n,
         CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) AS total
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE rn % 2 = 0"""


@query("count_window_sliding", COUNT_SLIDE_SQL)
def count_window_sliding(spark, folder):
    rows = events(spark, folder).select("user_id", "ts", "event_id", "value")
    fired = windows.count_sliding(rows, ["user_id"], ORDER, 3, 2, F.struct(sc.money(F.col("value")).alias("v")))
    add = F.aggregate("values", F.lit(0).cast("decimal(28,2)"), lambda s, x: (s + x["v"]).cast("decimal(28,2)"))
    return fired.select("user_id", "fired_at_row", F.size("values").cast("long").alias("n"),
                        add.cast("double").alias("total"))


@query("window_all", f"""
SELECT {HOURS} AS window_start, {HOURS} + INTERVAL '1 hour' AS window_end, count(*) AS n FROM events GROUP BY 1, 2""")
def window_all(spark, folder):
    return windows.tumbling(events(spark, folder), [], "ts", "1 hour", n=F.count(F.lit(1)))


@query("window_reduce", f"""
SELECT user_id, {HOURS} AS window_start, {HOURS} + INTERVAL '1 hour' AS window_end, {MONEY} AS total
FROM events GROUP BY 1, 2, 3""")
def window_reduce(spark, folder):
    return windows.tumbling(events(spark, folder), ["user_id"], "ts", "1 hour",
                            total=F.sum(sc.money(F.col("value"))).cast("double"))


@query("window_aggregate", f"""
SELECT event_type, {HOURS} AS window_start, {HOURS} + INTERVAL '1 hour' AS window_end, count(*) AS n,
       {MONEY} / count(*) AS mean
FROM events GROUP BY 1, 2, 3""")
def window_aggregate(spark, folder):
    out = windows.tumbling(events(spark, folder), ["event_type"], "ts", "1 hour", n=F.count(F.lit(1)),
                           total=F.sum(sc.money(F.col("value"))).cast("double"))
    return out.withColumn("mean", F.col("total") / F.col("n")).drop("total")


@query("window_process", f"""
SELECT event_type, {HOURS} AS window_start, {HOURS} + INTERVAL '1 hour' AS window_end, count(*) AS n,
       min(value) AS low, max(value) AS high
FROM events GROUP BY 1, 2, 3""")
def window_process(spark, folder):
    return windows.tumbling(events(spark, folder), ["event_type"], "ts", "1 hour", n=F.count(F.lit(1)),
                            low=F.min("value"), high=F.max("value"))


def slots_sql(rows: str, keys: str, size: int, slide: int) -> str:
    """Row counts per key and sliding window end, for the checking engine."""
    return f"""
SELECT time_bucket(INTERVAL '{slide} minutes', ts) + to_minutes({slide} * (i + 1)) AS window_end, {keys},
       count(*) AS clicks
FROM ({rows}), range({size // slide}) r(i) GROUP BY ALL"""


VIEWS_SQL = f"SELECT event_id, ts, user_id, {ITEM_SQL} AS item_id FROM events WHERE event_type = 'view'"


def views(spark: SparkSession, folder: str) -> DataFrame:
    return roles.views_of_items(events(spark, folder))


@query("window_agg_with_end", slots_sql(VIEWS_SQL, "item_id", 60, 5))
def window_agg_with_end(spark, folder):
    return (windows.sliding_counts(views(spark, folder), ["item_id"], "ts", "1 hour", "5 minutes", "clicks")
            .select("window_end", "item_id", "clicks"))


@query("pv_hourly", f"""
SELECT {HOURS} AS window_start, {HOURS} + INTERVAL '1 hour' AS window_end, count(*) AS pv
FROM events WHERE event_type = 'view' GROUP BY 1, 2""")
def pv_hourly(spark, folder):
    return windows.tumbling(events(spark, folder).filter(is_type("view")), [], "ts", "1 hour", pv=F.count(F.lit(1)))


@query("uv_hourly", f"""
SELECT {HOURS} AS window_start, {HOURS} + INTERVAL '1 hour' AS window_end, count(DISTINCT user_id) AS uv
FROM events WHERE event_type = 'view' GROUP BY 1, 2""")
def uv_hourly(spark, folder):
    return windows.distinct_counts(events(spark, folder).filter(is_type("view")), "ts", "1 hour", F.col("user_id"))


SLOT_SQL = """list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
       lambda h, x: (h * 61 + x) & 1073741823, CAST(0 AS BIGINT))"""


@query("uv_bitmap", f"""
SELECT {HOURS} AS window_start, {HOURS} + INTERVAL '1 hour' AS window_end, count(DISTINCT {SLOT_SQL}) AS uv
FROM events GROUP BY 1, 2""")
def uv_bitmap(spark, folder):
    return windows.distinct_counts(events(spark, folder), "ts", "1 hour",
                                   sc.poly_hash(F.col("user_id").cast("string")))


@query("uv_bitmap_sliding", f"""
SELECT time_bucket(INTERVAL '5 minutes', ts) - to_minutes(5 * i) AS window_start,
       time_bucket(INTERVAL '5 minutes', ts) - to_minutes(5 * i) + INTERVAL '1 hour' AS window_end,
       count(DISTINCT {SLOT_SQL}) AS uv
FROM events, range(12) r(i) WHERE event_type = 'view' GROUP BY 1, 2""")
def uv_bitmap_sliding(spark, folder):
    return windows.sliding_distinct_counts(events(spark, folder).filter(is_type("view")), "ts", "1 hour", "5 minutes",
                                           sc.poly_hash(F.col("user_id").cast("string")))


@query("window_per_element_fire", f"""
SELECT window_start, ts, event_id,
       sum(CASE WHEN nth = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY window_start ORDER BY ts, event_id
                                                      ROWS UNBOUNDED PRECEDING)::BIGINT AS uv
FROM (SELECT *, row_number() OVER (PARTITION BY window_start, slot ORDER BY ts, event_id) AS nth
      FROM (SELECT {HOURS} AS window_start, ts, event_id, {SLOT_SQL} AS slot FROM events))""")
def window_per_element_fire(spark, folder):
    rows = events(spark, folder).select("ts", "event_id", "user_id")
    return windows.distinct_counts_per_row(rows, "ts", "event_id", "1 hour",
                                           sc.poly_hash(F.col("user_id").cast("string")))


@query("table_tumble", """
SELECT user_id AS id, time_bucket(INTERVAL '5 minutes', ts) AS window_start, count(*) AS n FROM events GROUP BY 1, 2""")
def table_tumble(spark, folder):
    sensor(spark, folder).createOrReplaceTempView("sensor_tumble")
    return spark.sql("""
        SELECT id, window.start AS window_start, count(*) AS n FROM sensor_tumble
        GROUP BY id, window(ts, '5 minutes')""")


@query("table_slide", slots_sql(VIEWS_SQL, "item_id", 60, 5))
def table_slide(spark, folder):
    views(spark, folder).createOrReplaceTempView("views_slide")
    # Counted in 5-minute panes first, then spread over the hour windows.
    return spark.sql("""
        SELECT item_id, window.end AS window_end, sum(n) AS clicks
        FROM (SELECT item_id, window.start AS pane, count(*) AS n FROM views_slide
              GROUP BY item_id, window(ts, '5 minutes'))
        GROUP BY item_id, window(pane, '1 hour', '5 minutes')""")


# --- top-n -----------------------------------------------------------------------------------

def top3_sql(counts: str, keys: str) -> str:
    return f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY clicks DESC, {keys}) AS rank
               FROM ({counts})) WHERE rank <= 3"""


@query("hot_items", top3_sql(slots_sql(VIEWS_SQL, "item_id", 60, 5), "item_id"))
def hot_items(spark, folder):
    return windows.hottest(views(spark, folder), ["item_id"], "ts", "1 hour", "5 minutes")


HOT_PAGES_SQL = top3_sql(slots_sql(f"""
SELECT e.ts, p.url FROM (SELECT ts, {ITEM_SQL} % (SELECT count(*) FROM pages) AS page_id FROM events) e
JOIN pages p USING (page_id)""", "url", 60, 10), "url")


@query("hot_pages", HOT_PAGES_SQL)
def hot_pages(spark, folder):
    from rillwork.sources.files import parse_web_log
    lines = roles.web_log_lines(events(spark, folder), roles.table(spark, folder, "pages"))
    return windows.hottest(parse_web_log(lines), ["url"], "ts", "1 hour", "10 minutes")


@query("hot_ads", top3_sql(slots_sql(CLICKS_SQL, "province, ad_id", 60, 10), "province, ad_id"))
def hot_ads(spark, folder):
    return windows.hottest(ad_clicks(spark, folder), ["province", "ad_id"], "ts", "1 hour", "10 minutes")


@query("row_number_topn", top3_sql(slots_sql(VIEWS_SQL, "item_id", 60, 5), "item_id"))
def row_number_topn(spark, folder):
    table_slide(spark, folder).createOrReplaceTempView("item_counts")
    return spark.sql("""
        SELECT window_end, item_id, clicks, CAST(rank AS BIGINT) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY clicks DESC, item_id) AS rank
              FROM item_counts)
        WHERE rank <= 3""")


# --- lateness --------------------------------------------------------------------------------

ARRIVED_SQL = """
SELECT *, max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
          - INTERVAL '3 minutes' AS watermark,
       time_bucket(INTERVAL '5 minutes', ts) AS window_start,
       time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end
FROM (SELECT event_id, ts, ts + to_seconds((event_id * 7919) % 3600) AS arrival FROM events)"""

STATUS_SQL = f"""
SELECT *, CASE WHEN watermark >= window_end + INTERVAL '2 minutes' THEN 'late'
               WHEN watermark >= window_end THEN 'refire' ELSE 'on_time' END AS status
FROM ({ARRIVED_SQL})"""


def arrived(spark: SparkSession, folder: str) -> DataFrame:
    return roles.in_arrival_order(events(spark, folder)).select("event_id", "ts", "arrival")


@query("watermark_running", """
SELECT event_id, max(ts) OVER (ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) - INTERVAL '3 minutes' AS watermark
FROM (SELECT event_id, ts, ts + to_seconds((event_id * 7919) % 3600) AS arrival FROM events)""")
def watermark_running(spark, folder):
    return (lateness.watermark_seen(arrived(spark, folder), ["arrival", "event_id"], "ts", 180, include_row=True)
            .select("event_id", "watermark"))


@query("allowed_lateness", f"""
WITH s AS (SELECT * FROM ({STATUS_SQL}) WHERE status <> 'late')
SELECT window_start, CAST(NULL AS BIGINT) AS refired_by, count(*) AS n FROM s WHERE status = 'on_time' GROUP BY 1
UNION ALL SELECT window_start, event_id, n FROM (
  SELECT *, count(*) OVER (PARTITION BY window_start ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) AS n FROM s)
WHERE status = 'refire'""")
def allowed_lateness(spark, folder):
    return lateness.firings(arrived(spark, folder), ["arrival", "event_id"], "ts", "5 minutes", 180, 120)


@query("late_side_output", f"SELECT event_id, window_start, watermark FROM ({STATUS_SQL}) WHERE status = 'late'")
def late_side_output(spark, folder):
    rows = lateness.classify(arrived(spark, folder), ["arrival", "event_id"], "ts", "5 minutes", 180, 120)
    return rows.filter(F.col("status") == lateness.LATE).select("event_id", "window_start", "watermark")


# --- guards ----------------------------------------------------------------------------------

# Clicks of a user on an ad that pass in a day; small, as these tables repeat few of them.
CLICK_LIMIT = 1
NTH_SQL = f"""
SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, date_trunc('day', ts) ORDER BY ts, event_id) AS nth
FROM (SELECT event_id, ts, user_id, ad_id FROM ({CLICKS_SQL}))"""
USER_AND_AD = ["user_id", "ad_id"]


def clicks_of_users(spark: SparkSession, folder: str) -> DataFrame:
    return ad_clicks(spark, folder).select("event_id", "ts", *USER_AND_AD)


@query("blacklist_filter", f"SELECT event_id, ts, user_id, ad_id FROM ({NTH_SQL}) WHERE nth <= {CLICK_LIMIT}")
def blacklist_filter(spark, folder):
    return guards.below_daily_limit(clicks_of_users(spark, folder), USER_AND_AD, "ts", ORDER, CLICK_LIMIT)


@query("blacklist_alarms", f"SELECT event_id, ts, user_id, ad_id FROM ({NTH_SQL}) WHERE nth = {CLICK_LIMIT} + 1")
def blacklist_alarms(spark, folder):
    return guards.limit_alarms(clicks_of_users(spark, folder), USER_AND_AD, "ts", ORDER, CLICK_LIMIT)


@query("clicks_after_blacklist",
       slots_sql(f"SELECT ts, user_id, ad_id FROM ({NTH_SQL}) WHERE nth <= {CLICK_LIMIT}", "user_id, ad_id", 60, 5))
def clicks_after_blacklist(spark, folder):
    kept = guards.below_daily_limit(clicks_of_users(spark, folder), USER_AND_AD, "ts", ORDER, CLICK_LIMIT)
    return (windows.sliding_counts(kept, USER_AND_AD, "ts", "1 hour", "5 minutes", "clicks")
            .select("window_end", *USER_AND_AD, "clicks"))


FIRST_FAILURE_SQL = """
SELECT user_id, event_id, ts, first_ts FROM (
  SELECT *, first_value(ts) OVER w AS first_ts, row_number() OVER w AS nth FROM events WHERE event_type = 'error'
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE nth > 1 AND ts <= first_ts + INTERVAL 2 DAY"""


@query("login_fail_state", FIRST_FAILURE_SQL)
def login_fail_state(spark, folder):
    fails = roles.logins(events(spark, folder)).filter("failed").select("user_id", "event_id", "ts")
    return guards.repeated_failures(fails, ["user_id"], "ts", ORDER, 2 * DAY)


PAYMENT_SQL = """
SELECT coalesce(o_orderkey, l_orderkey) AS order_id, o_orderdate AS created, shipped AS paid,
       CASE WHEN o_orderkey IS NULL THEN 'missing_create' WHEN shipped IS NULL THEN 'timeout'
            WHEN shipped > o_orderdate + INTERVAL 90 DAY THEN 'late' ELSE 'paid' END AS status
FROM orders FULL JOIN (SELECT l_orderkey, min(l_shipdate) AS shipped FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey"""


def order_events(spark: SparkSession, folder: str) -> DataFrame:
    return roles.order_events(roles.table(spark, folder, "orders"), roles.table(spark, folder, "lineitem"))


@query("order_timeout_status", PAYMENT_SQL)
def order_timeout_status(spark, folder):
    return guards.payment_status(order_events(spark, folder), "order_id", "kind", "ts", 90 * DAY)


RISING_SQL = f"""
WITH RECURSIVE r AS (
  SELECT seq, ts, id, vc, vc < coalesce(lag(vc) OVER w, 0.0) AS fell, row_number() OVER w AS rn
  FROM ({SENSOR_SQL}) WINDOW w AS (PARTITION BY id ORDER BY ts, seq)),
walk AS (
  SELECT id, rn, CASE WHEN fell THEN NULL ELSE ts + INTERVAL 12 HOUR END AS due, CAST(NULL AS TIMESTAMP) AS alarm_at
  FROM r WHERE rn = 1
  UNION ALL
  SELECT r.id, r.rn,
         CASE WHEN fell THEN NULL WHEN due IS NULL OR due < r.ts THEN r.ts + INTERVAL 12 HOUR ELSE due END,
         CASE WHEN due < r.ts THEN due END
  FROM walk JOIN r ON r.id = walk.id AND r.rn = walk.rn + 1)
SELECT id, alarm_at FROM walk WHERE alarm_at IS NOT NULL
UNION ALL
SELECT walk.id, due FROM walk JOIN (SELECT id, max(rn) AS rn FROM r GROUP BY id) l ON l.id = walk.id AND l.rn = walk.rn
WHERE due IS NOT NULL"""


@query("rising_alarm", RISING_SQL)
def rising_alarm(spark, folder):
    return guards.rising_alarms(sensor(spark, folder), ["id"], "ts", "seq", "vc", 12 * HOUR)


# --- patterns --------------------------------------------------------------------------------

@query("pattern_begin_where", "SELECT event_id FROM events WHERE event_type = 'view' AND value > 50")
def pattern_begin_where(spark, folder):
    return patterns.begin(events(spark, folder), is_type("view"), F.col("value") > 50).select("event_id")


@query("pattern_or", "SELECT event_id FROM events WHERE event_type = 'view' OR value > 50")
def pattern_or(spark, folder):
    return patterns.either(events(spark, folder), is_type("view"), F.col("value") > 50).select("event_id")


NEXT_SQL = """
SELECT * FROM (
  SELECT user_id, event_type, event_id AS first_id, ts AS first_ts, lead(event_id) OVER w AS second_id,
         lead(ts) OVER w AS second_ts, lead(event_type) OVER w AS second_type
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""
PAIR = ["event_id", "ts"]
PAIR_COLUMNS = ["user_id", "first.event_id AS first_id", "second.event_id AS second_id"]


def typed(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark, folder).select("user_id", "ts", "event_id", "event_type")


@query("pattern_next", f"""
SELECT user_id, first_id, second_id FROM ({NEXT_SQL}) WHERE event_type = 'signup' AND second_type = 'purchase'""")
def pattern_next(spark, folder):
    return patterns.next_row(typed(spark, folder), ["user_id"], ORDER, is_type("signup"), is_type("purchase"),
                             PAIR).selectExpr(*PAIR_COLUMNS)


@query("login_fail_pattern", f"""
SELECT user_id, first_id, second_id, first_ts, second_ts FROM ({NEXT_SQL})
WHERE event_type = 'error' AND second_type = 'error' AND second_ts < first_ts + INTERVAL 6 HOUR""")
def login_fail_pattern(spark, folder):
    found = patterns.next_row(typed(spark, folder), ["user_id"], ORDER, is_type("error"), is_type("error"), PAIR,
                              6 * HOUR)
    return found.selectExpr(*PAIR_COLUMNS, "first.ts AS first_ts", "second.ts AS second_ts")


def follow_sql(columns: str, where: str) -> str:
    return f"""
SELECT {columns} FROM (SELECT * FROM events WHERE event_type = 'signup') s LEFT JOIN LATERAL (
  SELECT event_id AS second_id, ts AS second_ts FROM events p
  WHERE p.user_id = s.user_id AND p.event_type = 'purchase' AND (p.ts, p.event_id) > (s.ts, s.event_id)
  ORDER BY p.ts, p.event_id LIMIT 1) ON true WHERE {where}"""


IN_TIME = "second_ts < s.ts + INTERVAL 12 HOUR"


@query("pattern_followed_by", follow_sql("user_id, event_id AS first_id, second_id", "second_id IS NOT NULL"))
def pattern_followed_by(spark, folder):
    return patterns.followed_by(typed(spark, folder), ["user_id"], ORDER, is_type("signup"), is_type("purchase"),
                                PAIR).selectExpr(*PAIR_COLUMNS)


def signup_to_purchase(spark: SparkSession, folder: str) -> DataFrame:
    return patterns.followed_by(typed(spark, folder), ["user_id"], ORDER, is_type("signup"), is_type("purchase"),
                                PAIR, 12 * HOUR)


@query("pattern_within", follow_sql("user_id, event_id AS first_id, second_id", IN_TIME))
def pattern_within(spark, folder):
    return signup_to_purchase(spark, folder).selectExpr(*PAIR_COLUMNS)


@query("pattern_select", follow_sql(
    "user_id, ts AS signup_at, second_ts AS purchase_at, epoch_us(second_ts) - epoch_us(ts) AS elapsed_us", IN_TIME))
def pattern_select(spark, folder):
    return signup_to_purchase(spark, folder).select(
        "user_id", F.col("first.ts").alias("signup_at"), F.col("second.ts").alias("purchase_at"),
        (sc.epoch_micros(F.col("second.ts")) - sc.epoch_micros(F.col("first.ts"))).alias("elapsed_us"))


@query("pattern_timeout_side", follow_sql(
    "user_id, event_id AS first_id, ts AS first_ts", f"second_id IS NULL OR NOT ({IN_TIME})"))
def pattern_timeout_side(spark, folder):
    missed = patterns.timed_out(typed(spark, folder), ["user_id"], ORDER, is_type("signup"), is_type("purchase"),
                                PAIR, 12 * HOUR)
    return missed.select("user_id", F.col("first.event_id").alias("first_id"), F.col("first.ts").alias("first_ts"))


@query("pattern_followed_by_any", """
SELECT s.user_id, s.event_id AS first_id, p.event_id AS second_id FROM events s JOIN events p
ON s.user_id = p.user_id AND s.event_type = 'signup' AND p.event_type = 'purchase'
AND (p.ts, p.event_id) > (s.ts, s.event_id) AND p.ts < s.ts + INTERVAL 12 HOUR""")
def pattern_followed_by_any(spark, folder):
    return patterns.followed_by_any(typed(spark, folder), ["user_id"], ORDER, is_type("signup"),
                                    is_type("purchase"), PAIR, 12 * HOUR).selectExpr(*PAIR_COLUMNS)


@query("pattern_times", """
SELECT * FROM (SELECT user_id, event_id AS first_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id)
               AS last_id FROM events WHERE event_type = 'error') WHERE last_id IS NOT NULL""")
def pattern_times(spark, folder):
    found = patterns.times(typed(spark, folder), ["user_id"], ORDER, is_type("error"), PAIR, 2)
    return found.select("user_id", F.col("first.event_id").alias("first_id"), F.col("last.event_id").alias("last_id"))


@query("pattern_times_range", """
SELECT user_id, CAST(times AS INTEGER) AS times, first_id, last_id FROM (
  SELECT user_id, event_id AS first_id, unnest([2, 3]) AS times, unnest([lead(event_id, 1) OVER w, lead(event_id, 2) OVER w])
         AS last_id
  FROM events WHERE event_type = 'error' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE last_id IS NOT NULL""")
def pattern_times_range(spark, folder):
    found = patterns.times_range(typed(spark, folder), ["user_id"], ORDER, is_type("error"), PAIR, 2, 3)
    return found.select("user_id", "times", F.col("first.event_id").alias("first_id"),
                        F.col("last.event_id").alias("last_id"))


@query("order_paid_pattern", """
SELECT o_orderkey AS order_id, o_orderdate AS created, min(l_shipdate) AS paid,
       CAST(epoch(min(l_shipdate)) - epoch(o_orderdate) AS BIGINT) AS elapsed_s
FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate > o_orderdate
GROUP BY 1, 2 HAVING min(l_shipdate) < o_orderdate + INTERVAL 90 DAY""")
def order_paid_pattern(spark, folder):
    # At equal times the creation sorts last, so a payment must be strictly later.
    rows = order_events(spark, folder).withColumn("seq", F.when(F.col("kind") == "create", 1).otherwise(0))
    found = patterns.followed_by(rows, ["order_id"], ["ts", "seq"], F.col("kind") == "create", F.col("kind") == "pay",
                                 ["ts"], 90 * DAY)
    return found.select(
        "order_id", F.col("first.ts").alias("created"), F.col("second.ts").alias("paid"),
        (sc.epoch_seconds(F.col("second.ts")) - sc.epoch_seconds(F.col("first.ts"))).alias("elapsed_s"))
