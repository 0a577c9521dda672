"""Queries for sources, sinks, projections, routing, merging and scalar functions."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rillwork.functions import scalar as sc
from rillwork.operators import aggregate, basic
from rillwork.plans.registry import query
from rillwork.session import shared_folder
from rillwork.sinks import encode, files as file_sink
from rillwork.sources import files, kafka, roles

READING = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("id", T.StringType()),
    T.StructField("ts", T.LongType()), T.StructField("vc", T.DoubleType())])

READING_SQL = """
SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS id,
       CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS ts, value AS vc
FROM events"""

SENSOR_SQL = "SELECT event_id AS seq, ts, user_id AS id, value AS vc FROM events"


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Sensor rows in the shape of the line format: ts in epoch seconds, id as text."""
    return roles.events(spark, folder).select(
        F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("id"),
        sc.epoch_seconds(F.col("ts")).alias("ts"), F.col("value").alias("vc"))


def reading_lines(spark: SparkSession, folder: str) -> DataFrame:
    return readings(spark, folder).select(F.concat_ws(",", "seq", "id", "ts", "vc").alias("value"))


def sensor(spark: SparkSession, folder: str) -> DataFrame:
    return roles.sensor(roles.events(spark, folder))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/rillwork-{name}-{uuid4().hex}"


# --- sources and parsing ---------------------------------------------------------------------

@query("parse_csv_line", READING_SQL)
def parse_csv_line(spark, folder):
    return files.parse_delimited(reading_lines(spark, folder), READING)


@query("parse_web_log", """
SELECT e.event_id, '10.0.0.' || CAST(e.user_id % 250 AS VARCHAR) AS ip, CAST(e.user_id AS VARCHAR) AS user_id,
       date_trunc('second', e.ts) AS ts, e.event_type AS method, p.url
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) % (SELECT count(*) FROM pages) AS page_id
      FROM events) e JOIN pages p USING (page_id)""")
def parse_web_log(spark, folder):
    lines = roles.web_log_lines(roles.events(spark, folder), roles.table(spark, folder, "pages"))
    return files.parse_web_log(lines, keep=["event_id"])


@query("from_collection", """
SELECT e.event_type, w.weight, count(*) AS n, CAST(sum(w.weight) AS BIGINT) AS score
FROM events e JOIN (VALUES ('view', 1), ('click', 2), ('purchase', 10)) w(event_type, weight)
ON e.event_type = w.event_type GROUP BY e.event_type, w.weight""")
def from_collection(spark, folder):
    weights = files.from_rows(spark, [("view", 1), ("click", 2), ("purchase", 10)], "event_type string, weight int")
    return (roles.events(spark, folder).join(weights, "event_type").groupBy("event_type", "weight")
            .agg(F.count(F.lit(1)).alias("n")).withColumn("score", F.col("n") * F.col("weight")))


@query("kafka_decode", READING_SQL)
def kafka_decode(spark, folder):
    messages = reading_lines(spark, folder).select(F.lit(None).cast("binary").alias("key"),
                                                   F.col("value").cast("binary").alias("value"))
    return kafka.decode_values(messages, READING)


@query("csv_table", """
SELECT id, max(ts) AS last_ts, count(*) AS n FROM (%s) GROUP BY id""" % READING_SQL)
def csv_table(spark, folder):
    path = new_path(spark, "csv-table")
    file_sink.write_delimited(readings(spark, folder), path, sep="|")
    files.delimited_table(spark, path, READING, "sensor_files", sep="|")
    return spark.sql("SELECT id, max(ts) AS last_ts, count(*) AS n FROM sensor_files GROUP BY id")


@query("stream_table_view", "SELECT user_id AS id, value AS vc FROM events WHERE value > 50")
def stream_table_view(spark, folder):
    files.named_view(roles.events(spark, folder).select("event_id", "ts", "user_id", "value"), "sensor_view",
                     ["seq", "ts", "id", "vc"])
    return spark.table("sensor_view").filter("vc > 50").select("id", "vc")


# --- projections and filters -----------------------------------------------------------------

@query("project_pair", "SELECT event_type, 1 AS one FROM events")
def project_pair(spark, folder):
    return basic.with_one(roles.events(spark, folder), "event_type")


@query("composite_key", """
SELECT 'ch' || CAST(user_id % 4 AS VARCHAR) || '_' || event_type AS key, count(*) AS n FROM events GROUP BY 1""")
def composite_key(spark, folder):
    rows = roles.marketing(roles.events(spark, folder))
    # Grouped by the two columns; the text key is built once per group.
    return basic.joined_key(aggregate.counts(rows, "channel", "behavior"), ["channel", "behavior"]).select("key", "n")


@query("select_columns", "SELECT user_id AS id, value AS vc, ts FROM events")
def select_columns(spark, folder):
    return sensor(spark, folder).select("id", "vc", "ts")


@query("rename_by_position", "SELECT event_id AS a, ts AS b, user_id AS c, value AS d FROM events")
def rename_by_position(spark, folder):
    return basic.rename(sensor(spark, folder), ["a", "b", "c", "d"])


@query("filter_predicate", "SELECT event_id, user_id FROM events WHERE event_id % 2 = 1 AND event_type = 'view'")
def filter_predicate(spark, folder):
    return (roles.events(spark, folder)
            .filter((F.col("event_id") % 2 == 1) & (F.col("event_type") == "view")).select("event_id", "user_id"))


@query("filter_table", f"SELECT * FROM ({SENSOR_SQL}) WHERE id = 7")
def filter_table(spark, folder):
    return sensor(spark, folder).where("id = 7")


@query("sql_where_and", f"SELECT * FROM ({SENSOR_SQL}) WHERE id = 7 AND vc > 50")
def sql_where_and(spark, folder):
    files.named_view(sensor(spark, folder), "sensor_rows")
    return spark.sql("SELECT * FROM sensor_rows WHERE id = 7 AND vc > 50")


@query("flatmap_split", """
SELECT doc_id, word FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> ''""")
def flatmap_split(spark, folder):
    return basic.words(roles.table(spark, folder, "documents"), "text", keep=["doc_id"])


@query("flatten_list", """
SELECT event_id, unnest([user_id, event_id % 10, CAST(floor(value) AS BIGINT)]) AS item FROM events""")
def flatten_list(spark, folder):
    lists = F.array(F.col("user_id"), F.col("event_id") % 10, F.floor("value").cast("long"))
    return basic.emit_each(roles.events(spark, folder), lists, "item", keep=["event_id"])


@query("flatmap_filter", "SELECT event_id, 'pv' AS what FROM events WHERE event_type = 'view'")
def flatmap_filter(spark, folder):
    return basic.emit_if(roles.events(spark, folder), F.col("event_type") == "view", F.lit("pv"), "what", ["event_id"])


# --- routing ---------------------------------------------------------------------------------

LABEL_SQL = """
SELECT event_id AS seq, user_id AS id, value AS vc,
       CASE WHEN value < 50 THEN ['normal'] WHEN value < 80 THEN ['warn', 'high'] ELSE ['alarm', 'high'] END AS labels
FROM events"""


def with_labels(spark: SparkSession, folder: str) -> DataFrame:
    return basic.label(
        sensor(spark, folder).select("seq", "id", "vc"),
        [(F.col("vc") < 50, ["normal"]), (F.col("vc") < 80, ["warn", "high"])], ["alarm", "high"])


@query("split_labels", f"SELECT seq, id, vc, array_to_string(labels, '+') AS labels FROM ({LABEL_SQL})")
def split_labels(spark, folder):
    return with_labels(spark, folder).withColumn("labels", F.array_join("labels", "+"))


@query("select_label", f"SELECT seq, id, vc FROM ({LABEL_SQL}) WHERE list_contains(labels, 'high')")
def select_label(spark, folder):
    return basic.labelled(with_labels(spark, folder), "high").select("seq", "id", "vc")


@query("side_output_route", """
SELECT event_id AS seq, CASE WHEN value > 100 THEN 'alarm' ELSE 'main' END AS tag,
       CASE WHEN value > 100 THEN 'sensor ' || CAST(user_id AS VARCHAR) || ' is high'
            ELSE CAST(user_id AS VARCHAR) END AS message
FROM events""")
def side_output_route(spark, folder):
    tagged = basic.route(sensor(spark, folder), [("alarm", F.col("vc") > 100)])
    alarms = F.concat(F.lit("sensor "), F.col("id"), F.lit(" is high"))
    return tagged.select("seq", "tag", F.when(F.col("tag") == "alarm", alarms)
                         .otherwise(F.col("id").cast("string")).alias("message"))


@query("connect_comap", """
SELECT 'event' AS side, CAST(event_id AS VARCHAR) AS label, value AS amount FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 'order', o_orderstatus || CAST(o_orderkey AS VARCHAR), o_totalprice FROM orders""")
def connect_comap(spark, folder):
    return basic.connect(
        roles.events(spark, folder).filter("event_type = 'purchase'"), roles.table(spark, folder, "orders"),
        {"side": F.lit("event"), "label": F.col("event_id").cast("string"), "amount": F.col("value")},
        {"side": F.lit("order"), "label": F.concat("o_orderstatus", F.col("o_orderkey").cast("string")),
         "amount": F.col("o_totalprice")})


@query("key_by", "SELECT user_id AS id, 1 AS partitions, count(*) AS n FROM events GROUP BY user_id")
def key_by(spark, folder):
    placed = basic.partition_by_key(sensor(spark, folder), "id").withColumn("p", F.spark_partition_id())
    # Counted per (key, partition) first, so the check itself stays balanced.
    return (placed.groupBy("id", "p").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("id").agg(F.count(F.lit(1)).cast("int").alias("partitions"), F.sum("n").alias("n")))


@query("shuffle_random", SENSOR_SQL)
def shuffle_random(spark, folder):
    return basic.shuffle(sensor(spark, folder))


# --- merging ---------------------------------------------------------------------------------

@query("union_all", """
SELECT user_id FROM events WHERE event_type = 'signup'
UNION ALL SELECT user_id FROM events WHERE event_type = 'purchase'
UNION ALL SELECT user_id FROM events WHERE event_type = 'click'""")
def union_all(spark, folder):
    rows = roles.events(spark, folder)
    return basic.merge(*[rows.filter(F.col("event_type") == t).select("user_id")
                         for t in ("signup", "purchase", "click")])


@query("union_distinct", """
SELECT user_id, event_type FROM events WHERE value < 50 UNION
SELECT user_id, event_type FROM events WHERE event_type = 'purchase'""")
def union_distinct(spark, folder):
    rows = roles.events(spark, folder)
    return basic.merge_distinct(rows.filter("value < 50").select("user_id", "event_type"),
                                rows.filter("event_type = 'purchase'").select("user_id", "event_type"))


# --- scalar functions ------------------------------------------------------------------------

@query("scalar_split_cast", """
SELECT event_id, user_id, CAST(floor(value) AS INTEGER) AS vc FROM events""")
def scalar_split_cast(spark, folder):
    line = roles.events(spark, folder).select(
        F.concat_ws(",", "event_id", "user_id", F.floor("value")).alias("value"))
    part = F.split("value", ",")
    return line.select(part[0].cast("long").alias("event_id"), part[1].cast("long").alias("user_id"),
                       part[2].cast("int").alias("vc"))


@query("scalar_concat", """
SELECT event_id, 'user ' || CAST(user_id AS VARCHAR) || ' did ' || event_type AS message,
       CAST(user_id AS VARCHAR) || '_' || event_type AS key FROM events""")
def scalar_concat(spark, folder):
    return roles.events(spark, folder).select(
        "event_id", F.format_string("user %d did %s", "user_id", "event_type").alias("message"),
        F.concat_ws("_", "user_id", "event_type").alias("key"))


@query("scalar_parse_time", """
SELECT event_id, date_trunc('second', ts) AS parsed, epoch_ms(date_trunc('second', ts)) AS ms FROM events""")
def scalar_parse_time(spark, folder):
    text = roles.events(spark, folder).select("event_id", F.date_format("ts", sc.WEB_LOG_TIME).alias("text"))
    parsed = text.select("event_id", sc.parse_time(F.col("text")).alias("parsed"))
    return parsed.withColumn("ms", F.unix_millis(F.col("parsed").cast("timestamp")))


@query("scalar_epoch_to_ts", """
SELECT event_id, date_trunc('second', ts) AS from_s, date_trunc('millisecond', ts) AS from_ms FROM events""")
def scalar_epoch_to_ts(spark, folder):
    ts = F.col("ts")
    return roles.events(spark, folder).select(
        "event_id", sc.from_epoch_seconds(sc.epoch_seconds(ts)).alias("from_s"),
        sc.from_epoch_millis(F.unix_millis(ts.cast("timestamp"))).alias("from_ms"))


@query("scalar_day_bucket", """
SELECT event_id, date_trunc('day', ts)::TIMESTAMP AS day, date_trunc('day', ts) + INTERVAL 1 DAY AS next_midnight
FROM events""")
def scalar_day_bucket(spark, folder):
    return roles.events(spark, folder).select(
        "event_id", sc.day_of(F.col("ts")).alias("day"), sc.next_midnight(F.col("ts")).alias("next_midnight"))


@query("scalar_abs_mod", """
SELECT event_id, abs(user_id - event_id) AS gap, event_id % 7 AS remainder, greatest(user_id, event_id % 100) AS top
FROM events""")
def scalar_abs_mod(spark, folder):
    return roles.events(spark, folder).select(
        "event_id", F.abs(F.col("user_id") - F.col("event_id")).alias("gap"), (F.col("event_id") % 7).alias("remainder"),
        F.greatest(F.col("user_id"), F.col("event_id") % 100).alias("top"))


@query("scalar_poly_hash", """
SELECT event_id, list_reduce(list_transform(string_split('user-' || CAST(user_id AS VARCHAR) || event_type, ''),
       lambda c: CAST(ascii(c) AS BIGINT)), lambda h, x: (h * 61 + x) & 1073741823, CAST(0 AS BIGINT)) AS slot
FROM events""")
def scalar_poly_hash(spark, folder):
    return roles.events(spark, folder).select(
        "event_id", sc.poly_hash(F.concat(F.lit("user-"), F.col("user_id"), F.col("event_type"))).alias("slot"))


@query("keyed_process", """
SELECT event_id, 'key=' || CAST(user_id AS VARCHAR) || ' type=' || event_type AS message FROM events""")
def keyed_process(spark, folder):
    return roles.events(spark, folder).select(
        "event_id", F.concat(F.lit("key="), F.col("user_id"), F.lit(" type="), F.col("event_type")).alias("message"))


# --- sinks -----------------------------------------------------------------------------------

@query("file_sink", READING_SQL)
def write_and_read_files(spark, folder):
    path = new_path(spark, "file-sink")
    file_sink.write_delimited(readings(spark, folder), path, sep=",")
    return spark.read.schema(READING).option("sep", ",").csv(path)


@query("kafka_encode", """
SELECT CAST(user_id AS VARCHAR) AS key, CAST(event_id AS VARCHAR) || ',' || event_type AS value FROM events""")
def kafka_encode(spark, folder):
    rows = roles.events(spark, folder).select("user_id", "event_id", "event_type")
    return encode.topic_messages(rows, "user_id", ["event_id", "event_type"]).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@query("document_encode", """
SELECT '{"data":"' || CAST(event_id AS VARCHAR) || '_' || event_type || '"}' AS document FROM events""")
def document_encode(spark, folder):
    rows = roles.events(spark, folder)
    return encode.documents(rows, data=F.concat_ws("_", "event_id", "event_type"))


@query("latest_per_key", """
SELECT user_id AS id, arg_max(value, event_id) AS vc FROM events GROUP BY user_id""")
def latest_per_key(spark, folder):
    return aggregate.latest(sensor(spark, folder), ["id"], ["ts", "seq"], ["vc"])


@query("jdbc_append", """
SELECT CAST(user_id AS VARCHAR) AS id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS ts,
       CAST(floor(value) AS INTEGER) AS vc FROM events""")
def jdbc_append(spark, folder):
    return encode.table_rows(readings(spark, folder),
                             {"id": F.col("id"), "ts": F.col("ts"), "vc": F.floor("vc").cast("int")})
