"""The roles the analyses need, as views over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillwork.schemas import EVENT
from rillwork.session import shared_folder

PROVINCES = 5
CHANNELS = 4
ADS = 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    """The event log as a stream; event time has a zone here because watermarks ask for it.

    The last character is globbed so that one file and a folder of files both load.
    """
    return (spark.readStream.schema(EVENT).parquet(f"{folder}/events.parque[t]")
            .withColumn("ts", F.col("ts").cast("timestamp")))


@dataclass(frozen=True)
class Arriving:
    """A stream, and what brings its input part by part; see ``runner.replay``."""

    rows: DataFrame
    parts: list[Callable[[], None]]


def arriving_events(spark: SparkSession, folder: str, parts: int = 4) -> Arriving:
    """The event log as a stream of ``parts`` micro-batches in order of arrival, rows delayed by up to an hour.

    The parts divide the span of arrival times evenly; each is written by as many tasks as read the log. The columns are
    those of the log and ``arrival``; rows that have none come with the first part.
    """
    target = f"{shared_folder(spark)}/arriving-{uuid4().hex}"
    rows = with_arrival(events(spark, folder))
    at = F.unix_micros(F.col("arrival").cast("timestamp"))
    low, high = rows.agg(F.min(at), F.max(at)).first()
    low, high = low or 0, high or 0
    part = F.coalesce(F.floor((at - low) * parts / (high - low + 1)), F.lit(0))
    spark.createDataFrame([], rows.schema).write.parquet(target)

    def bring(number: int) -> Callable[[], None]:
        return lambda: rows.filter(part == number).write.mode("append").parquet(target)

    stream = spark.readStream.schema(rows.schema).parquet(target).withColumn("ts", F.col("ts").cast("timestamp"))
    return Arriving(stream, [bring(n) for n in range(parts)])


def with_item(df: DataFrame) -> DataFrame:
    return df.withColumn("item_id", F.get_json_object("props", "$.k").cast("int"))


def views_of_items(df: DataFrame) -> DataFrame:
    """Page views: (event_id, ts, user_id, item_id)."""
    return with_item(df.filter(F.col("event_type") == "view")).select("event_id", "ts", "user_id", "item_id")


def sensor(df: DataFrame) -> DataFrame:
    """(seq, ts, id, vc) readings."""
    return df.select(F.col("event_id").alias("seq"), "ts", F.col("user_id").alias("id"), F.col("value").alias("vc"))


def marketing(df: DataFrame) -> DataFrame:
    """(user_id, behavior, channel, ts) of app-market users."""
    return df.select("user_id", F.col("event_type").alias("behavior"),
                     F.concat(F.lit("ch"), F.col("user_id") % CHANNELS).alias("channel"), "ts")


def ad_clicks(df: DataFrame, region: DataFrame) -> DataFrame:
    """(event_id, ts, user_id, ad_id, province) of clicks; ``region`` has one row per province."""
    clicks = with_item(df.filter(F.col("event_type") == "click"))
    return (clicks.withColumn("r_regionkey", (F.col("user_id") % PROVINCES).cast("int"))
            .join(region, "r_regionkey")
            .select("event_id", "ts", "user_id", (F.col("item_id") % ADS).alias("ad_id"),
                    F.col("r_name").alias("province")))


def logins(df: DataFrame) -> DataFrame:
    """(event_id, ts, user_id, failed)."""
    return df.select("event_id", "ts", "user_id", (F.col("event_type") == "error").alias("failed"))


def order_events(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """(order_id, kind, ts): an order is created once and paid with its first shipment."""
    return (orders.select(F.col("o_orderkey").alias("order_id"), F.lit("create").alias("kind"),
                          F.col("o_orderdate").alias("ts"))
            .unionByName(lineitem.select(F.col("l_orderkey").alias("order_id"), F.lit("pay").alias("kind"),
                                         F.col("l_shipdate").alias("ts"))))


def web_log_lines(df: DataFrame, pages: DataFrame) -> DataFrame:
    """(event_id, value): one access-log line per event, its url looked up in ``pages``."""
    n_pages = pages.agg(F.count("page_id")).scalar()
    urls = pages.select("page_id", "url")
    hits = (with_item(df).select("event_id", "ts", "user_id", "event_type", "item_id")
            .withColumn("page_id", F.col("item_id") % n_pages))
    line = F.concat_ws(
        " ", F.concat(F.lit("10.0.0."), F.col("user_id") % 250), F.col("user_id"), F.lit("-"),
        F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"), F.col("event_type"), F.col("url"))
    return hits.join(urls, "page_id").select("event_id", line.alias("value"))


def with_arrival(df: DataFrame) -> DataFrame:
    """Rows with the time they come at, delayed by up to an hour, hence out of order."""
    delay = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), ((F.col("event_id") * 7919) % 3600).cast("decimal(18,6)"))
    return df.withColumn("arrival", F.col("ts") + delay)


def in_arrival_order(df: DataFrame) -> DataFrame:
    """(event_id, ts, user_id, arrival) of rows that come out of order."""
    return with_arrival(df).select("event_id", "ts", "user_id", "arrival")
