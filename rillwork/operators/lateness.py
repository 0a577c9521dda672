"""Watermarks and late rows, defined per row.

``arrival`` columns give the order in which rows came in. The watermark a row
meets is the greatest event time of all earlier rows less the allowed disorder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rillwork.functions.scalar import seconds
from rillwork.operators.ordered import Running, running
from rillwork.session import keep

ON_TIME, REFIRE, LATE = "on_time", "refire", "late"


def watermark_seen(df: DataFrame, arrival: Sequence[str], ts: str, bound: float, name: str = "watermark",
                   include_row: bool = False, cell: float | None = None) -> DataFrame:
    """Add the watermark in force when the row arrives, null for the very first (or just after it)."""
    out = running(df, [], arrival, {name: Running("max", F.col(ts), exclusive=not include_row)}, cell)
    return out.withColumn(name, F.col(name) - seconds(bound))


def classify(df: DataFrame, arrival: Sequence[str], ts: str, size: str, bound: float, lateness: float,
             cell: float | None = None) -> DataFrame:
    """Add the row's window and whether it is on time, makes a fired window fire again, or comes too late."""
    rows = watermark_seen(df, arrival, ts, bound, "watermark", cell=cell)
    window = F.window(ts, size)
    rows = rows.withColumn("window_start", window["start"]).withColumn("window_end", window["end"])
    return rows.withColumn(
        "status",
        F.when(F.col("watermark") >= F.col("window_end") + seconds(lateness), LATE)
        .when(F.col("watermark") >= F.col("window_end"), REFIRE)
        .otherwise(ON_TIME))


def firings(df: DataFrame, arrival: Sequence[str], ts: str, size: str, bound: float, lateness: float,
            cell: float | None = None) -> DataFrame:
    """What a window with allowed lateness emits: its count when it fires, and again for each row let in after.

    ``refired_by`` is the last arrival column of the row that made it fire again, null for the first firing.
    """
    # read by both kinds of firings and several times by the second scan
    rows = keep(classify(df, arrival, ts, size, bound, lateness, cell).filter(F.col("status") != LATE))
    counted = running(rows, ["window_start"], arrival, {"n": Running("count", F.lit(1))}, cell)
    kind = df.schema[arrival[-1]].dataType
    again = (counted.filter(F.col("status") == REFIRE)
             .select("window_start", F.col(arrival[-1]).alias("refired_by"), "n"))
    first = (rows.filter(F.col("status") == ON_TIME).groupBy("window_start")
             .agg(F.count(F.lit(1)).alias("n"))
             .select("window_start", F.lit(None).cast(kind).alias("refired_by"), "n"))
    return first.unionByName(again)
