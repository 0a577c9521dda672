"""Checks on keyed event logs: blacklists, failed logins, unpaid orders, rising values."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rillwork.functions.scalar import day_of, epoch_micros, seconds
from rillwork.operators.chains import long_chains
from rillwork.operators.ordered import Near, Running, running, same_keys, scan
from rillwork.operators.windows import check_limit
from rillwork.session import keep

# Executors may not have the package installed, so its functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed thresholds of the analyses.
CLICKS_PER_DAY = 100
LOGIN_SECONDS = 2
PAY_SECONDS = 15 * 60
RISING_SECONDS = 5
# Distinct times of a stretch above which it is walked in cells, by several tasks.
LONGEST_STRETCH = 1_000_000

PAID, PAID_LATE, TIMEOUT, NO_CREATE = "paid", "late", "timeout", "missing_create"


def _click_number(keys: Sequence[str], ts: str, order: Sequence[str]) -> Column:
    return F.row_number().over(Window.partitionBy(*keys, day_of(F.col(ts))).orderBy(*order))


def below_daily_limit(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str],
                      limit: int = CLICKS_PER_DAY) -> DataFrame:
    """The first ``limit`` rows of each key and UTC day.

    The rank filter works before the shuffle, so a key that floods the log
    sends at most ``limit`` rows of a day from each map task. A limit above what Spark filters so is refused.
    """
    check_limit(df, limit)
    return df.withColumn("__nth", _click_number(keys, ts, order)).filter(F.col("__nth") <= limit).drop("__nth")


def limit_alarms(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str],
                 limit: int = CLICKS_PER_DAY) -> DataFrame:
    """The row that first went over the limit, once per key and day."""
    check_limit(df, limit + 1)
    nth = df.withColumn("__nth", _click_number(keys, ts, order)).filter(F.col("__nth") <= limit + 1)
    return nth.filter(F.col("__nth") == limit + 1).drop("__nth")


def repeated_failures(fails: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str],
                      within: float = LOGIN_SECONDS) -> DataFrame:
    """Failures close to the key's first failure ever; ``first_ts`` tells when that was, null times aside.

    The first failure is one minimum per key, combined before the shuffle and joined back, so no key is put in order.
    """
    first = fails.groupBy(*[F.col(k).alias("__f_" + k) for k in keys]).agg(F.min(F.struct(*order)).alias("__first"))
    known = fails.join(first, same_keys(keys, "__f_"))
    later = known.filter(F.struct(*order) > F.col("__first")).withColumn("first_ts", F.col(f"__first.{ts}"))
    gap = F.abs(epoch_micros(F.col(ts)) - epoch_micros(F.col("first_ts")))
    return later.filter(gap <= int(within * 1_000_000)).drop("__first", *["__f_" + k for k in keys])


def payment_status(df: DataFrame, key: str, kind: str, ts: str, limit: float = PAY_SECONDS) -> DataFrame:
    """One row per order with its creation, first payment and status.

    Both sides of the check come from one grouping, combined before the shuffle.
    """
    created, paid = F.col(kind) == "create", F.col(kind) == "pay"
    both = df.groupBy(key).agg(
        F.min(F.when(created, F.col(ts))).alias("created"), F.min(F.when(paid, F.col(ts))).alias("paid"),
        F.max(created).alias("__created"), F.max(paid).alias("__paid"))
    # a row counts as there even if its time is null
    status = (
        F.when(~F.coalesce("__created", F.lit(False)), NO_CREATE)
        .when(~F.coalesce("__paid", F.lit(False)), TIMEOUT)
        .when(F.col("paid") > F.col("created") + seconds(limit), PAID_LATE)
        .otherwise(PAID))
    return both.withColumn("status", status).drop("__created", "__paid")


def rising_alarms(df: DataFrame, keys: Sequence[str], ts: str, seq: str, value: str, hold: float = RISING_SECONDS,
                  cell: float | None = None, longest: int = LONGEST_STRETCH) -> DataFrame:
    """(keys, ``alarm_at``): times at which ``value`` had not fallen for ``hold`` seconds.

    The first row that does not fall sets the alarm, a fall cancels it, and
    after it went off the next row that does not fall sets it again.

    A fall, and a pause longer than ``hold``, end a stretch: what follows does
    not depend on what was before. Stretches are found with balanced running
    values and thinned to their distinct times. The re-arming inside a stretch
    runs over sorted batches with one number of memory; stretches of more than
    ``longest`` times are walked in cells and put together as ``chains`` describes.
    """
    order = [ts, seq]
    rows = scan(df.select(*keys, ts, seq, value), keys, order, {
        "__before": Near(F.struct(ts, value), 1, backward=True), "__after": Near(F.struct(ts, value), 1)},
        cell)
    before, after = F.get("__before", F.lit(0)), F.get("__after", F.lit(0))
    fell = F.col(value) < F.coalesce(before[value], F.lit(0))
    pause = epoch_micros(F.col(ts)) - epoch_micros(before[ts]) > int(hold * 1_000_000)
    rows = rows.select(
        *keys, ts, seq, fell.alias("__fell"), F.when(fell | pause | before.isNull(), 1).alias("__start"),
        F.when(after[value] < F.col(value), epoch_micros(after[ts])).alias("__cancel"))
    # read by both branches of the second scan
    rows = running(keep(rows), keys, order, {"__stretch": Running("count", F.col("__start"))}, cell)

    group = [*keys, "__stretch"]
    times = keep(rows.filter(~F.col("__fell")).groupBy(*group, epoch_micros(F.col(ts)).alias("__at"))
                 .agg(F.max("__cancel").alias("__cancel")))
    micros = int(hold * 1_000_000)
    long = times.groupBy(*[F.col(k).alias("__g_" + k) for k in group]).agg(
        F.count(F.lit(1)).alias("__n"), F.max("__cancel").alias("__stop")).filter(F.col("__n") > longest).drop("__n")
    short = times.join(long.drop("__stop"), same_keys(group, "__g_"), "left_anti")
    sorted_times = short.repartition(*group).sortWithinPartitions(*group, "__at")
    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("__alarm", T.LongType())])
    alarms = sorted_times.mapInPandas(_chain(list(keys), micros), schema)
    if not long.isEmpty():
        chain = long_chains(times.join(long.drop("__stop"), same_keys(group, "__g_"), "left_semi"), group, micros, cell)
        chain = chain.join(long, same_keys(group, "__g_"))
        due = F.col("__at") + micros
        goes_off = F.col("__next").isNotNull() | F.col("__stop").isNull() | (due < F.col("__stop"))
        alarms = alarms.unionByName(chain.filter(goes_off).select(*keys, due.alias("__alarm")))
    zone_free = df.schema[ts].dataType
    return alarms.select(*keys, F.timestamp_micros("__alarm").cast(zone_free).alias("alarm_at"))


def _chain(keys: list[str], hold: int):
    """Alarm times per stretch over sorted batches; a stretch may run over several of them."""
    name_columns = [*keys, "__stretch"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_name, due, cancel = None, None, None  # the stretch the batches so far end in

        def rows(names: pd.DataFrame, alarms: np.ndarray) -> pd.DataFrame:
            return names.reset_index(drop=True).assign(__alarm=np.asarray(alarms, dtype="int64"))

        for batch in (b.reset_index(drop=True) for b in batches if len(b)):
            names, at = batch[name_columns], batch["__at"].to_numpy()
            changed = ((names != names.shift()) & ~(names.isna() & names.shift().isna())).any(axis=1).to_numpy()
            changed[0] = True
            first = np.flatnonzero(changed)
            last = np.append(first[1:], len(batch)) - 1
            # Times on one line, stretch after stretch, too far apart to reach each other.
            span = at[last] - at[first] + hold + 1
            line = at - np.repeat(at[first], last - first + 1) + np.repeat(np.cumsum(span) - span, last - first + 1)
            sets_next = np.searchsorted(line, line + hold, side="right")

            setter = first.copy()  # per stretch, the row the pending alarm was set by; -1: before this batch
            pending = at[first] + hold
            if open_name is not None:
                if names.iloc[:1].equals(open_name):
                    pending[0], setter[0] = due, -1
                elif cancel is None or due < cancel:
                    yield rows(open_name[keys], np.array([due]))
            where, alarms = [], []
            live = np.arange(len(first))
            while len(live):  # one step of every stretch that still goes on
                next_row = np.where(setter[live] >= 0, sets_next[setter[live]],
                                    np.searchsorted(at[:last[0] + 1], pending[live], side="right"))
                goes_on = next_row <= last[live]
                live, next_row = live[goes_on], next_row[goes_on]
                where.append(first[live])
                alarms.append(pending[live])
                setter[live], pending[live] = next_row, at[next_row] + hold
            cancels = batch["__cancel"].to_numpy(dtype="float64", na_value=np.nan)[last]
            closed = np.arange(len(first) - 1)
            sure = closed[~(pending[closed] >= cancels[closed])]
            where.append(first[sure])
            alarms.append(pending[sure])
            at_rows = np.concatenate(where)
            if len(at_rows):
                yield rows(batch[keys].iloc[at_rows], np.concatenate(alarms))
            open_name, due = names.iloc[-1:].reset_index(drop=True), int(pending[-1])
            cancel = None if np.isnan(cancels[-1]) else int(batch["__cancel"].iloc[-1])
        if open_name is not None and (cancel is None or due < cancel):
            yield rows(open_name[keys], np.array([due]))

    return run
