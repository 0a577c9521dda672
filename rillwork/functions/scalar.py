"""Scalar helpers, all built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the visitor hash: multiplier and the 2^30 slots it maps to.
HASH_SEED = 61
HASH_MASK = (1 << 30) - 1

WEB_LOG_TIME = "dd/MM/yyyy:HH:mm:ss"


def epoch_micros(ts: Column) -> Column:
    """Microseconds since the epoch of a timestamp without zone (session zone is UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def from_epoch_seconds(s: Column) -> Column:
    return F.timestamp_seconds(s).cast("timestamp_ntz")


def from_epoch_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def parse_time(text: Column, pattern: str = WEB_LOG_TIME) -> Column:
    return F.to_timestamp_ntz(text, F.lit(pattern))


def day_of(ts: Column) -> Column:
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def next_midnight(ts: Column) -> Column:
    return day_of(ts) + F.expr("interval 1 day")


def seconds(n: float) -> Column:
    """An interval of ``n`` seconds."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n).cast("decimal(18,6)"))


def floor_div(c: Column, n: int) -> Column:
    """Floor division of whole numbers, also below zero."""
    return F.call_function("div", c - F.pmod(c, F.lit(n)), F.lit(n))


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds_of(text: str) -> int:
    """Whole seconds of a length such as ``5 minutes``."""
    number, unit = text.split()
    return int(number) * _UNIT_SECONDS[unit.removesuffix("s")]


def money(value: Column, digits: int = 2, precision: int = 18) -> Column:
    """Exact form of an amount with ``digits`` decimals; sums of it do not depend on row order."""
    return value.cast(f"decimal({precision},{digits})")


def poly_hash(text: Column, seed: int = HASH_SEED, mask: int = HASH_MASK) -> Column:
    """Polynomial string hash on 30 bits; masking every step equals masking once at the end."""
    return F.aggregate(
        F.split(text, ""), F.lit(0).cast("long"),
        lambda h, c: (h * seed + F.ascii(c)).bitwiseAND(F.lit(mask).cast("long")))
