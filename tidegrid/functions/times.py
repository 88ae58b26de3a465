"""Event-time expressions. Instants are ``timestamp`` under a UTC session."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def instant(text: Column) -> Column:
    return F.try_to_timestamp(text)


def local_to_utc(text: Column, zone: str, fmt: str = LOCAL_FORMAT) -> Column:
    return F.to_utc_timestamp(F.try_to_timestamp(text, F.lit(fmt)), zone)


def to_iso_utc(text: Column) -> Column:
    """ISO time as ``...Z``; text that already ends in Z passes, bad text is NULL."""
    parsed = F.date_format(F.try_to_timestamp(text), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.when(text.endswith("Z"), text).otherwise(parsed)


def epoch_to_ts(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def slot(ts: Column, width_micros: int) -> Column:
    """Index of the time slot of fixed width that holds ``ts``."""
    us = micros(ts)
    return ((us - F.pmod(us, F.lit(width_micros))) / F.lit(width_micros)).cast("bigint")


def time_bucket(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(ts.cast("timestamp")) / F.lit(seconds))


def time_bin(ts: Column, seconds: int) -> Column:
    """Start of the fixed-width bin (for example 900 s) that holds ``ts``."""
    return F.timestamp_seconds(time_bucket(ts, seconds) * F.lit(seconds))


def interval(seconds: float) -> Column:
    # A literal, which streaming joins need to derive state eviction.
    return F.lit(timedelta(seconds=seconds))


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(delay: str) -> int:
    """Seconds of a delay such as ``15 minutes``."""
    number, unit = delay.split()
    return int(number) * _UNITS[unit.removesuffix("s")]


def lag_minutes(ts: Column, as_of: Column) -> Column:
    behind = F.unix_timestamp(as_of) - F.unix_timestamp(ts)
    return F.round((behind / F.lit(60.0)).cast("decimal(28,10)"), 2).cast("double")


def as_of_literal(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def shed_event_time(ts: Column) -> Column:
    """Same instant without watermark metadata, so a second stream join can follow."""
    return F.to_timestamp(ts.cast("string"))
