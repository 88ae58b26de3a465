"""Text, number and null handling on untrusted input: bad values become NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegrid.config import COMPASS


def number(c: Column) -> Column:
    return c.try_cast("double")


def first_point(points: Column) -> tuple[Column, Column]:
    """Latitude and longitude of the first pair in ``"lat,lon lat,lon ..."``."""
    pair = F.split(F.trim(F.get(F.split(points, " "), F.lit(0))), ",")
    return number(F.get(pair, F.lit(0))), number(F.get(pair, F.lit(1)))


def first_int(text: Column) -> Column:
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("int")


def compass(degrees: Column) -> Column:
    # NaN, infinite and absurd bearings have no name.
    usable = F.when(F.abs(degrees) < 1e9, degrees)
    step = F.floor(usable / F.lit(22.5) + F.lit(0.5)).try_cast("int")
    return F.get(F.array(*(F.lit(p) for p in COMPASS)), F.pmod(step, F.lit(16)))


def or_default(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def bucketize(c: Column, buckets: Sequence[tuple[float | None, str]]) -> Column:
    """Label by upper edge (exclusive); the last bucket has no edge and takes the rest."""
    *bounded, (_, rest) = buckets
    out = None
    for edge, label in bounded:
        out = F.when(c < edge, label) if out is None else out.when(c < edge, label)
    return out.otherwise(rest)


def message_key(*parts: Column) -> Column:
    return F.concat_ws("::", *parts)


def point_key(lat: Column, lon: Column) -> Column:
    return F.concat_ws(",", lat.cast("string"), lon.cast("string"))
