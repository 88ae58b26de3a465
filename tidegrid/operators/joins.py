"""Interval, lookup, distance and nearest-in-time joins."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.functions.geo import haversine_m
from tidegrid.functions.hexgrid import EARTH_M
from tidegrid.functions.times import interval, micros, slot
from tidegrid.operators.skew import (
    BUCKET, LEFT_PART, MICRO, RIGHT_PART, HotGroups, bucket_right, bucket_width, copies, cut_outer,
    finish_cut, row_part,
)


SLICES = 64  # of a time bucket, in the nearest-in-time join


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    before: float,
    after: float,
    how: str = "inner",
    salt: int = 1,
    hot: HotGroups | None = None,
    extra: Column | None = None,
) -> DataFrame:
    """Rows with equal keys and ``left_ts - before <= right_ts <= left_ts + after`` (seconds).

    ``keys`` have the same names on both sides; other column names must differ.
    ``how`` is ``inner`` or ``left``. ``extra`` is a further predicate over the
    columns of both sides, for inner joins only.

    Time becomes part of the join key: a left row lies in one bucket as wide as
    the whole window, a right row is copied to the (at most two) buckets it can
    reach, so each pair meets exactly once and a key that holds a third of all
    rows is spread over time. On bounded inputs adaptive execution splits what
    is still skewed, and ``hot`` (from ``find_hot``) cuts hot right groups of a
    left join. Streams cannot be counted ahead: there ``salt`` cuts every left
    group into that many parts and copies the right rows to each.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    if extra is not None and how != "inner":
        raise ValueError("an extra predicate needs an inner join")

    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")

    out_columns = left.columns + [c for c in right.columns if c not in keys]
    left = left.withColumn(BUCKET, slot(F.col(left_ts), bucket_width(before, after)))
    right = bucket_right(right, right_ts, before, after)
    join_keys = [*keys, BUCKET]
    cut = hot is not None and how == "left"
    if salt > 1:
        left = left.withColumn(LEFT_PART, row_part(left, F.lit(salt)))
        right = right.withColumn(LEFT_PART, copies(F.lit(salt)))
    if cut:
        left, right = cut_outer(left, right, join_keys, left_ts, before, after, hot)
        join_keys += [RIGHT_PART]
    if salt > 1:
        join_keys += [LEFT_PART]

    # Both bounds stay in the condition: on streams they also set state eviction.
    other = right.select(*(F.col(f"`{c}`").alias(f"_r_{c}" if c in join_keys else c) for c in right.columns))
    cond = (F.col(right_ts) >= F.col(left_ts) - interval(before)) & (
        F.col(right_ts) <= F.col(left_ts) + interval(after)
    )
    for k in join_keys:
        cond = (F.col(k) == F.col(f"_r_{k}")) & cond
    if extra is not None:
        cond = cond & extra
    joined = left.join(other, cond, "leftOuter" if how == "left" else "inner")
    if cut:
        joined = finish_cut(joined)
    return joined.select(*(F.col(f"`{c}`") for c in out_columns))


def abs_seconds_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, seconds: int
) -> DataFrame:
    """Inner join on keys and ``|left - right| <= seconds`` in whole seconds (fractions are cut off)."""
    whole = [F.date_trunc("second", F.col(c).cast("timestamp")) for c in (left_ts, right_ts)]
    joined = interval_join(
        left.withColumn("_sec_l", whole[0]), right.withColumn("_sec_r", whole[1]),
        keys, "_sec_l", "_sec_r", seconds, seconds,
    )
    return joined.drop("_sec_l", "_sec_r")


def enrich_lookup(main: DataFrame, lookup: DataFrame, key: str, lookup_key: str, flags: Sequence[str]) -> DataFrame:
    """Left outer lookup join; flags without a lookup row become false.

    Spark picks the strategy from the size of the stored lookup: a small one is broadcast.
    """
    table = lookup.select(F.col(lookup_key).alias("_lookup"), *flags)
    filled = {f: F.coalesce(F.col(f), F.lit(False)) for f in flags}
    return main.join(table, F.col(key) == F.col("_lookup"), "left").drop("_lookup").withColumns(filled)


def _cover(df: DataFrame, lat: Column, lon: Column, metres: float, cells: int, lat_deg: float) -> DataFrame:
    """Copies each row to the grid cells that a circle around its point can touch, anywhere on the globe.

    Latitude is cut in rows of ``lat_deg``, longitude in ``cells`` columns that
    wrap around. Near a pole the circle may cover all columns.
    """
    angle = metres / EARTH_M
    reach_lat = F.lit(math.degrees(angle) * 1.000001)
    sin_ratio = F.sin(F.lit(angle)) / F.cos(F.radians(lat))
    all_round = (F.abs(lat) + reach_lat >= 90.0) | (sin_ratio >= 1.0)
    reach_lon = F.when(all_round, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(sin_ratio, F.lit(1.0)))) * F.lit(1.000001)
    )
    step = F.lit(360.0 / cells)
    low, high = (F.floor((lat + s * reach_lat) / F.lit(lat_deg)) for s in (-1, 1))
    first = F.floor((lon - reach_lon + 180.0) / step)
    # Not more than one round, so no column comes twice.
    last = F.least(F.floor((lon + reach_lon + 180.0) / step), first + F.lit(cells - 1))
    return (
        df.withColumn("_gy", F.explode(F.sequence(low, high)))
        .withColumn("_gx", F.explode(F.sequence(first, last)))
        .withColumn("_gx", F.pmod("_gx", F.lit(cells)).cast("bigint"))
    )


def distance_time_join(
    left: DataFrame,
    right: DataFrame,
    left_point: tuple[str, str],
    right_point: tuple[str, str],
    metres: float,
    left_ts: str,
    right_ts: str,
    seconds: float,
) -> DataFrame:
    """Pairs within a great-circle distance and ``seconds`` of each other, inner.

    A left row lies in one grid cell and time bucket, a right row is copied to
    those it can reach; the distance is then tested exactly. Points are (lat, lon)
    column names.
    """
    # Cells four times as wide as the search circle: most right rows touch one or two.
    lat_deg = max(math.degrees(metres / EARTH_M) * 8, 1e-6)
    cells = max(int(360.0 / lat_deg), 1)
    (l_lat, l_lon), (r_lat, r_lon) = ((F.col(a), F.col(b)) for a, b in (left_point, right_point))
    located = left.where(l_lat.isNotNull() & l_lon.isNotNull()).withColumns(
        {
            "_gy": F.floor(l_lat / F.lit(lat_deg)),
            "_gx": F.pmod(F.floor((l_lon + 180.0) / F.lit(360.0 / cells)), F.lit(cells)).cast("bigint"),
        }
    )
    copied = _cover(right.where(r_lat.isNotNull() & r_lon.isNotNull()), r_lat, r_lon, metres, cells, lat_deg)
    near = haversine_m(l_lat, l_lon, r_lat, r_lon) <= metres
    return interval_join(
        located, copied, ["_gy", "_gx"], left_ts, right_ts, seconds, seconds, extra=near
    ).drop("_gy", "_gx")


def nearest_in_time_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    right_id: str,
    seconds: float,
) -> DataFrame:
    """Each left row with the one right row closest in time, or NULLs; no fan-out.

    Ties go to the earlier reading, then to the smaller ``right_id``. Bounded
    inputs only. Work is linear in the input: the distinct times of both sides
    are merged in order per (key, bucket, slice of the bucket), carrying the
    last reading before and the first one after each time along; what a slice
    takes over from its neighbours comes from the first and last reading of
    every slice. So no task holds a whole key or bucket. Copies are reduced to
    one before they are shuffled.
    """
    width = bucket_width(seconds, seconds)
    r_cols = [c for c in right.columns if c not in keys]
    reading = F.struct(*(F.col(f"`{c}`") for c in r_cols))
    readings = (
        right.where(F.col(right_ts).isNotNull())
        .groupBy(*keys, right_ts)
        .agg(F.min_by(reading, F.col(right_id)).alias("_reading"))
    )
    piece = F.floor(micros(F.col("_t")) / F.lit(max(width // SLICES, 1))).alias("_slice")
    events = bucket_right(readings, right_ts, seconds, seconds).withColumn("_t", F.col(right_ts)).select(
        *keys, BUCKET, piece, "_t", F.lit(0).alias("_side"), "_reading"
    )
    asked = left.withColumn("_t", F.col(left_ts)).select(
        *keys, slot(F.col("_t"), width).alias(BUCKET), piece, "_t", F.lit(1).alias("_side")
    ).distinct()
    part = [*keys, BUCKET, "_slice"]
    ends = events.groupBy(*part).agg(F.min_by("_reading", "_t").alias("_first"), F.max_by("_reading", "_t").alias("_last"))
    empty = asked.select(*part).distinct().join(ends.select(*part), part, "left_anti")
    by_slice = Window.partitionBy(*keys, BUCKET).orderBy("_slice")
    carried = ends.unionByName(empty, allowMissingColumns=True).select(
        *part,
        F.last("_last", ignorenulls=True).over(by_slice.rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"),
        F.first("_first", ignorenulls=True).over(by_slice.rowsBetween(1, Window.unboundedFollowing)).alias("_later"),
    )
    by_time = Window.partitionBy(*part)
    so_far = (Window.unboundedPreceding, 0)
    back = by_time.orderBy(F.col("_t"), F.col("_side")).rowsBetween(*so_far)
    forth = by_time.orderBy(F.col("_t").desc(), F.col("_side")).rowsBetween(*so_far)
    inside = (
        events.unionByName(asked, allowMissingColumns=True)
        .withColumns(
            {
                "_prev": F.last("_reading", ignorenulls=True).over(back),
                "_next": F.last("_reading", ignorenulls=True).over(forth),
            }
        )
        .where(F.col("_side") == 1)
    )
    merged = inside.join(carried, part, "left").withColumns(
        {"_prev": F.coalesce("_prev", "_earlier"), "_next": F.coalesce("_next", "_later")}
    )
    t, limit = micros(F.col("_t")), F.lit(int(round(seconds * MICRO)))
    behind, ahead = (F.abs(micros(F.col(f"{c}.{right_ts}")) - t) for c in ("_prev", "_next"))
    prev_ok, next_ok = (F.coalesce(gap <= limit, F.lit(False)) for gap in (behind, ahead))
    best = F.when(prev_ok & (~next_ok | (behind <= ahead)), F.col("_prev")).when(next_ok, F.col("_next"))
    answers = merged.select(*(F.col(k).alias(f"_k_{k}") for k in keys), "_t", best.alias("_best"))
    same = F.col(left_ts) == F.col("_t")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_k_{k}"))
    return left.join(answers, same, "left").select(
        *(F.col(f"`{c}`") for c in left.columns), *(F.col(f"_best.{c}").alias(c) for c in r_cols)
    )


def latest_vs_earliest(df: DataFrame, ts: str, other: DataFrame, other_ts: str) -> DataFrame:
    """Latest time of one table beside the earliest of another, as a scalar subquery."""
    earliest = other.agg(F.min(other_ts).alias("v")).scalar()
    return df.agg(F.max(ts).alias("latest_traffic")).withColumn("earliest_aq", earliest)


def coverage_by_key(base: DataFrame, other: DataFrame, kinds: Mapping[str, Column], key: str, base_count: str) -> DataFrame:
    """Row counts of a base table per key beside those of another table, one per kind of its rows, missing ones as 0.

    Each table is read once and counted before the join.
    """
    out = base.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(base_count))
    counted = other.groupBy(key).agg(*(F.count_if(rule).alias(name) for name, rule in kinds.items()))
    return out.join(counted, key, "left").na.fill(0, list(kinds))
