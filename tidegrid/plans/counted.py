"""Business rows counted per traffic event instead of written out.

A traffic event has a business row for each pair of a reading and a weather row
in its windows, so the business table grows with the product of three feeds.
What most reports ask of it follows from the numbers and sums of the readings
and of the weather rows alone: the readings do not depend on the weather rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.config import WIND_BUCKETS, Settings
from tidegrid.functions.text import bucketize
from tidegrid.functions.times import micros, slot
from tidegrid.operators.skew import MICRO
from tidegrid.operators.spatial import FLAGS
from tidegrid.plans.enrich import enrich, named_traffic, thinned, with_air_quality, with_static_flags
from tidegrid.plans.refine import region_name

TS = "traffic_event_ts"
#: Business rows of an event; those with a PM2.5 value, with a weather row, with a temperature, with all of ``weather_enriched``.
ROWS, AQ_ROWS, MET_ROWS, WEATHER_ROWS, FULL_WEATHER_ROWS = "business_rows", "aq_rows_in", "met_rows_in", "weather_rows_in", "full_weather_rows_in"
#: Sums over business rows, and the ends of what they hold.
PM25_TOTAL, TEMP_MAX = "pm25_total", "temperature_max"
#: Squares of the PM2.5 values of counted rows about their event's mean.
PM25_SQUARES = "pm25_squares"
#: Of counted rows those with a PM2.5 value, by the wind that they met: an array of structs, see ``by_wind``.
WIND_ROWS, WIND, WIND_KNOWN = "wind_rows", "wind_category", "wind_known"
#: Winds that weather rows are counted by. Unknown wind is stored as -1, which is in the first bucket.
_WINDS = [*((label, True) for _, label in WIND_BUCKETS), (WIND_BUCKETS[0][1], False)]
ENDS = {"aq_event_ts": ("aq_first_ts", "aq_last_ts"), "weather_event_ts": ("weather_first_ts", "weather_last_ts")}

EVENT = [
    "traffic_id", "traffic_speed", "traffic_borough", TS, "traffic_lat", "traffic_lon", "h3_index", *FLAGS,
    "is_congestion_zone", "is_truck_route",
]


def _one(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def counted(df: DataFrame) -> DataFrame:
    """Plain business rows with the columns of ``event_counts``, each counted as one; counted rows as they are."""
    if ROWS in df.columns:
        return df
    temperature = F.col("weather_temperature").isNotNull()
    ends = {name: F.col(ts) for ts, names in ENDS.items() for name in names}
    return df.withColumns(
        {
            ROWS: F.lit(1).cast("bigint"), AQ_ROWS: _one(F.col("aq_pm25_ugm3").isNotNull()),
            MET_ROWS: _one(F.col("has_weather_match")), WEATHER_ROWS: _one(temperature),
            PM25_TOTAL: F.col("aq_pm25_ugm3"), TEMP_MAX: F.col("weather_temperature"), **ends,
        }
    )


def matched(df: DataFrame) -> DataFrame:
    """Only business rows with a PM2.5 value, plain or counted."""
    if ROWS not in df.columns:
        return counted(df.where(F.col("aq_pm25_ugm3").isNotNull()))
    # What is known of the weather counts rows without a value too.
    return df.where(F.col(AQ_ROWS) > 0).withColumn(ROWS, F.col(AQ_ROWS)).drop(MET_ROWS, WEATHER_ROWS, FULL_WEATHER_ROWS)


def _wind() -> tuple[Column, Column]:
    """The bucket of a weather row's wind, and whether it is known."""
    wind = F.col("weather_wind_speed_mph")
    return bucketize(wind, WIND_BUCKETS), wind >= 0


def by_wind(df: DataFrame) -> DataFrame:
    """Matched rows, plain or counted, that have a wind, each with its bucket and whether it is known."""
    if WIND_ROWS in df.columns:
        return df.select("traffic_speed", F.inline(WIND_ROWS))
    bucket, known = _wind()
    return df.where(F.col("weather_wind_speed_mph").isNotNull()).withColumns({WIND: bucket, WIND_KNOWN: known})


def _met(
    events: DataFrame, readings: DataFrame, key: str, ts: str, minutes: int, sums: Mapping[str, Column], tops: Mapping[str, Column] = {},
) -> DataFrame:
    """``events`` with the statistics of the readings in their windows; NULL where a window has none.

    ``sums`` are aggregates that add up over parts of a window, ``tops`` those of
    which the largest counts; the first of ``sums`` counts readings. Events and
    readings are never paired: with slots of half the window's width, a window
    is the end of the slot before the event's, that slot, and the beginning of
    the one behind it. So three running aggregates per event suffice, over the
    distinct times of a key and slot, and the work grows with the feeds.
    """
    half = minutes * 60 * MICRO
    first, last = ENDS[ts]
    tops = {**tops, last: F.max(ts)}
    total = {**{c: F.sum(c) for c in sums}, **{c: F.max(c) for c in tops}, first: F.min(first)}
    time = micros(F.col(ts))
    met = readings.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(key, ts)
    met = met.agg(*(c.alias(n) for n, c in {**sums, **tops, first: F.min(ts)}.items()))
    # Forward a slot is summed up from its beginning, backward (negative times) from its end.
    sides = F.inline(F.array(*(F.struct(F.lit(d).alias("_back"), (-time if d else time).alias("_at")) for d in (False, True))))
    met = met.select(key, slot(F.col(ts), half).alias("_slot"), F.lit(False).alias("_asks"), F.lit(None).cast("timestamp").alias(TS), *total, sides)
    asked = events.where(F.col(key).isNotNull() & F.col(TS).isNotNull()).select(key, TS).distinct()
    at, own = micros(F.col(TS)), slot(F.col(TS), half)
    parts = ((own - 1, True, F.lit(half) - at), (own, False, (own + 1) * half), (own + 1, False, at + half))
    names = ("_slot", "_back", "_at")
    parts = F.inline(F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, part, strict=True))) for part in parts)))
    asked = asked.select(key, F.lit(True).alias("_asks"), TS, parts)
    # Readings of the same time come before what is asked: windows hold both their ends.
    running = Window.partitionBy(key, "_slot", "_back").orderBy("_at", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    both = met.unionByName(asked, allowMissingColumns=True)
    found = both.select(key, "_asks", TS, *(c.over(running).alias(n) for n, c in total.items())).where("_asks")
    found = found.groupBy(key, TS).agg(*(c.alias(n) for n, c in total.items())).where(F.col(next(iter(sums))).isNotNull())
    return events.join(found, [key, TS], "left")


def event_counts(traffic: DataFrame, aq: DataFrame, weather: DataFrame, lookup: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """The rows of ``enrich``, counted per traffic event; equal events are one row. Bounded tables only."""
    events = with_static_flags(named_traffic(traffic), lookup).groupBy(*EVENT).agg(F.count(F.lit(1)).alias("_copies"))
    aq = thinned(aq, ["aq_source", "aq_location_id"], "aq_event_ts", cfg, "aq_pm25_ugm3").select("h3_index", "aq_event_ts", "aq_pm25_ugm3")
    # Squares are summed up about the mean of all, so that they do not lose what sets the values apart.
    aq = aq.withColumn("_off", F.col("aq_pm25_ugm3") - aq.agg(F.avg("aq_pm25_ugm3").alias("v")).scalar())
    weather = thinned(weather, ["weather_join_key", "weather_period_name"], "weather_event_ts", cfg, "weather_temperature")
    weather = weather.select("weather_join_key", "weather_event_ts", "weather_temperature", "weather_wind_speed_mph")
    key = region_name(F.col("traffic_borough")) if cfg.region_key else F.lit(cfg.weather_key)
    temperature, wind = F.col("weather_temperature").isNotNull(), F.col("weather_wind_speed_mph").isNotNull()
    bucket, known = _wind()
    winds = {f"_wind{i}": F.count_if((bucket == label) & (known == sure)) for i, (label, sure) in enumerate(_WINDS)}
    events = _met(
        events, aq, "h3_index", "aq_event_ts", cfg.aq_window_minutes,
        {
            "_a": F.count(F.lit(1)), "_pm25s": F.count("aq_pm25_ugm3"), "_pm25": F.sum("aq_pm25_ugm3"),
            "_offs": F.sum("_off"), "_squares": F.sum(F.col("_off") * F.col("_off")),
        },
    )
    events = _met(
        events.withColumn("weather_join_key", key), weather, "weather_join_key", "weather_event_ts", cfg.weather_window_minutes,
        {"_w": F.count(F.lit(1)), "_temps": F.count("weather_temperature"), "_full": F.count_if(temperature & wind), **winds},
        {TEMP_MAX: F.max("weather_temperature")},
    )
    copies, none = F.col("_copies"), F.lit(0)
    a, w = (F.greatest(F.coalesce(F.col(c), none), F.lit(1)) for c in ("_a", "_w"))
    squares = F.greatest(F.col("_squares") - F.col("_offs") * F.col("_offs") / F.col("_pm25s"), F.lit(0.0))
    by = [
        F.struct(
            F.lit(label).alias(WIND), F.lit(sure).alias(WIND_KNOWN), *((copies * F.col("_pm25s") * F.col(f"_wind{i}")).alias(n) for n in (ROWS, AQ_ROWS)),
            (F.col("_pm25") * copies * F.col(f"_wind{i}")).alias(PM25_TOTAL),
        )
        for i, (label, sure) in enumerate(_WINDS)
    ]
    return events.select(
        *EVENT, (copies * a * w).alias(ROWS), (copies * F.coalesce("_pm25s", none) * w).alias(AQ_ROWS),
        (copies * F.coalesce("_w", none) * a).alias(MET_ROWS), (copies * F.coalesce("_temps", none) * a).alias(WEATHER_ROWS),
        (copies * F.coalesce("_full", none) * a).alias(FULL_WEATHER_ROWS), (F.col("_pm25") * copies * w).alias(PM25_TOTAL), TEMP_MAX,
        F.when(F.col("_pm25s") > 0, squares * copies * w).alias(PM25_SQUARES), F.filter(F.array(*by), lambda x: x[ROWS] > 0).alias(WIND_ROWS),
        F.coalesce(F.col("_pm25s") > 0, F.lit(False)).alias("has_aq_match"), F.col("_w").isNotNull().alias("has_weather_match"),
        *(name for names in ENDS.values() for name in names),
    )


def reading_rows(traffic: DataFrame, aq: DataFrame, weather: DataFrame, lookup: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """The rows of ``enrich`` counted per traffic event and reading: each pair that it joins stands once, with its number of rows. Bounded tables only."""
    key = region_name(F.col("traffic_borough")) if cfg.region_key else F.lit(cfg.weather_key)
    weather = thinned(weather, ["weather_join_key", "weather_period_name"], "weather_event_ts", cfg, "weather_temperature")
    events = with_static_flags(named_traffic(traffic), lookup).withColumn("weather_join_key", key)
    events = _met(events, weather, "weather_join_key", "weather_event_ts", cfg.weather_window_minutes, {"_w": F.count(F.lit(1))})
    events = events.select("traffic_id", TS, "h3_index", F.greatest(F.coalesce("_w", F.lit(0)), F.lit(1)).cast("bigint").alias(ROWS))
    return with_air_quality(events, aq, cfg)


def recent_rows(
    events: DataFrame, n: int, traffic: DataFrame, aq: DataFrame, weather: DataFrame, lookup: DataFrame, cfg: Settings = Settings(),
) -> DataFrame:
    """The business rows since the ``n``-th most recent of ``events``, among them the ``n`` most recent rows of these events.

    ``events``: counted rows, those that have a row which the asker takes. Looks the time up, which runs a job.
    """
    since = events.select(TS).orderBy(F.col(TS).desc()).limit(n).agg(F.min(TS).alias("v")).first()["v"]
    recent = traffic.where(F.lit(False)) if since is None else traffic.where(F.col(TS) >= F.lit(since))
    return enrich(recent, aq, weather, lookup, cfg)
