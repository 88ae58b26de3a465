"""Named reports over the business table (and, where noted, over raw feeds).

Percentages and means count business *rows*, so a traffic event that met many
readings weighs more than an unmatched one. ``match_pct_by_event`` gives the
share of traffic events instead.

Reports that count, add up or take ends, spread and wind too, also take the
counted rows of ``plans.counted`` in place of the business rows, with the same
result; those on single readings or weather rows (samples) take business rows only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.config import SPEED_BUCKETS, WIND_BUCKETS
from tidegrid.functions import stats, text, times
from tidegrid.operators import joins, quality, tables
from tidegrid.plans import counted as c
from tidegrid.plans.counted import counted
from tidegrid.sources.tables import between, later_than

TS = "traffic_event_ts"
REGION = "traffic_borough"
CELL = "h3_index"
ZONE, ROUTE, SITE = "is_in_congestion_zone", "is_near_truck_route", "is_near_high_emission_bldg"
ALL = "All"



def _sum(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))


def _rows() -> Column:
    return _sum(c.ROWS)


def _matched(df: DataFrame) -> DataFrame:
    return c.matched(df)


def _mean(total: Column, n: Column, digits: int | None) -> Column:
    mean = F.try_divide(F.sum(total), F.sum(n))
    return mean if digits is None else stats.rounded(mean, digits)


def _of_event(name: str, digits: int | None = 2) -> Column:
    """Mean over business rows of a value that all rows of an event share."""
    return _mean(F.col(name) * F.col(c.ROWS), F.when(F.col(name).isNotNull(), F.col(c.ROWS)), digits)


def mean_speed(digits: int | None = 2) -> Column:
    """Mean speed over counted rows."""
    return _of_event("traffic_speed", digits)


def mean_pm25(digits: int | None = 2) -> Column:
    """Mean of the PM2.5 values over counted rows."""
    return _mean(F.col(c.PM25_TOTAL), F.col(c.AQ_ROWS), digits)


def _spread(rows: DataFrame, digits: int = 2) -> tuple[DataFrame, Column]:
    """Matched rows and the sample deviation of their PM2.5 values, as an aggregate; counted rows bring squares about their event's mean."""
    if c.PM25_SQUARES not in rows.columns:
        return rows, stats.sample_stddev("aq_pm25_ugm3", digits)
    n = F.col(c.AQ_ROWS)
    # About the mean of all, so that little is taken from the squares of a group.
    center = rows.agg(F.try_divide(F.sum(c.PM25_TOTAL), F.sum(n)).alias("v")).scalar()
    rows = rows.withColumn("_off", F.col(c.PM25_TOTAL) / n - center)
    off, total = n * F.col("_off"), F.sum(n)
    squares = F.sum(F.col(c.PM25_SQUARES) + off * F.col("_off")) - F.sum(off) * F.sum(off) / total
    return rows, F.when(total > 1, stats.rounded(F.sqrt(F.greatest(squares, F.lit(0.0)) / (total - 1)), digits))


def _aq_rows() -> Column:
    return _sum(c.AQ_ROWS)


def _weather_rows() -> Column:
    return _sum(c.WEATHER_ROWS)


def _rows_where(cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, F.col(c.ROWS))), F.lit(0))


def dashboard_filter(df: DataFrame, start: Column, end: Column, congestion: str = ALL, truck: str = ALL) -> DataFrame:
    """Time range and two switches, each ``All``, ``true`` or ``false``."""
    df = between(counted(df), TS, start, end)
    for flag, choice in ((ZONE, congestion), (ROUTE, truck)):
        if choice != ALL:
            df = df.where(F.col(flag).cast("string") == choice)
    return df


# Time series -----------------------------------------------------------------

def _by_minute(df: DataFrame, *keys: str, pm25: bool = True, digits: int | None = None) -> DataFrame:
    minute = times.time_bin(F.col(TS), 60).alias("time")
    values = [mean_speed(digits).alias("avg_speed")] + ([mean_pm25(digits).alias("avg_pm25")] if pm25 else [])
    return df.groupBy(minute, *keys).agg(*values).orderBy("time", *keys)


def speed_pm25_by_minute(df, start, end, congestion=ALL, truck=ALL, digits=None) -> DataFrame:
    return _by_minute(dashboard_filter(df, start, end, congestion, truck), digits=digits)


def region_speed_by_minute(df, start, end, congestion=ALL, truck=ALL, digits=None) -> DataFrame:
    return _by_minute(dashboard_filter(df, start, end, congestion, truck), REGION, pm25=False, digits=digits)


def matched_by_minute(df, start, end, congestion=ALL, truck=ALL, digits=None) -> DataFrame:
    return _by_minute(_matched(dashboard_filter(df, start, end, congestion, truck)), digits=digits)


def segment_by_minute(df, start, end, zone: bool, route: bool, digits=None) -> DataFrame:
    """Residential: neither flag. Highway: route only. Gridlock: both."""
    rows = between(_matched(df), TS, start, end)
    return _by_minute(rows.where((F.col(ZONE) == zone) & (F.col(ROUTE) == route)), digits=digits)


def coverage_hourly(df, start, end, digits=None) -> DataFrame:
    hour = times.time_bin(F.col(TS), 3600).alias("time")
    share = stats.pct(_aq_rows(), _rows(), digits).alias("aq_join_coverage_percent")
    return between(counted(df), TS, start, end).groupBy(hour).agg(share).orderBy("time")


def coverage_hourly_active(df: DataFrame) -> DataFrame:
    """Only hours with at least one match."""
    hour = times.time_bin(F.col(TS), 3600).alias("time_window")
    return (
        counted(df).groupBy(hour)
        .agg(stats.pct(_aq_rows(), _rows()).alias("aq_join_coverage_percent"), _aq_rows().alias("_n"))
        .where(F.col("_n") > 0)
        .drop("_n")
        .orderBy("time_window")
    )


def coverage_bins(df: DataFrame, as_of: Column, days: int = 5, seconds: int = 900) -> DataFrame:
    start = as_of - times.interval(days * 86400)
    return (
        later_than(counted(df), TS, start)
        .groupBy(times.time_bin(F.col(TS), seconds).alias("ts_15m"))
        .agg(
            _rows().alias("total_rows"),
            stats.pct(_aq_rows(), _rows()).alias("aq_match_pct"),
            stats.pct(_weather_rows(), _rows()).alias("weather_match_pct"),
        )
        .orderBy("ts_15m")
    )


def region_current(df: DataFrame, as_of: Column, minutes: int = 15) -> DataFrame:
    return (
        later_than(counted(df), TS, as_of - times.interval(minutes * 60))
        .groupBy(REGION)
        .agg(mean_speed(1).alias("avg_speed"), _rows().alias("sensor_count"))
    )


# Maps ------------------------------------------------------------------------

def map_points(df, start, end, congestion=ALL, truck=ALL, n: int | None = None) -> DataFrame:
    """Averages per time, region and place in that order; the first ``n`` where a dashboard asks for a limit."""
    rows = _matched(dashboard_filter(df, start, end, congestion, truck))
    keys = [F.col(TS).alias("time"), F.col(REGION), F.col("traffic_lat").alias("latitude"), F.col("traffic_lon").alias("longitude")]
    out = (
        rows.where(F.col("traffic_lat").isNotNull() & F.col("traffic_lon").isNotNull())
        .groupBy(*keys)
        .agg(mean_speed().alias("avg_speed"), mean_pm25().alias("avg_pm25"), _rows().alias("point_count"))
    )
    order = [F.col("time"), F.col(REGION), F.col("latitude"), F.col("longitude")]
    return out.orderBy(*order) if n is None else tables.top_n(out, n, *order)


def map_regions(df, start, end, congestion=ALL, truck=ALL) -> DataFrame:
    rows = _matched(dashboard_filter(df, start, end, congestion, truck))
    return (
        rows.where(F.col("traffic_lat").isNotNull() & F.col("traffic_lon").isNotNull())
        .groupBy(REGION)
        .agg(
            _of_event("traffic_lat", 6).alias("latitude"),
            _of_event("traffic_lon", 6).alias("longitude"),
            _rows().alias("rows"),
            mean_speed().alias("avg_speed"),
            mean_pm25().alias("avg_pm25"),
        )
    )


# Roll-ups --------------------------------------------------------------------

def latest(df: DataFrame, n: int = 10, *tie: str) -> DataFrame:
    columns = [TS, REGION, "traffic_speed", "aq_pm25_ugm3", "weather_temperature"]
    order = [F.col(TS).desc(), *(F.col(c) for c in tie)]
    return tables.top_n(df, n, *order).select(*columns)


def region_rollup(df: DataFrame, matched_only: bool = False) -> DataFrame:
    rows = _matched(df) if matched_only else counted(df)
    return (
        rows.groupBy(REGION)
        .agg(
            _rows().alias("total_records"),
            mean_speed().alias("avg_speed_mph"),
            mean_pm25().alias("avg_pm25"),
            F.max(c.TEMP_MAX).alias("max_temp"),
            F.min(TS).alias("first_seen"),
            F.max(TS).alias("last_seen"),
        )
        .orderBy("avg_speed_mph", REGION)
    )


def raw_by_region(raw: DataFrame, region: str = "borough") -> DataFrame:
    return raw.groupBy(region).agg(F.count(F.lit(1)).alias("rows_ingested"))


def coverage_by_region(raw: DataFrame, df: DataFrame) -> DataFrame:
    """Raw rows per region beside business rows and those with weather.

    ``traffic_aq_rows`` counts *all* business rows of the region, matched or
    not, so the percentages compare fan-out with raw rows and may exceed 100.
    """
    counts = joins.coverage_by_key(
        raw.withColumnRenamed("borough", REGION), df,
        {"traffic_aq_rows": F.lit(True), "traffic_aq_weather_rows": F.col("weather_temperature").isNotNull()},
        key=REGION, base_count="traffic_rows",
    )
    return counts.withColumns(
        {
            "aq_match_pct": stats.pct(F.col("traffic_aq_rows"), F.col("traffic_rows")),
            "aq_weather_match_pct": stats.pct(F.col("traffic_aq_weather_rows"), F.col("traffic_rows")),
        }
    ).orderBy(F.col("traffic_rows").desc(), REGION)


def arrival_span(feeds: dict[str, DataFrame]) -> DataFrame:
    spans = (
        df.agg(F.min("kafka_timestamp").alias("oldest"), F.max("kafka_timestamp").alias("newest"))
        .select(F.lit(name).alias("feed"), "oldest", "newest")
        for name, df in feeds.items()
    )
    return reduce(DataFrame.unionByName, spans)


def event_span(df: DataFrame) -> DataFrame:
    spans = [
        f(end).alias(f"{f.__name__}_{ts.split('_')[0]}")
        for ts in (TS, "aq_event_ts", "weather_event_ts")
        for f, end in zip((F.min, F.max), c.ENDS.get(ts, (ts, ts)), strict=True)
    ]
    return counted(df).agg(*spans, _rows().alias("total"))


def latest_traffic_vs_first_aq(df: DataFrame, raw_aq: DataFrame) -> DataFrame:
    return joins.latest_vs_earliest(df, TS, raw_aq, "kafka_timestamp")


def fanout(df: DataFrame, n: int = 20) -> DataFrame:
    counts = counted(df).groupBy(REGION, "traffic_id").agg(_rows().alias("aq_matches_per_traffic_row"))
    return tables.top_n(counts, n, F.col("aq_matches_per_traffic_row").desc(), F.col(REGION), F.col("traffic_id"))


def cell_rows(df: DataFrame, n: int = 10) -> DataFrame:
    counts = counted(df).groupBy(CELL).agg(_rows().alias("rows"))
    return tables.top_n(counts, n, F.col("rows").desc(), F.col(CELL))


def match_pct(df: DataFrame, by: str | None = None) -> DataFrame:
    return counted(df).groupBy(*([by] if by else [])).agg(
        _rows().alias("total_rows"),
        _aq_rows().alias("aq_rows"),
        _weather_rows().alias("weather_rows"),
        stats.pct(_aq_rows(), _rows()).alias("aq_match_pct"),
        stats.pct(_weather_rows(), _rows()).alias("weather_match_pct"),
    )


def match_pct_by_event(df: DataFrame, by: str = REGION) -> DataFrame:
    """Share of traffic events with at least one match, however many rows each has."""
    events = df.groupBy(by, "traffic_id", TS).agg(
        F.bool_or("has_aq_match").alias("aq"), F.bool_or("has_weather_match").alias("w")
    )
    return events.groupBy(by).agg(
        F.count(F.lit(1)).alias("traffic_events"),
        stats.pct_where(F.col("aq")).alias("aq_match_pct"),
        stats.pct_where(F.col("w")).alias("weather_match_pct"),
    )


# Profiles --------------------------------------------------------------------

def speed_buckets(df: DataFrame) -> DataFrame:
    rows, spread = _spread(_matched(df))
    return (
        rows.groupBy(text.bucketize(F.col("traffic_speed"), SPEED_BUCKETS).alias("speed_bucket"))
        .agg(
            _rows().alias("records"),
            mean_pm25().alias("avg_pm25"),
            spread.alias("stddev_pm25"),
        )
        .orderBy(F.col("avg_pm25").desc())
    )


def flag_segments(df: DataFrame) -> DataFrame:
    return (
        _matched(df)
        .groupBy(ZONE, ROUTE)
        .agg(_rows().alias("records"), mean_speed().alias("avg_speed"), mean_pm25().alias("avg_pm25"))
        .orderBy(F.col("avg_pm25").desc())
    )


def hour_pattern(df: DataFrame) -> DataFrame:
    return (
        _matched(df)
        .groupBy(F.hour(TS).alias("hour_of_day"))
        .agg(mean_speed().alias("avg_speed"), mean_pm25().alias("avg_pm25"), _rows().alias("records"))
        .orderBy("hour_of_day")
    )


def wind_buckets(df: DataFrame, known_only: bool = False) -> DataFrame:
    """Unknown wind is stored as -1 and falls into the calm bucket unless ``known_only``."""
    rows = c.by_wind(_matched(df))
    return (
        (rows.where(c.WIND_KNOWN) if known_only else rows).groupBy(c.WIND)
        .agg(mean_pm25().alias("avg_pm25"), mean_speed().alias("avg_speed"), _rows().alias("records"))
        .orderBy(F.col("avg_pm25").desc())
    )


def hot_slow_cells(df: DataFrame, max_speed: float = 15, n: int = 10) -> DataFrame:
    cells = (
        _matched(df)
        .where(F.col("traffic_speed") < max_speed)
        .groupBy(CELL, REGION)
        .agg(
            mean_speed().alias("avg_speed"),
            mean_pm25().alias("avg_pm25"),
            _rows().alias("records"),
            stats.any_true(ROUTE).cast("string").alias("on_truck_route"),
        )
    )
    return tables.top_n(cells, n, F.col("avg_pm25").desc(), F.col(CELL), F.col(REGION))


def health(df: DataFrame) -> DataFrame:
    return counted(df).agg(
        _rows().alias("total_enriched_records"),
        F.count_distinct(REGION).alias("boroughs_covered"),
        F.count_distinct(CELL).alias("unique_h3_cells"),
        stats.pct(_aq_rows(), _rows(), 1).alias("aq_join_pct"),
        stats.pct(_weather_rows(), _rows(), 1).alias("weather_join_pct"),
        F.min(TS).alias("pipeline_start"),
        F.max(TS).alias("pipeline_latest"),
    )


def region_hour(df: DataFrame) -> DataFrame:
    return (
        _matched(df)
        .groupBy(REGION, F.hour(TS).alias("hour_of_day"))
        .agg(mean_pm25().alias("avg_pm25"), mean_speed().alias("avg_speed"), _rows().alias("records"))
        .orderBy(REGION, "hour_of_day")
    )


def region_hour_pivot(df: DataFrame) -> DataFrame:
    """One column per hour of day, ``h0`` to ``h23``."""
    hours = _matched(df).select(REGION, F.concat(F.lit("h"), F.hour(TS).cast("string")).alias("h"), "aq_pm25_ugm3")
    return tables.pivot_mean(hours, REGION, "h", [f"h{i}" for i in range(24)], "aq_pm25_ugm3")


def confounder_uplift(df: DataFrame) -> DataFrame:
    """Mean PM2.5 per flag combination against rows with neither flag."""
    keys = [F.col(ZONE).cast("string").alias("in_congestion_zone"), F.col(ROUTE).cast("string").alias("near_truck_route")]
    out = tables.uplift(_matched(df), keys, ~F.col(ZONE) & ~F.col(ROUTE), "aq_pm25_ugm3")
    named = out.withColumnsRenamed({"avg_value": "avg_pm25", "uplift": "pm25_uplift_vs_baseline"})
    return named.orderBy(F.col("pm25_uplift_vs_baseline").desc())


def hotspot_persistence(df: DataFrame, as_of: Column, days: int = 5, rank: int = 10, n: int = 10) -> DataFrame:
    """Cells that are most often among the hourly top ``rank`` by mean PM2.5, with their main region."""
    recent = _matched(later_than(df, TS, as_of - times.interval(days * 86400)))
    hourly = recent.groupBy(times.time_bin(F.col(TS), 3600).alias("hour_bin"), CELL).agg(mean_pm25().alias("avg_pm25"))
    hot = (
        tables.top_per_group(hourly, ["hour_bin"], F.col("avg_pm25").desc(), rank)
        .groupBy(CELL)
        .agg(F.count(F.lit(1)).alias("top10_appearances"), stats.mean("avg_pm25").alias("mean_pm25_when_top10"))
    )
    main = tables.mode_per_group(recent, CELL, REGION, "dominant_borough_rows").withColumnRenamed(
        REGION, "dominant_borough"
    )
    out = hot.join(main, CELL, "left").select(
        CELL, "dominant_borough", "top10_appearances", "mean_pm25_when_top10", "dominant_borough_rows"
    )
    return tables.top_n(
        out, n, F.col("top10_appearances").desc(), F.col("mean_pm25_when_top10").desc(), F.col(CELL)
    )


# Checks ----------------------------------------------------------------------

def slices(df: DataFrame, start: Column, end: Column) -> DataFrame:
    return (
        between(counted(df), TS, start, end)
        .groupBy("is_congestion_zone", "is_truck_route")
        .agg(_rows().alias("rows"), _aq_rows().alias("pm25_rows"))
        .orderBy(F.col("rows").desc())
    )


def availability(df: DataFrame, start: Column, end: Column) -> DataFrame:
    return between(counted(df), TS, start, end).agg(_rows().alias("total_rows"), _aq_rows().alias("rows_with_pm25"))


def distinct_points(df: DataFrame) -> DataFrame:
    rows = _matched(df).where(F.col("traffic_lat").isNotNull() & F.col("traffic_lon").isNotNull())
    point = text.point_key(F.col("traffic_lat"), F.col("traffic_lon"))
    return (
        rows.groupBy(REGION)
        .agg(_rows().alias("rows_with_pm25"), F.count_distinct(point).alias("distinct_points_with_pm25"))
        .orderBy(F.col("rows_with_pm25").desc(), REGION)
    )


def acceptance(df: DataFrame) -> DataFrame:
    return counted(df).agg(
        _rows().alias("total_rows"),
        _aq_rows().alias("aq_match_rows"),
        _sum(c.MET_ROWS).alias("weather_match_rows"),
        _rows_where(F.col("is_congestion_zone")).alias("congestion_rows"),
        _rows_where(F.col("is_truck_route")).alias("truck_route_rows"),
        F.min(TS).alias("min_traffic_event_ts"),
        F.max(TS).alias("max_traffic_event_ts"),
    )


def acceptance_regions(df: DataFrame) -> DataFrame:
    return (
        counted(df).groupBy(REGION)
        .agg(
            _rows().alias("total_rows"),
            _aq_rows().alias("aq_rows"),
            _sum(c.MET_ROWS).alias("weather_rows"),
            _rows_where(F.col("is_congestion_zone")).alias("congestion_rows"),
            _rows_where(F.col("is_truck_route")).alias("truck_rows"),
            stats.pct(_aq_rows(), _rows()).alias("aq_match_pct"),
            stats.pct(_sum(c.MET_ROWS), _rows()).alias("weather_match_pct"),
        )
        .orderBy(F.col("total_rows").desc(), REGION)
    )


ACCEPTANCE_COLUMNS = (
    "traffic_id", REGION, CELL, "aq_pm25_ugm3", "weather_temperature", "is_congestion_zone", "is_truck_route",
    "has_aq_match", "has_weather_match", TS,
)


def acceptance_sample(df: DataFrame, n: int, *tie: str) -> DataFrame:
    return tables.recent_sample(df, TS, n, *tie).select(*ACCEPTANCE_COLUMNS)


def flag_distribution(df: DataFrame) -> DataFrame:
    counts = counted(df).groupBy("is_congestion_zone", "is_truck_route").agg(_rows().alias("rows"))
    return counts.orderBy(F.col("rows").desc())


def flag_sample(df: DataFrame, n: int, *tie: str) -> DataFrame:
    columns = ["traffic_id", REGION, CELL, "is_congestion_zone", "is_truck_route", TS]
    return tables.recent_sample(df, TS, n, *tie).select(*columns)


def lookup_summary(lookup: DataFrame) -> DataFrame:
    return lookup.agg(
        F.count(F.lit(1)).alias("h3_keys"),
        stats.rows_where(F.col(ZONE)).alias("congestion"),
        stats.rows_where(F.col(ROUTE)).alias("truck_route"),
        stats.rows_where(F.col(SITE)).alias("high_emission_bldg"),
    )


def freshness(df: DataFrame, as_of: Column) -> DataFrame:
    columns = (TS, "aq_event_ts", "weather_event_ts")
    ends = ((f, end, ts) for ts in columns for f, end in zip((F.min, F.max), c.ENDS.get(ts, (ts, ts)), strict=True))
    span = counted(df).agg(*(f(end).alias(f"{f.__name__}_{ts}") for f, end, ts in ends))
    return span.withColumns(
        {"now_ts": as_of, "traffic_max_lag_minutes": times.lag_minutes(F.col(f"max_{TS}"), as_of)}
    )


def in_window_sample(df: DataFrame, seconds: int, n: int, *tie: str) -> DataFrame:
    core = ["traffic_id", CELL, TS, "aq_event_ts", "traffic_speed", "aq_pm25_ugm3"]
    rows = df.na.drop(subset=core[1:]).where(quality.in_window(TS, "aq_event_ts", seconds))
    return tables.recent_sample(rows, TS, n, *tie).select(*core)


def weather_enriched(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["weather_event_ts", "weather_temperature", "weather_wind_speed_mph"])


def weather_enriched_count(df: DataFrame) -> DataFrame:
    if c.ROWS in df.columns:
        return df.agg(_sum(c.FULL_WEATHER_ROWS).alias("weather_enriched_rows"))
    return weather_enriched(df).agg(F.count(F.lit(1)).alias("weather_enriched_rows"))


def weather_sample(df: DataFrame, n: int, *tie: str) -> DataFrame:
    columns = ["traffic_id", TS, "weather_event_ts", "weather_temperature", "weather_wind_speed_mph", "weather_precip_probability"]
    return tables.recent_sample(weather_enriched(df), TS, n, *tie).select(*columns)
