"""Parsed feeds to refined tables: typed, quality-filtered, with cell and watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.config import Settings
from tidegrid.functions import text, times
from tidegrid.functions.hexgrid import hex_cell
from tidegrid.operators.quality import aq_rules, keep_clean, not_in_future, traffic_rules
from tidegrid.operators.tables import union_contract


def _in_time(df: DataFrame, ts: str, cfg: Settings) -> DataFrame:
    if cfg.future_slack_seconds is None:
        return df
    return df.where(not_in_future(ts, "kafka_timestamp", cfg.future_slack_seconds))


def type_traffic(raw: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    lat, lon = text.first_point(F.col("link_points"))
    return raw.withColumns(
        {
            "speed": text.number(F.col("speed")),
            "travel_time": text.number(F.col("travel_time")),
            "first_link_point": F.trim(F.get(F.split("link_points", " "), F.lit(0))),
            "traffic_lat": lat,
            "traffic_lon": lon,
            "traffic_event_ts": times.local_to_utc(F.col("data_as_of"), cfg.local_zone),
        }
    )


def refine_traffic(raw: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """The box filter leaves only points that have a cell."""
    clean = _in_time(keep_clean(type_traffic(raw, cfg), traffic_rules(cfg)), "traffic_event_ts", cfg)
    cell = hex_cell(F.col("traffic_lat"), F.col("traffic_lon"), cfg.hex_edge_m, cfg, checked=True)
    return clean.withColumn("h3_index", cell).withWatermark("traffic_event_ts", cfg.watermark_delay)


def _aq(raw: DataFrame, source: str, ident, name, ts, lat, lon, pm25, temperature, humidity) -> DataFrame:
    return raw.select(
        text.or_default(F.col("source"), source).alias("aq_source"),
        ident.alias("aq_location_id"),
        name.alias("aq_location_name"),
        ts.alias("aq_event_ts"),
        "kafka_timestamp",
        lat.alias("aq_lat"),
        lon.alias("aq_lon"),
        pm25.alias("aq_pm25_ugm3"),
        temperature.cast("double").alias("aq_temperature"),
        humidity.cast("double").alias("aq_humidity"),
    )


def type_openaq(raw: DataFrame) -> DataFrame:
    return _aq(
        raw, "openaq",
        F.coalesce(F.col("sensor_id"), F.col("location_id").cast("string"), F.col("location_name")),
        F.col("location_name"),
        F.coalesce(times.instant(F.col("timestamp")), times.instant(F.col("datetime_utc"))),
        F.coalesce(F.col("lat"), F.col("latitude")),
        F.coalesce(F.col("lon"), F.col("longitude")),
        F.coalesce(F.col("pm25"), F.col("value")),
        F.lit(None), F.lit(None),
    )


def type_purpleair(raw: DataFrame) -> DataFrame:
    return _aq(
        raw, "purpleair",
        F.coalesce(F.col("sensor_id"), F.col("name")),
        F.col("name"),
        F.coalesce(times.instant(F.col("timestamp")), F.col("kafka_timestamp")),
        F.coalesce(F.col("lat"), F.col("latitude")),
        F.coalesce(F.col("lon"), F.col("longitude")),
        F.coalesce(F.col("pm25"), F.col("`pm2.5_10minute`")),
        F.col("temperature"), F.col("humidity"),
    )


def type_air_quality(openaq: DataFrame, purpleair: DataFrame) -> DataFrame:
    return union_contract(type_openaq(openaq), type_purpleair(purpleair))


def refine_air_quality(openaq: DataFrame, purpleair: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """One watermark, set after the union: a second one on the same stream is not allowed."""
    clean = _in_time(keep_clean(type_air_quality(openaq, purpleair), aq_rules(cfg)), "aq_event_ts", cfg)
    cell = hex_cell(F.col("aq_lat"), F.col("aq_lon"), cfg.hex_edge_m, cfg, checked=True)
    return clean.withColumn("h3_index", cell).withWatermark("aq_event_ts", cfg.watermark_delay)


def refine_weather(raw: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    key = region_name(F.col("borough")) if cfg.region_key else F.lit(cfg.weather_key)
    rain = F.col("probabilityOfPrecipitation.value").try_cast("int")
    seen = _in_time(raw.withColumn("weather_event_ts", times.instant(F.col("startTime"))), "weather_event_ts", cfg)
    return seen.select(
        "weather_event_ts",
        key.alias("weather_join_key"),
        text.or_default(F.col("name"), "Unknown").alias("weather_period_name"),
        F.col("temperature").try_cast("int").alias("weather_temperature"),
        text.or_default(F.col("temperatureUnit"), "F").alias("weather_temperature_unit"),
        text.or_default(text.first_int(F.col("windSpeed")), -1).alias("weather_wind_speed_mph"),
        text.or_default(F.col("windDirection"), "Unknown").alias("weather_wind_direction"),
        text.or_default(F.col("shortForecast"), "Unknown").alias("weather_short_forecast"),
        text.or_default(rain, 0).alias("weather_precip_probability"),
    ).where(F.col("weather_event_ts").isNotNull()).withWatermark("weather_event_ts", cfg.watermark_delay)


def region_name(borough) -> F.Column:
    return F.replace(F.lower(borough), F.lit(" "), F.lit("_"))
