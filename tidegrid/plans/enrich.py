"""Traffic with static flags, air quality and weather: the 34-column business rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.config import Settings
from tidegrid.functions import times
from tidegrid.operators.joins import enrich_lookup, interval_join
from tidegrid.operators.skew import find_hot
from tidegrid.operators.spatial import FLAGS
from tidegrid.operators.tables import thin_readings
from tidegrid.plans.refine import region_name
from tidegrid.schemas import BUSINESS

_TRAFFIC = {
    "id": "traffic_id", "status": "traffic_status", "speed": "traffic_speed",
    "travel_time": "traffic_travel_time", "link_name": "traffic_link_name",
    "borough": "traffic_borough", "from_street": "traffic_from_street", "to_street": "traffic_to_street",
}


def named_traffic(traffic: DataFrame) -> DataFrame:
    """Refined traffic under the column names of the business table."""
    return traffic.withColumnsRenamed(_TRAFFIC).drop(
        "data_as_of", "link_points", "encoded_poly_line", "first_link_point", "kafka_timestamp", "raw_payload"
    )


def with_static_flags(traffic: DataFrame, lookup: DataFrame) -> DataFrame:
    flagged = enrich_lookup(traffic, lookup, "h3_index", "h3_lookup_index", FLAGS)
    return flagged.withColumns(
        {"is_congestion_zone": F.col(FLAGS[0]), "is_truck_route": F.col(FLAGS[1])}
    )


def _against_skew(right: DataFrame, key: str, ts: str, seconds: int, salt: int | None, cfg: Settings) -> dict:
    """Streams are salted; on bounded tables hot right groups are looked up, which runs a job."""
    if right.isStreaming:
        return {"salt": salt or int(right.sparkSession.conf.get("spark.sql.shuffle.partitions"))}
    return {"hot": find_hot(right, [key], ts, seconds, seconds, cfg.skew)}


def thinned(readings: DataFrame, keys: list[str], ts: str, cfg: Settings, *tie: str) -> DataFrame:
    """One reading per key and time bin if ``cfg.thin_seconds`` is set: the first by time, in a stream the first to arrive.

    A stream remembers a reading for the watermark delay, so it refuses longer bins.
    """
    if cfg.thin_seconds is None:
        return readings
    if not readings.isStreaming:
        return thin_readings(readings, keys, ts, cfg.thin_seconds, *tie)
    if cfg.thin_seconds > times.seconds(cfg.watermark_delay):
        raise ValueError(f"bins of {cfg.thin_seconds} s are longer than the watermark delay of {cfg.watermark_delay}")
    binned = readings.withColumn("_bin", times.time_bin(F.col(ts), cfg.thin_seconds))
    return binned.dropDuplicatesWithinWatermark([*keys, "_bin"]).drop("_bin")


def with_air_quality(traffic: DataFrame, aq: DataFrame, cfg: Settings = Settings(), how: str = "left") -> DataFrame:
    seconds = cfg.aq_window_minutes * 60
    aq = thinned(aq, ["aq_source", "aq_location_id"], "aq_event_ts", cfg, "aq_pm25_ugm3")
    readings = aq.select(
        "h3_index", "aq_source", "aq_location_id", "aq_location_name", "aq_pm25_ugm3", "aq_temperature",
        "aq_humidity", "aq_event_ts",
    )
    return interval_join(
        traffic, readings, ["h3_index"], "traffic_event_ts", "aq_event_ts", seconds, seconds, how,
        **_against_skew(readings, "h3_index", "aq_event_ts", seconds, cfg.aq_salt, cfg),
    ).withColumn("has_aq_match", F.col("aq_pm25_ugm3").isNotNull())


def with_weather(traffic: DataFrame, weather: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """With the constant key each row meets the weather of all regions; ``region_key`` limits it to its own."""
    seconds = cfg.weather_window_minutes * 60
    weather = thinned(weather, ["weather_join_key", "weather_period_name"], "weather_event_ts", cfg, "weather_temperature")
    key = region_name(F.col("traffic_borough")) if cfg.region_key else F.lit(cfg.weather_key)
    joined = interval_join(
        traffic.withColumn("weather_join_key", key), weather, ["weather_join_key"],
        "traffic_event_ts", "weather_event_ts", seconds, seconds, "left",
        **_against_skew(weather, "weather_join_key", "weather_event_ts", seconds, cfg.weather_salt, cfg),
    )
    return joined.withColumn("has_weather_match", F.col("weather_event_ts").isNotNull()).drop("weather_join_key")


def enrich(
    traffic: DataFrame, aq: DataFrame, weather: DataFrame, lookup: DataFrame, cfg: Settings = Settings(),
) -> DataFrame:
    """Static flags, then air quality, then weather; unmatched traffic rows are kept throughout."""
    flagged = with_static_flags(named_traffic(traffic), lookup)
    aired = with_air_quality(flagged, aq, cfg)
    if aired.isStreaming:
        aired = aired.withColumn("aq_event_ts", times.shed_event_time(F.col("aq_event_ts")))
    return with_weather(aired, weather, cfg).select(*BUSINESS.fieldNames())
