"""Declared schemas of the four feeds and of the business table."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

# Parsing a DDL text needs a running session; schemas must exist without one.
_TYPES = {
    "string": StringType(), "double": DoubleType(), "bigint": LongType(), "int": IntegerType(),
    "boolean": BooleanType(), "timestamp": TimestampType(),
    "rain": StructType([StructField("unitCode", StringType()), StructField("value", StringType())]),
}


def _schema(columns: str) -> StructType:
    pairs = (c.split() for c in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# Field names and types of the feeds and of the business table.
TRAFFIC = _schema(
    "id string, status string, speed string, travel_time string, link_name string, borough string,"
    " from_street string, to_street string, data_as_of string, link_points string, encoded_poly_line string"
)

OPENAQ = _schema(
    "sensor_id string, source string, lat double, lon double, pm25 double, timestamp string,"
    " location_id bigint, location_name string, latitude double, longitude double,"
    " parameter string, value double, unit string, datetime_utc string"
)

PURPLEAIR = _schema(
    "sensor_id string, source string, lat double, lon double, pm25 double, timestamp string,"
    " sensor_index bigint, name string, latitude double, longitude double,"
    " pm2.5_10minute double, temperature double, humidity double"
)

# The region and source point are sent by the feed; the default join ignores them.
WEATHER = _schema(
    "number string, name string, startTime string, endTime string, isDaytime boolean,"
    " temperature string, temperatureUnit string, temperatureTrend string, windSpeed string,"
    " windDirection string, shortForecast string, detailedForecast string,"
    " probabilityOfPrecipitation rain,"
    " borough string, source_lat double, source_lon double"
)

FEEDS = {"traffic": TRAFFIC, "openaq": OPENAQ, "purpleair": PURPLEAIR, "weather": WEATHER}

TOPIC = _schema("value string, timestamp timestamp, topic string")

BUSINESS = _schema(
    "traffic_id string, traffic_status string, traffic_speed double, traffic_travel_time double,"
    " traffic_link_name string, traffic_borough string, traffic_from_street string,"
    " traffic_to_street string, traffic_event_ts timestamp, traffic_lat double, traffic_lon double,"
    " h3_index string, is_in_congestion_zone boolean, is_near_truck_route boolean,"
    " is_near_high_emission_bldg boolean, is_congestion_zone boolean, is_truck_route boolean,"
    " aq_source string, aq_location_id string, aq_location_name string, aq_pm25_ugm3 double,"
    " aq_temperature double, aq_humidity double, aq_event_ts timestamp, has_aq_match boolean,"
    " weather_period_name string, weather_temperature int, weather_temperature_unit string,"
    " weather_wind_speed_mph int, weather_wind_direction string, weather_short_forecast string,"
    " weather_precip_probability int, weather_event_ts timestamp, has_weather_match boolean"
)
