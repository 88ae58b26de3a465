"""Raw API responses to feed records."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.config import REGION_CENTRES, Box
from tidegrid.functions import text, times
from tidegrid.functions.geo import haversine_m, in_box
from tidegrid.functions.hexgrid import EARTH_M


def parameter_name(parameter: Column) -> Column:
    """The parameter comes as an object with a name, or as plain text."""
    return F.coalesce(F.get_json_object(parameter, "$.name"), parameter)


def normalize_openaq(locations: DataFrame, readings: DataFrame) -> DataFrame:
    """PM2.5 sensors of each location with the first reading of their response.

    ``locations``: location_id, location_name, latitude, longitude,
    sensors array<struct<id, parameter>>. ``readings``: sensor_id,
    results array<struct<value, utc, units>>. Rows may break the contract;
    see ``split_contract``.
    """
    sensors = (
        locations.select(
            "location_id",
            F.coalesce("location_name", F.lit("unknown")).alias("location_name"),
            text.number(F.col("latitude")).alias("lat"),
            text.number(F.col("longitude")).alias("lon"),
            F.explode("sensors").alias("sensor"),
        )
        .where(parameter_name(F.col("sensor.parameter")) == "pm25")
        .where(F.col("sensor.id").isNotNull())
        .withColumn("_sensor", F.col("sensor.id"))
    )
    first = readings.where(F.size("results") > 0).select(
        F.col("sensor_id").alias("_sensor"), F.get("results", F.lit(0)).alias("reading")
    )
    stamp = times.to_iso_utc(F.col("reading.utc"))
    pm25 = text.number(F.col("reading.value"))
    return sensors.join(first, "_sensor").select(
        F.col("_sensor").cast("string").alias("sensor_id"),
        F.lit("openaq").alias("source"),
        "lat",
        "lon",
        pm25.alias("pm25"),
        stamp.alias("timestamp"),
        F.col("location_id").cast("bigint").alias("location_id"),
        "location_name",
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        F.lit("pm25").alias("parameter"),
        pm25.alias("value"),
        F.col("reading.units").alias("unit"),
        stamp.alias("datetime_utc"),
    )


def rows_from_arrays(polls: DataFrame, fields: str = "fields", data: str = "data") -> DataFrame:
    """A response of column names and row arrays, as one ``record`` map per row.

    A repeated name keeps its first value; a NULL name is left out.
    """
    exploded = polls.withColumn("_row", F.explode(data))
    n = F.least(F.size(fields), F.size("_row"))
    pairs = F.arrays_zip(
        F.slice(fields, F.lit(1), n).alias("name"), F.slice("_row", F.lit(1), n).alias("value")
    )
    known = F.filter(pairs, lambda p, i: F.coalesce(F.array_position(fields, p["name"]) == i + 1, F.lit(False)))
    return exploded.withColumn("record", F.map_from_entries(known)).drop("_row", data, fields)


def normalize_purpleair(polls: DataFrame) -> DataFrame:
    """``polls``: fields array<string>, data array<array<string>>, fetched_at timestamp."""

    def field(name: str) -> Column:
        return F.try_element_at("record", F.lit(name))

    lat, lon = text.number(field("latitude")), text.number(field("longitude"))
    pm25 = text.number(field("pm2.5_10minute"))
    return rows_from_arrays(polls).select(
        field("sensor_index").alias("sensor_id"),
        F.lit("purpleair").alias("source"),
        lat.alias("lat"),
        lon.alias("lon"),
        pm25.alias("pm25"),
        F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        field("sensor_index").try_cast("bigint").alias("sensor_index"),
        field("name").alias("name"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        pm25.alias("pm2.5_10minute"),
        text.number(field("temperature")).alias("temperature"),
        text.number(field("humidity")).alias("humidity"),
    )


def normalize_weather(observations: DataFrame) -> DataFrame:
    """``observations``: borough, source_lat, source_lon, dt epoch seconds, temp,
    wind_speed, wind_deg, description. Current conditions: start equals end and
    the chance of rain is 0."""
    stamp = F.date_format(times.epoch_to_ts(F.col("dt")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return observations.select(
        F.col("borough").alias("name"),
        stamp.alias("startTime"),
        stamp.alias("endTime"),
        F.lit(True).alias("isDaytime"),
        # int cast truncates towards zero
        F.col("temp").try_cast("int").alias("temperature"),
        F.lit("F").alias("temperatureUnit"),
        F.concat(F.col("wind_speed").try_cast("int").cast("string"), F.lit(" mph")).alias("windSpeed"),
        text.compass(F.coalesce(F.col("wind_deg"), F.lit(0.0))).alias("windDirection"),
        F.col("description").alias("shortForecast"),
        F.struct(F.lit("wmoUnit:percent").alias("unitCode"), F.lit(0).alias("value")).alias(
            "probabilityOfPrecipitation"
        ),
        "borough",
        "source_lat",
        "source_lon",
    )


def with_message_key(df: DataFrame, *parts: Column) -> DataFrame:
    return df.withColumn("message_key", text.message_key(*parts))


def incremental(df: DataFrame, ts: str, mark: Column | None, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows later than the mark, one row with the next mark).

    With a ``limit`` the oldest fresh rows are taken, and all rows of the last
    time among them, so the next poll goes on exactly behind it: polled until
    nothing is new, every row with a time is taken once. The next mark is the
    largest time taken; it stays the old one when nothing is new.
    """
    fresh = df.where(F.col(ts).isNotNull() if mark is None else F.col(ts) > mark)
    batch = fresh
    if limit is not None:
        last = fresh.select(ts).orderBy(ts).limit(limit).agg(F.max(ts).alias("v")).scalar()
        batch = fresh.where(F.col(ts) <= last)
    old = F.lit(None) if mark is None else mark
    return batch, batch.agg(F.coalesce(F.max(ts), old).alias("next_mark"))


def within_bbox(df: DataFrame, lat: str, lon: str, box: Box) -> DataFrame:
    return df.where(in_box(F.col(lat), F.col(lon), box))


def within_radius(df: DataFrame, lat: str, lon: str, centre: tuple[float, float], metres: float) -> DataFrame:
    """Points within a great-circle radius; a latitude band is tested first, which the scan can push down."""
    c_lat, c_lon = centre
    reach = math.degrees(metres / EARTH_M) * 1.000001
    band = F.col(lat).between(c_lat - reach, c_lat + reach)
    exact = haversine_m(F.lit(c_lat), F.lit(c_lon), F.col(lat), F.col(lon)) <= metres
    return df.where(band & exact)


def regions_dim(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{name}', {lat}D, {lon}D)" for name, lat, lon in REGION_CENTRES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS region(name, lat, lon)")
