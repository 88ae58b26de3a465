"""Reports from partial states: each part of the business table is aggregated once.

A state is what a report needs of a group of rows and what can be added up:
counts, sums, squares about the mean, smallest and largest values. States are kept per part
(day and batch) of the table. A refresh reads the parts that have no states yet,
and removes the states of parts that are gone; parts that upkeep has put
together or mended have new names, so their states are made anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.config import SPEED_BUCKETS
from tidegrid.functions import stats, text
from tidegrid.plans.reports import REGION, TS
from tidegrid.schemas import BUSINESS
from tidegrid.sinks.parts import add_parts, files, merged_name, part_schema, parts
from tidegrid.sources.tables import BATCH, PARTITION

KEYS = [REGION, "hour_of_day", "speed_bucket", "matched"]


@dataclass(frozen=True)
class Refreshed:
    """Parts whose states were made and removed, and the files that were read for it."""

    made: tuple[tuple[str, str], ...]
    removed: tuple[tuple[str, str], ...]
    files_read: tuple[str, ...]


def states(rows: DataFrame, *keys: str) -> DataFrame:
    """One row per group of the report keys; ``keys`` are added to them."""
    speed, pm25 = F.col("traffic_speed"), F.col("aq_pm25_ugm3")
    grouped = rows.groupBy(
        *keys, REGION, F.hour(TS).alias("hour_of_day"), text.bucketize(speed, SPEED_BUCKETS).alias("speed_bucket"), pm25.isNotNull().alias("matched")
    )
    return grouped.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("weather_temperature").alias("weather_rows"),
        F.count(speed).alias("speed_rows"), F.sum(speed).alias("speed_sum"),
        F.count(pm25).alias("pm25_rows"), F.sum(pm25).alias("pm25_sum"),
        (F.var_pop(pm25) * F.count(pm25)).alias("pm25_squares"),
        F.max("weather_temperature").alias("max_temp"),
        F.min(TS).alias("first_seen"), F.max(TS).alias("last_seen"),
    )


def refresh(spark: SparkSession, table: str, rollup: str) -> Refreshed:
    """Makes the states of new parts of ``table`` and removes those of parts that are gone."""
    return refresh_parts(spark, table, rollup, lambda rows: states(rows, PARTITION, BATCH))


def refresh_parts(spark: SparkSession, table: str, kept: str, make: Callable[[DataFrame], DataFrame]) -> Refreshed:
    """Brings ``kept`` up to date with the parts of ``table``: ``make`` turns rows of new parts into what is kept of them."""
    table, kept = table.rstrip("/"), kept.rstrip("/")
    there, have = set(parts(spark, table)), set(parts(spark, kept))
    made, removed = sorted(there - have), sorted(have - there)
    read: tuple[str, ...] = ()
    if made:
        folders = [f"{table}/{PARTITION}={d}/{BATCH}={b}" for d, b in made] if have else [table]
        rows = spark.read.schema(part_schema(BUSINESS)).option("basePath", table).parquet(*folders)
        read = tuple(rows.inputFiles())
        add_parts(make(rows), kept, merged_name())
    fs, at = files(spark, kept)
    for day, batch in removed:
        fs.delete(at(f"{kept}/{PARTITION}={day}/{BATCH}={batch}"), True)
    return Refreshed(tuple(made), tuple(removed), read)


def read_states(spark: SparkSession, rollup: str) -> DataFrame:
    return spark.read.parquet(rollup)


def _mean(what: str) -> F.Column:
    return F.try_divide(F.sum(f"{what}_sum"), F.sum(f"{what}_rows"))


def _rounded_mean(what: str) -> F.Column:
    return stats.rounded(_mean(what), 2)


def region_rollup(found: DataFrame, matched_only: bool = False) -> DataFrame:
    """As ``reports.region_rollup``."""
    rows = found.where("matched") if matched_only else found
    return rows.groupBy(REGION).agg(
        F.sum("rows").alias("total_records"), _rounded_mean("speed").alias("avg_speed_mph"), _rounded_mean("pm25").alias("avg_pm25"),
        F.max("max_temp").alias("max_temp"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
    ).orderBy("avg_speed_mph", REGION)


def match_pct(found: DataFrame, by: str | None = None) -> DataFrame:
    """As ``reports.match_pct``."""
    rows, aq, weather = F.sum("rows"), F.sum("pm25_rows"), F.sum("weather_rows")
    return found.groupBy(*([by] if by else [])).agg(
        rows.alias("total_rows"), aq.alias("aq_rows"), weather.alias("weather_rows"),
        stats.pct(aq, rows).alias("aq_match_pct"), stats.pct(weather, rows).alias("weather_match_pct"),
    )


def speed_buckets(found: DataFrame) -> DataFrame:
    """As ``reports.speed_buckets``: squares about the parts' means are brought to the common mean."""
    part_mean = F.try_divide(F.col("pm25_sum"), F.col("pm25_rows"))
    squares = F.sum(F.col("pm25_squares") + F.col("pm25_sum") * part_mean) - F.sum("pm25_sum") * _mean("pm25")
    spread = F.when(F.sum("pm25_rows") > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (F.sum("pm25_rows") - 1)))
    return found.where("matched").groupBy("speed_bucket").agg(
        F.sum("rows").alias("records"), _rounded_mean("pm25").alias("avg_pm25"), stats.rounded(spread, 2).alias("stddev_pm25")
    ).orderBy(F.col("avg_pm25").desc())


def region_hour(found: DataFrame) -> DataFrame:
    """As ``reports.region_hour``."""
    return found.where("matched").groupBy(REGION, "hour_of_day").agg(
        _rounded_mean("pm25").alias("avg_pm25"), _rounded_mean("speed").alias("avg_speed"), F.sum("rows").alias("records")
    ).orderBy(REGION, "hour_of_day")
