"""Dashboard series as streams: windows over the business table, aggregated as rows come.

Each batch writes the windows that it has changed, whole, as a newer version;
the table is in parts by day and batch, so a repeated batch adds nothing. A
reader takes the newest version of each window. Windows stay open for ``delay``
behind the newest row: business rows without a match come late themselves.
The table may also hold counted rows (``plans.counted``): then it grows with
the traffic events and not with the pairs that they have.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pyspark.sql.types import StructType

from tidegrid.functions import stats
from tidegrid.plans import counted as c
from tidegrid.plans import reports
from tidegrid.plans.reports import REGION, TS
from tidegrid.schemas import BUSINESS
from tidegrid.sinks.parts import read_parts_stream, refuse_late_reader
from tidegrid.sinks.streams import checkpoint_path, write_daily

DELAY = "2 hours"
VERSION = "version"


@dataclass(frozen=True)
class Series:
    """A report by windows of ``width``; ``keys`` beside the time, and the values, of business rows and of counted ones."""

    width: str
    keys: tuple[str, ...]
    values: Callable[[], list[Column]]
    counted: Callable[[], list[Column]]


def _speed_and_pm25() -> list[Column]:
    return [F.avg("traffic_speed").alias("avg_speed"), F.avg("aq_pm25_ugm3").alias("avg_pm25")]


def _speed() -> list[Column]:
    return [F.avg("traffic_speed").alias("avg_speed")]


def _coverage() -> list[Column]:
    return [stats.pct(F.count("aq_pm25_ugm3"), F.count(F.lit(1)), None).alias("aq_join_coverage_percent")]


def _counted_speed() -> list[Column]:
    return [reports.mean_speed(None).alias("avg_speed")]


def _counted_speed_and_pm25() -> list[Column]:
    return [*_counted_speed(), reports.mean_pm25(None).alias("avg_pm25")]


def _counted_coverage() -> list[Column]:
    return [stats.pct(F.sum(c.AQ_ROWS), F.sum(c.ROWS), None).alias("aq_join_coverage_percent")]


#: The same series as ``reports.speed_pm25_by_minute``, ``region_speed_by_minute`` and ``coverage_hourly``.
SERIES = {
    "speed_pm25": Series("1 minute", (), _speed_and_pm25, _counted_speed_and_pm25),
    "region_speed": Series("1 minute", (REGION,), _speed, _counted_speed),
    "coverage_hourly": Series("1 hour", (), _coverage, _counted_coverage),
}


def windows(rows: DataFrame, series: Series, delay: str = DELAY) -> DataFrame:
    """The windows of a stream of business rows as they change, with the batch's time as version."""
    window = F.window(TS, series.width)
    values = series.counted() if c.ROWS in rows.columns else series.values()
    found = rows.withWatermark(TS, delay).groupBy(window, *series.keys).agg(*values)
    columns = [x for x in found.columns if x != "window"]
    return found.select(F.col("window.start").alias("time"), *columns, F.current_timestamp().alias(VERSION))


def report_path(out: str, name: str) -> str:
    return f"{out}/reports/{name}"


def start_report(
    spark: SparkSession, business: str, out: str, name: str, trigger: dict, delay: str = DELAY, version: int = 1,
    schema: StructType = BUSINESS,
) -> StreamingQuery:
    """The query that keeps up a series of ``SERIES`` over the business table in parts at ``business``; ``schema``: that of its rows."""
    checkpoint = checkpoint_path(out, f"report_{name}", version)
    refuse_late_reader(spark, business, checkpoint)
    rows = read_parts_stream(spark, business, schema)
    return write_daily(windows(rows, SERIES[name], delay), report_path(out, name), checkpoint, trigger, "time", f"report_{name}", mode="update")


def read_report(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The newest version of each window."""
    rows = spark.read.parquet(report_path(out, name))
    keys = ["time", *SERIES[name].keys]
    values = [c for c in rows.columns if c not in (*keys, VERSION, "event_date", "batch_id")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), VERSION).alias("_v"))
    return newest.select(*keys, "_v.*").orderBy(*keys)
