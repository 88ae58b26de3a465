"""Repair of what came too late for the stream's joins.

The joins drop rows behind their watermark. The refined tables have them all the
same, so nothing is lost for good: ``collect_late`` finds the rows that were too
late and keeps them in a side table, and ``repair`` enriches the days they touch
anew, as a batch, and swaps these days of the business table.

A row counts as late if it is behind the watermark that the files stored before
its own allow for: the least of the three feeds' largest times up to then, less
the delay. The stream's own watermark is never ahead of that, as a stream takes
files in the order in which they were stored; so each dropped row is found. A
row that is found without having been dropped costs work and changes nothing.
"""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.config import Settings
from tidegrid.functions.times import interval, seconds
from tidegrid.plans.enrich import enrich
from tidegrid.sinks.parts import add_parts, batch_name, files, folders, is_merged, merged_name, parts, run_of
from tidegrid.sinks.streams import checkpoint_path
from tidegrid.sources.tables import BATCH, PARTITION
from tidegrid.streaming.flow import REFINED, SCHEMA_VERSION, refined_path
from tidegrid.upkeep.tables import resume, swap_days


def late_path(out: str) -> str:
    return f"{out}/late"


def stored_watermark(spark: SparkSession, checkpoint: str) -> datetime | None:
    """The watermark of the last batch that a query has planned, from its checkpoint."""
    fs, at = files(spark, checkpoint)
    folder = at(f"{checkpoint}/offsets")
    if not fs.exists(folder):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    batches = [int(n) for n in names if n.isdigit()]
    if not batches:
        return None
    lines = [r[0] for r in spark.read.text(f"{checkpoint}/offsets/{max(batches)}").collect()]
    millis = next(json.loads(x)["batchWatermarkMs"] for x in lines if "batchWatermarkMs" in x)
    return datetime.fromtimestamp(millis / 1000, timezone.utc) if millis else None


def _uncommitted(spark: SparkSession, checkpoint: str, found: list[tuple[str, str]]) -> list[str]:
    """Batches of the query that have no commit yet: a restart repeats them."""
    fs, at = files(spark, checkpoint)
    commits = at(f"{checkpoint}/commits")
    names = [s.getPath().getName() for s in fs.listStatus(commits)] if fs.exists(commits) else []
    last = max((int(n) for n in names if n.isdigit()), default=-1)
    run = run_of(spark, checkpoint)
    return sorted({b for _, b in found if b > batch_name(run, last) and b.startswith(f"{run}-")})


def _files(spark: SparkSession, out: str, name: str) -> DataFrame:
    """``feed, file, stored, latest`` per file of a refined table: when it was stored and its largest event time."""
    ts = REFINED[name]
    rows = spark.read.parquet(refined_path(out, name)).select(
        F.col("_metadata.file_path").alias("file"),
        # What upkeep has put together was stored before anything that is live.
        F.when(~is_merged(), F.col("_metadata.file_modification_time")).alias("stored"), F.col(ts).alias("ts"),
    )
    return rows.groupBy("file", "stored").agg(F.max("ts").alias("latest")).withColumn("feed", F.lit(name))


def _bounds(spark: SparkSession, out: str, cfg: Settings) -> DataFrame:
    """``file, bound``: the watermark that the files stored before a file allow for. One row per file of the tables."""
    every = reduce(DataFrame.unionByName, (_files(spark, out, name) for name in REFINED))
    before = Window.orderBy(F.col("stored").asc_nulls_first()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = [F.max(F.when(F.col("feed") == name, F.col("latest"))).over(before) for name in REFINED]
    known = reduce(lambda a, b: a & b, (e.isNotNull() for e in earlier))
    bound = F.when(known, F.least(*earlier) - interval(seconds(cfg.watermark_delay)))
    # A live file's own rows count as well here: the bound is rather too high than too low.
    return every.select("feed", "file", "stored", bound.alias("bound")).where(F.col("stored").isNotNull())


def late_rows(spark: SparkSession, out: str, cfg: Settings = Settings()) -> DataFrame:
    """``feed, ts, event_date, batch_id`` of the rows of live parts that may have come too late; of batches not yet in the side table."""
    bounds = _bounds(spark, out, cfg)
    found = []
    for name, ts in REFINED.items():
        rows = spark.read.parquet(refined_path(out, name)).where(~is_merged())
        rows = rows.select(F.col("_metadata.file_path").alias("file"), F.col(ts).alias("ts"), PARTITION, BATCH)
        mine = bounds.where(F.col("feed") == name).select("feed", "file", "bound")
        found.append(rows.join(mine, "file").where(F.col("ts") < F.col("bound")).select("feed", "ts", PARTITION, F.concat(F.lit(f"{name}-"), BATCH).alias(BATCH)))
    return reduce(DataFrame.unionByName, found)


def collect_late(spark: SparkSession, out: str, cfg: Settings = Settings()) -> int:
    """Adds late rows to the side table, by day and batch; returns the number of new parts. Parts that are there stay."""
    before = len(parts(spark, late_path(out)))
    add_parts(late_rows(spark, out, cfg).select("feed", "ts", PARTITION, BATCH), late_path(out), "late")
    return len(parts(spark, late_path(out))) - before


def touched_days(spark: SparkSession, out: str, cfg: Settings = Settings()) -> list[tuple[date, list[str]]]:
    """Days of the business table that late rows touch, each with the side table's parts that say so."""
    if not parts(spark, late_path(out)):
        return []
    rows = spark.read.parquet(late_path(out))
    reach = {"traffic": 0, "air_quality": cfg.aq_window_minutes * 60, "weather": cfg.weather_window_minutes * 60}
    wide = reduce(lambda c, n: c.when(F.col("feed") == n, F.lit(timedelta(seconds=reach[n]))), reach, F.when(F.lit(False), F.lit(timedelta(0))))
    ends = F.explode(F.array_distinct(F.array((F.col("ts") - wide).cast("date"), (F.col("ts") + wide).cast("date")))).alias("day")
    part = F.concat_ws("/", F.col(PARTITION).cast("string"), BATCH)
    days = rows.select(ends, part.alias("part")).groupBy("day").agg(F.sort_array(F.collect_set("part")).alias("parts"))
    return [(r.day, r.parts) for r in days.orderBy("day").collect()]


def _done(spark: SparkSession, out: str) -> set[tuple[str, str]]:
    """(day, part of the side table) that were repaired."""
    if not folders(spark, f"{out}/repaired"):
        return set()
    return {(r.day, r.part) for r in spark.read.schema("day string, part string").parquet(f"{out}/repaired").collect()}


def repair(spark: SparkSession, out: str, lookup: DataFrame, cfg: Settings = Settings(), business: str | None = None) -> list[date]:
    """Enriches the closed days that late rows touch anew and swaps them in the business table; returns these days.

    A day is closed when the business query's watermark has passed its end and
    the windows of its joins, so the stream adds nothing to it any more; others
    wait for a later call. The rows of a batch that is not committed stay as
    they are (a restart repeats it), and their traffic rows are not enriched again.
    """
    business = business or f"{out}/business"
    checkpoint = checkpoint_path(out, "business", SCHEMA_VERSION)
    watermark = stored_watermark(spark, checkpoint)
    if watermark is None:
        return []
    resume(spark, business)
    done = _done(spark, out)
    wide = timedelta(minutes=cfg.aq_window_minutes + cfg.weather_window_minutes)
    todo = []
    for day, side in touched_days(spark, out, cfg):
        end = datetime(day.year, day.month, day.day, tzinfo=timezone.utc) + timedelta(days=1) + wide
        new = [p for p in side if (str(day), p) not in done]
        if new and end < watermark:
            todo.append((day, new))
    if not todo:
        return []
    days = [d for d, _ in todo]
    rows = _days_anew(spark, out, lookup, cfg, business, days, _uncommitted(spark, checkpoint, parts(spark, business)))
    swap_days(spark, business, rows, [str(d) for d in days], [PARTITION, BATCH])
    log = [(str(d), p) for d, side in todo for p in side]
    spark.createDataFrame(log, "day string, part string").coalesce(1).write.mode("append").parquet(f"{out}/repaired")
    return days


def _days_anew(spark: SparkSession, out: str, lookup: DataFrame, cfg: Settings, business: str, days: list[date], waiting: list[str]) -> DataFrame:
    """All rows of these days: enriched anew, but for those of the batches that are ``waiting`` for their commit."""
    table = spark.read.parquet(business)
    kept = table.where(F.col(PARTITION).isin(days) & F.col(BATCH).isin(waiting))

    def refined(name: str, near: list[date]) -> DataFrame:
        return spark.read.parquet(refined_path(out, name)).where(F.col(PARTITION).isin(near)).drop(PARTITION, BATCH)

    near = sorted({d + timedelta(days=k) for d in days for k in (-1, 0, 1)})
    theirs = kept.select(F.col("traffic_id").alias("id"), "traffic_event_ts").distinct()
    traffic = refined("traffic", days).join(theirs, ["id", "traffic_event_ts"], "left_anti")
    rows = enrich(traffic, refined("air_quality", near), refined("weather", near), lookup, cfg)
    anew = rows.withColumns({PARTITION: F.col("traffic_event_ts").cast("date"), BATCH: F.lit(merged_name())})
    return anew.select(table.columns).unionByName(kept)
