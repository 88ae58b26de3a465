"""Incremental load that also takes rows that arrive late.

``ingest.incremental`` takes what is later than its mark, so a row that arrives
with an older time is never taken. Here each poll reads back to a lateness
bound before the mark and leaves out what it has taken before. What was taken
stands in a ledger of row keys, partitioned by day, of which a poll reads the
days from the bound on only.

A poll lands its rows first, then its keys, then the mark, each in a folder of
its own number. A poll that was cut off has no mark; it is done again under the
same number and replaces what it left.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.times import interval, seconds
from tidegrid.sinks.parts import files, folders
from tidegrid.sources.tables import PARTITION

POLL = "poll"


@dataclass(frozen=True)
class LateLoad:
    """``folder``: of this load alone. ``keys`` identify a row; its time ``ts`` is one of them. ``arrived``: when a row
    came in, where the source says so; rows beyond the bound are then reported."""

    folder: str
    ts: str
    keys: tuple[str, ...]
    lateness: str = "1 day"
    arrived: str | None = None


@dataclass(frozen=True)
class Mark:
    poll: int
    ts: datetime | None
    arrived: datetime | None


_START = Mark(-1, None, None)
_MARKS = "poll int, ts timestamp, arrived timestamp"


def last_mark(spark: SparkSession, load: LateLoad) -> Mark:
    """The mark of the last poll that was completed."""
    if not folders(spark, f"{load.folder}/marks/{POLL}=*"):
        return _START
    r = spark.read.schema(_MARKS).parquet(f"{load.folder}/marks").agg(F.max(F.struct(POLL, "ts", "arrived"))).first()[0]
    return Mark(r[0], r[1], r[2])


def _key(load: LateLoad) -> Column:
    """128 bits of hash of the columns that identify a row."""
    columns = [F.col(f"`{c}`") for c in (*load.keys, load.ts)]
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit("key"), *columns).alias("b"))


def _floor(load: LateLoad, mark: Mark) -> Column:
    return F.lit(mark.ts) - interval(seconds(load.lateness))


def _taken(spark: SparkSession, load: LateLoad, mark: Mark) -> DataFrame:
    """Keys of the completed polls from the bound on; older days are not read."""
    ledger = spark.read.schema(f"_key struct<a: bigint, b: bigint>, _ts timestamp, {PARTITION} date, {POLL} int").parquet(f"{load.folder}/keys")
    floor = _floor(load, mark)
    days = F.col(PARTITION) >= floor.cast("date")
    return ledger.where(days & (F.col("_ts") >= floor) & (F.col(POLL) <= mark.poll)).select("_key")


def fresh_rows(source: DataFrame, load: LateLoad, mark: Mark) -> DataFrame:
    """What a poll after ``mark`` takes: rows from the bound on that no poll has taken; repeated rows once, rows without a time never."""
    rows = source.where(F.col(load.ts).isNotNull()).withColumn("_key", _key(load))
    if mark.ts is not None:
        rows = rows.where(F.col(load.ts) >= _floor(load, mark))
        rows = rows.join(_taken(source.sparkSession, load, mark), "_key", "left_anti")
    return rows.dropDuplicates(["_key"])


def too_late(source: DataFrame, load: LateLoad, mark: Mark) -> DataFrame:
    """Rows that arrived since the last poll with a time before the bound, which no poll takes any more."""
    if load.arrived is None:
        raise ValueError("the source does not say when its rows arrived")
    if mark.ts is None:
        return source.limit(0)
    new = F.col(load.arrived) > F.lit(mark.arrived)
    return source.where(new & (F.col(load.ts) < _floor(load, mark)))


def poll(source: DataFrame, load: LateLoad) -> DataFrame:
    """Takes what is fresh and returns it as it has been landed.

    Every row whose time is not before the bound when it is first there is
    taken exactly once, in whatever order rows arrive.
    """
    spark = source.sparkSession
    mark = last_mark(spark, load)
    number = mark.poll + 1
    fs, at = files(spark, load.folder)
    landed = f"{load.folder}/rows/{POLL}={number:06d}"
    fresh_rows(source, load, mark).write.mode("overwrite").parquet(landed)
    rows = spark.read.parquet(landed)
    for left in folders(spark, f"{load.folder}/keys/{PARTITION}=*/{POLL}={number:06d}"):
        fs.delete(at(left), True)
    keys = rows.select("_key", F.col(load.ts).alias("_ts"), F.col(load.ts).cast("date").alias(PARTITION), F.lit(f"{number:06d}").alias(POLL))
    keys.write.mode("append").partitionBy(PARTITION, POLL).parquet(f"{load.folder}/keys")
    arrived = F.max(load.arrived) if load.arrived else F.lit(None)
    seen = rows.agg(F.max(load.ts).alias("ts"), arrived.cast("timestamp").alias("arrived"))
    old = [F.lit(v).cast("timestamp") for v in (mark.ts, mark.arrived)]
    done = seen.select(*(F.greatest(F.col(c), o).alias(c) for c, o in zip(("ts", "arrived"), old, strict=True)))
    done.coalesce(1).write.mode("overwrite").parquet(f"{load.folder}/marks/{POLL}={number:06d}")
    return rows.drop("_key")


def loaded(spark: SparkSession, load: LateLoad) -> DataFrame:
    """The rows of all completed polls, with the number of their poll."""
    mark = last_mark(spark, load)
    return spark.read.parquet(f"{load.folder}/rows").where(F.col(POLL) <= mark.poll).drop("_key")


def forget(spark: SparkSession, load: LateLoad) -> int:
    """Removes the ledger's days before the bound, which no poll reads any more; returns how many folders."""
    mark = last_mark(spark, load)
    if mark.ts is None:
        return 0
    day = spark.range(1).select(_floor(load, mark).cast("date").cast("string")).first()[0]
    old = [f for f in folders(spark, f"{load.folder}/keys/{PARTITION}=*") if f.rsplit("=", 1)[1] < day]
    fs, at = files(spark, load.folder)
    for folder in old:
        fs.delete(at(folder), True)
    return len(old)
