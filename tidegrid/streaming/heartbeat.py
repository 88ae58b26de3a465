"""Heartbeats that move the event time of a silent feed on.

The watermark of a join is the least of its inputs', so one silent feed holds
back every unmatched row. A heartbeat is a row with nothing but a time and a
join key that no real row has; it is put to the feed's rows before the
watermark. Its time is that of a clock less ``hold``: a feed that sends again
within ``hold`` loses nothing, as its rows are not behind its own heartbeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.times import interval, seconds

MARK = "heartbeat"


def rate_clock(spark: SparkSession, every: str = "30 seconds") -> DataFrame:
    """A stream of the present time in ``timestamp``: one row a second, thinned to one per ``every``."""
    rows = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return rows.where(F.pmod(F.col("value"), F.lit(seconds(every))) == 0).select("timestamp")


def with_heartbeat(rows: DataFrame, clock: DataFrame, ts: str, hold: str, marks: dict[str, str]) -> DataFrame:
    """``rows`` and the beats of ``clock`` (timestamp), which have ``ts``, the columns of ``marks`` and NULL elsewhere.

    ``rows`` must not have a watermark yet. Among ``marks`` must be the join
    keys: a NULL key would be taken out below the watermark.
    """
    beats = clock.select((F.col("timestamp") - interval(seconds(hold))).alias(ts))
    # A batch may have beats only. Its plan must not take the marks for constants that are never NULL: joins keep rows
    # of other batches in their state, and read them by the plan of this one.
    beating = F.unix_timestamp(ts) > F.lit(0)

    def value(name: str) -> Column:
        return F.col(ts) if name == ts else F.when(beating, F.lit(marks.get(name)))

    fields = [value(f.name).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    return rows.unionByName(beats.select(*fields))


def kept_above(rows: DataFrame, ts: str, *keys: str) -> DataFrame:
    """``rows`` behind their watermark, with join keys that name the event time.

    A join infers conditions on its keys and takes them down its inputs, where
    they would remove the beats below the watermark, before they count.
    """
    return rows.withColumns({k: F.when(F.col(ts).isNotNull(), F.col(k)) for k in keys})


def without_heartbeat(rows: DataFrame, column: str, ts: str) -> DataFrame:
    """``rows`` without the beats.

    The condition names the event time as well, so that the optimizer does not
    take it below the watermark, where the beats would go before they count.
    """
    return rows.where((F.coalesce(F.col(column), F.lit("")) != MARK) | F.col(ts).isNull())
