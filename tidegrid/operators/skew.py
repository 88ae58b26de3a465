"""Cutting hot join groups into parts.

Spark's adaptive execution splits skewed shuffle partitions of inner joins on
both sides, and of left outer joins on the left side. What it cannot split is
the **right side of a left outer join**: a left row would come out unmatched
once per part. ``find_hot`` lists such groups, and ``interval_join`` cuts them
exactly.

Rows are put into parts by a hash of their content, not at random: a recomputed
task puts each row where it was before, so a lost executor cannot lose or repeat
rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.config import Skew
from tidegrid.functions.times import interval, micros, slot
from tidegrid.session import work_dir

LEFT_PART, RIGHT_PART, BUCKET = "_part_l", "_part_r", "_bucket"
MICRO = 1_000_000


def row_part(df: DataFrame, parts: Column) -> Column:
    return F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)), parts).cast("int")


def copies(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), parts - 1))


def bucket_width(before: float, after: float) -> int:
    """Width of a time bucket in microseconds: the whole window."""
    width = int(round((before + after) * MICRO))
    if width <= 0:
        raise ValueError("the window must have a positive width")
    return width


def bucket_right(right: DataFrame, right_ts: str, before: float, after: float) -> DataFrame:
    """Right rows copied to the (at most two) buckets whose left rows they can reach."""
    width = bucket_width(before, after)
    first = slot(F.col(right_ts) - interval(after), width)
    last = slot(F.col(right_ts) + interval(before), width)
    return right.withColumn(BUCKET, F.explode(F.sequence(first, last)))


@dataclass(frozen=True)
class HotGroups:
    """A stored table: key columns, bucket, number of parts, and time spans of the right rows."""

    table: DataFrame


def find_hot(
    right: DataFrame, keys: Sequence[str], right_ts: str, before: float, after: float, skew: Skew = Skew()
) -> HotGroups | None:
    """Right groups (key, bucket) of more than ``skew.hot_rows`` rows, stored; None if there are none.

    Runs one job that counts, combined on the map side, and where groups are
    found a second one over the rows of these groups alone. However many they
    are, all of them are listed.
    """
    width = bucket_width(before, after)
    bucketed = bucket_right(right.select(*keys, right_ts), right_ts, before, after)
    counted = bucketed.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > skew.hot_rows)
    found = right.sparkSession.read.schema(counted.schema).parquet(_written(counted, "hot-groups"))
    if found.isEmpty():
        return None
    half = max(width // 2, 1)
    time = micros(F.col(right_ts))
    start = F.col(BUCKET) * F.lit(width) - F.lit(int(round(before * MICRO)))
    place = F.floor((time - start) / F.lit(half))
    spans = range(-(-2 * width // half) + 1)
    listed = (
        bucketed.join(found, [*keys, BUCKET])
        .groupBy(*keys, BUCKET, "_n")
        .agg(
            *(F.min(F.when(place == i, time)).alias(f"_lo{i}") for i in spans),
            *(F.max(F.when(place == i, time)).alias(f"_hi{i}") for i in spans),
        )
        .select(
            *keys,
            BUCKET,
            F.ceil(F.col("_n") / F.lit(skew.hot_rows)).cast("int").alias("_parts"),
            F.array(*(F.struct(F.col(f"_lo{i}").alias("lo"), F.col(f"_hi{i}").alias("hi")) for i in spans)).alias("_spans"),
        )
    )
    return HotGroups(right.sparkSession.read.schema(listed.schema).parquet(_written(listed, "hot-spans")))


def _written(df: DataFrame, name: str) -> str:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return path


def _cut_right(right: DataFrame, keys: Sequence[str], hot: HotGroups) -> DataFrame:
    """Right rows with their part, and in ``_times`` how many equal rows each stands for.

    Equal rows have equal hashes and would all fall into one part. They are
    counted first, which Spark combines on the map side, and their number is
    divided among the parts; the copies come back after the join.
    """
    columns = right.columns
    marked = right.join(hot.table.drop("_spans"), list(keys), "left")
    cold = marked.where(F.col("_parts").isNull()).select(
        *columns, F.lit(0).alias(RIGHT_PART), F.lit(1).cast("bigint").alias("_times")
    )
    counted = marked.where(F.col("_parts").isNotNull()).groupBy(*columns, "_parts").agg(F.count(F.lit(1)).alias("_n"))
    used = F.least(F.col("_parts"), F.col("_n")).cast("int")
    own = F.pmod(F.xxhash64(*columns), F.col("_parts")).cast("int")
    parts = F.when(F.col("_n") == 1, F.array(own)).otherwise(F.sequence(F.lit(0), used - 1))
    share = F.floor(F.col("_n") / used) + (F.col(RIGHT_PART) < F.col("_n") % used).cast("bigint")
    times = F.when(F.col("_n") == 1, F.lit(1)).otherwise(share).cast("bigint")
    cut = counted.withColumn(RIGHT_PART, F.explode(parts)).withColumn("_times", times)
    return cold.unionByName(cut.select(*columns, RIGHT_PART, "_times"))


def cut_outer(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, before: float, after: float, hot: HotGroups
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a left outer join with a part column; ``finish_cut`` completes the result.

    Left rows of a cut group go to every part if they match at all, else to one
    part only. Whether they match is known beforehand: spans half as wide as the
    window hold their smallest and largest right time, and a span has a match
    exactly if its largest time is not before and its smallest not after the
    row's window, because no span can hold both ends of the window.
    """
    lo, hi = micros(F.col(left_ts) - interval(before)), micros(F.col(left_ts) + interval(after))
    matches = F.coalesce(F.exists("_spans", lambda s: (s["hi"] >= lo) & (s["lo"] <= hi)), F.lit(False))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    left = (
        left.join(hot.table, list(keys), "left")
        .withColumn("_everywhere", (parts > 1) & matches)
        .withColumn(RIGHT_PART, copies(F.when(F.col("_everywhere"), parts).otherwise(F.lit(1))))
        .drop("_parts", "_spans")
    )
    return left, _cut_right(right, keys, hot)


def finish_cut(joined: DataFrame) -> DataFrame:
    """Drops the misses of rows that matched in another part, and brings equal rows back."""
    kept = joined.where(F.col("_times").isNotNull() | ~F.col("_everywhere"))
    copies_of = F.sequence(F.lit(1).cast("bigint"), F.coalesce(F.col("_times"), F.lit(1)))
    return kept.withColumn("_times", F.explode(copies_of))
