"""Runs of unchanged readings, and the join of points in time with intervals.

Feeds send a value again and again while it does not change, and each copy
multiplies what it is joined to. A run is one row ``[from, to]`` for consecutive
readings of a key with equal values and no gap longer than allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.times import interval, micros, slot
from tidegrid.operators.skew import BUCKET, bucket_width

FROM, TO, READINGS = "run_from", "run_to", "readings"
_DAY = 86_400


def _islands(df: DataFrame, by: list[str], values: Sequence[str], start: str, end: str, n: Column, gap: float) -> DataFrame:
    """Neighbouring rows of ``by`` with equal values become one where the next starts at most ``gap`` seconds behind the end.

    The end is the largest one so far; of rows with the same start the order is that of their values.
    """
    order = Window.partitionBy(*by).orderBy(start, *values, end)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    same = F.lit(True)
    for v in values:
        same = same & F.lag(v).over(order).eqNullSafe(F.col(v))
    near = micros(F.col(start)) - micros(F.max(end).over(before)) <= F.lit(int(gap * 1_000_000))
    marked = df.withColumn("_new", F.when(same & F.coalesce(near, F.lit(False)), 0).otherwise(1))
    numbered = marked.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    found = numbered.groupBy(*by, "_island", *values).agg(F.min(start).alias("_f"), F.max(end).alias("_t"), n.alias("_n"))
    return found.drop("_island").withColumnsRenamed({"_f": FROM, "_t": TO, "_n": READINGS})


def unchanged_runs(df: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str], max_gap: float) -> DataFrame:
    """``keys, values, run_from, run_to, readings``; ``max_gap`` in seconds. Readings without a time have no run.

    Runs are found within days first, so a key that holds a third of all rows is
    spread over its days, and then over the days' runs. Of readings at the same
    time those with smaller values come first; repeated readings count in ``readings``.
    """
    rows = df.where(F.col(ts).isNotNull()).select(*keys, *values, F.col(ts).alias("_ts"))
    rows = rows.withColumn("_day", slot(F.col("_ts"), _DAY * 1_000_000))
    within = _islands(rows, [*keys, "_day"], values, "_ts", "_ts", F.count(F.lit(1)), max_gap).drop("_day")
    return _islands(within, list(keys), values, FROM, TO, F.sum(READINGS), max_gap)


def overlap_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, start: str, end: str, before: float, after: float, how: str = "inner"
) -> DataFrame:
    """Rows with equal keys whose window ``[left_ts - before, left_ts + after]`` meets ``[start, end]`` of the right row.

    A left row lies in one bucket of time as wide as its window; a right row is
    copied to all buckets whose left rows it can reach, so each pair meets once
    and a hot key is spread over time.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    width = bucket_width(before, after)
    first, last = slot(F.col(start) - interval(after), width), slot(F.col(end) + interval(before), width)
    copied = right.where(F.col(start) <= F.col(end)).withColumn(BUCKET, F.explode(F.sequence(first, last)))
    other = copied.select(*(F.col(f"`{c}`").alias(f"_r_{c}" if c in (*keys, BUCKET) else c) for c in copied.columns))
    cond = (F.col(start) <= F.col(left_ts) + interval(after)) & (F.col(end) >= F.col(left_ts) - interval(before))
    for k in (*keys, BUCKET):
        cond = (F.col(k) == F.col(f"_r_{k}")) & cond
    joined = left.withColumn(BUCKET, slot(F.col(left_ts), width)).join(other, cond, "leftOuter" if how == "left" else "inner")
    return joined.select(*(F.col(f"`{c}`") for c in [*left.columns, *(c for c in right.columns if c not in keys)]))
