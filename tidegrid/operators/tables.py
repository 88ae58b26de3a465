"""Set, ranking and aggregate operators used by the reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.functions.stats import rounded
from tidegrid.functions.times import time_bin


def union_contract(*dfs: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``. An aggregate, so copies are combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*(c if c in keys else F.col(f"_first.{c}") for c in df.columns))


def thin_readings(df: DataFrame, keys: Sequence[str], ts: str, seconds: int, *tie: str) -> DataFrame:
    """First reading per key and time bin: for feeds that stamp an unchanged value anew at each poll."""
    binned = df.withColumn("_bin", time_bin(F.col(ts), seconds))
    return dedup_first(binned, [*keys, "_bin"], [ts, *tie]).drop("_bin")


def mode_per_group(df: DataFrame, group: str, value: str, count: str) -> DataFrame:
    """Most frequent value per group and its row count; ties go to the smaller value."""
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias(count))
    rank = F.struct(-F.col(count), F.col(value).isNotNull(), F.col(value))
    return counts.groupBy(group).agg(
        F.min_by(value, rank).alias(value), F.max(count).alias(count)
    )


def top_per_group(df: DataFrame, by: Sequence[str], order: Column, n: int, dense: bool = True) -> DataFrame:
    """Rows ranked at most ``n`` in their group; with ``dense`` ties share a rank."""
    window = Window.partitionBy(*by).orderBy(order)
    rank = F.dense_rank() if dense else F.row_number()
    return df.withColumn("rank_in_group", rank.over(window)).where(F.col("rank_in_group") <= n)


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def recent_sample(df: DataFrame, ts: str, n: int, *tie: str) -> DataFrame:
    """The ``n`` most recent rows. Persist it yourself when it is used more than once."""
    return df.orderBy(F.col(ts).desc(), *tie).limit(n)


def distinct_count(df: DataFrame, columns: Sequence[Column], name: str, by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    count = F.approx_count_distinct(F.struct(*columns)) if approx else F.count_distinct(*columns)
    return df.groupBy(*by).agg(count.alias(name))


def pivot_mean(df: DataFrame, row: str, column: str, values: Sequence, value: str, digits: int = 2) -> DataFrame:
    """Mean per row and column value as a wide table; absent cells are 0."""
    wide = df.groupBy(row).pivot(column, list(values)).agg(rounded(F.avg(value), digits))
    return wide.na.fill(0.0)


def mean_of_means(df: DataFrame, inner: Sequence[str], outer: Sequence[str], value: str, digits: int = 2) -> DataFrame:
    """Mean of the inner groups' means, and how many inner groups there are."""
    means = df.groupBy(*inner).agg(rounded(F.avg(value), digits).alias("inner_mean"))
    return means.groupBy(*outer).agg(
        F.count(F.lit(1)).alias("groups"), rounded(F.avg("inner_mean"), digits).alias("mean_of_means")
    )


def uplift(df: DataFrame, keys: Sequence[Column], baseline: Column, value: str) -> DataFrame:
    """Group means beside their difference from the mean of the baseline rows."""
    base = df.where(baseline).agg(F.avg(value).alias("v")).scalar()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("records"), F.avg(value).alias("_mean"))
        .withColumns({"avg_value": rounded(F.col("_mean"), 2), "uplift": rounded(F.col("_mean") - base, 2)})
        .drop("_mean")
    )
