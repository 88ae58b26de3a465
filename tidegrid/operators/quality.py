"""Data-quality rules, reports and audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.config import Settings
from tidegrid.functions.geo import in_box
from tidegrid.functions.times import interval

Rules = Mapping[str, Column]


def _holds(rule: Column) -> Column:
    # A rule over NULL input is not satisfied.
    return F.coalesce(rule, F.lit(False))


def traffic_rules(cfg: Settings, speed: str = "speed") -> dict[str, Column]:
    return {
        "null_critical": F.col("id").isNotNull() & F.col("traffic_event_ts").isNotNull(),
        "coords": in_box(F.col("traffic_lat"), F.col("traffic_lon"), cfg.box),
        "speed": F.col(speed).between(0.0, cfg.max_speed),
    }


def aq_rules(cfg: Settings) -> dict[str, Column]:
    return {
        "null_critical": F.col("aq_location_id").isNotNull() & F.col("aq_event_ts").isNotNull(),
        "coords": in_box(F.col("aq_lat"), F.col("aq_lon"), cfg.box),
        "pm25": F.col("aq_pm25_ugm3").between(0.0, cfg.max_pm25),
    }


def not_in_future(ts: str, arrival: str, slack_seconds: int) -> Column:
    """Guard against clocks that run ahead and would push the watermark forward."""
    return F.col(ts) <= F.col(arrival) + interval(slack_seconds)


def dq_report(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule with total and invalid rows, from a single pass."""
    sums = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *(F.count_if(~_holds(rule)).alias(f"r{i}") for i, rule in enumerate(rules.values())),
    )
    rows = F.array(
        *(
            F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("invalid_rows"))
            for i, name in enumerate(rules)
        )
    )
    return sums.select("total_rows", F.explode(rows).alias("r")).select("r.rule", "total_rows", "r.invalid_rows")


def keep_clean(df: DataFrame, rules: Rules) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, rules.values()))


def label_rules(df: DataFrame, rules: Rules) -> DataFrame:
    """All rows with the array ``broken_rules``, empty for clean ones, in one pass."""
    broken = F.array_compact(F.array(*(F.when(~_holds(r), F.lit(n)) for n, r in rules.items())))
    return df.withColumn("broken_rules", broken)


def apply_rules(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows with the array of broken rules).

    Two branches over ``df``: store it before, or use ``label_rules`` where both are wanted at once.
    """
    return keep_clean(df, rules), label_rules(df, rules).where(F.size("broken_rules") > 0)


def split_contract(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every required column set, the others)."""
    complete = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in required))
    return df.where(complete), df.where(~complete)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns))


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in required if c not in have]


def in_window(ts: str, other: str, seconds: int) -> Column:
    a, b = F.col(ts), F.col(other)
    return (b >= a - interval(seconds)) & (b <= a + interval(seconds))


def window_violations(df: DataFrame, ts: str, other: str, seconds: int, rows: str | None = None) -> DataFrame:
    """Joined rows checked, and those whose times are further apart than allowed; ``rows``: column with the number of rows that each stands for."""
    n, bad = F.lit(1).cast("bigint") if rows is None else F.col(rows), ~_holds(in_window(ts, other, seconds))
    none = F.lit(0).cast("bigint")
    return df.where(F.col(other).isNotNull()).agg(
        F.coalesce(F.sum(n), none).alias("checked_rows"),
        F.coalesce(F.sum(F.when(bad, n)), none).alias("violations"),
    )


def late_audit(raw: DataFrame, enriched: DataFrame, raw_id: str, enriched_id: str) -> DataFrame:
    """Raw rows that never reached the enriched table."""
    seen = enriched.select(F.col(enriched_id).alias("_seen")).distinct()
    return raw.join(seen, F.col(raw_id) == F.col("_seen"), "left_anti")
