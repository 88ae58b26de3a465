"""Headline timings at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

The two joins follow the published benchmark: the newest 30,000 rows of each
side within 12 hours, cached, and a count of the joined rows. The events span a
month, so their times are folded into 12 hours, and the grid is chosen so that
about as many rows come out. Both joins are also run in the form of a plain
condition (``*_plain``) on the same inputs and predicate (the plain distance
join takes minutes and runs only with ``BENCH_BRUTE=1``), and once more on
``local[2]`` with 16 partitions (``*_local2``), which is what was published.
Plans are built before the clock starts for the joins. Everything is run once to
warm up; the best of three (joins) or two is reported.

``flow_whole`` is one run of all eight streaming queries over the message files,
parsing included. Reports read the stored business table, ``enrich_batch`` the
stored refined tables.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from tidegrid import build_session
from tidegrid.catalogue import feeds, registry, streams
from tidegrid.functions.geo import haversine_m
from tidegrid.operators import joins, tables
from tidegrid.plans.enrich import enrich
from tidegrid.session import own_root

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SAMPLE, WINDOW, METRES = 30_000, 900, 500.0

REPORTS = [
    "rpt_match_pct_by_region", "rpt_speed_buckets", "rpt_coverage_bins", "hotspot_persistence", "confounder_uplift",
    "region_hour_pivot", "rpt_map_points", "rpt_health",
]
OPERATORS = [
    "parse_quarantine", "dq_report", "hex_cells", "interval_left", "interval_const_key", "nearest_in_time",
    "points_in_polygons", "near_lines", "nearest_neighbor", "cell_flags", "dedup_first",
]


def best(run, times: int = 2) -> tuple[float, int]:
    run()
    took = []
    for _ in range(times):
        start = time.perf_counter()
        n = run()
        took.append(time.perf_counter() - start)
    return min(took), n


def consume(df) -> int:
    """Runs the whole query without collecting rows."""
    df.write.format("noop").mode("overwrite").save()
    return 0


def start(cpus: str, partitions: str):
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": partitions, "spark.driver.memory": "12g", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    own_root(spark)
    return spark


def folded(df, ts: str):
    """The same rows with their times within 12 hours."""
    return df.withColumn(ts, F.timestamp_micros(F.pmod(F.unix_micros(ts), F.lit(12 * 3600 * 1_000_000))))


def time_joins(spark, timed, facts: dict, cpus: int, suffix: str = "") -> None:
    cells = {"edge_m": 780.0}
    views = feeds.points(spark, SF, "view", "purchase", **cells).select(
        "cell", F.col("event_id").alias("t_id"), F.col("ts").alias("t_ts"), F.col("lat").alias("t_lat"), F.col("lon").alias("t_lon")
    )
    readings = feeds.points(spark, SF, "click", "error", **cells).select(
        "cell", F.col("event_id").alias("a_id"), F.col("ts").alias("a_ts"), F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon")
    )
    left = folded(tables.recent_sample(views, "t_ts", SAMPLE, "t_id"), "t_ts").repartition(cpus).cache()
    right = folded(tables.recent_sample(readings, "a_ts", SAMPLE, "a_id"), "a_ts").repartition(cpus).cache()
    facts[f"sample_rows{suffix}"] = left.count() + right.count()
    facts[f"cells{suffix}"] = left.select("cell").distinct().count()

    def joined(df):
        counted = df.groupBy().count()
        return lambda: counted.first()[0]

    timed(f"cell_join{suffix}", joined(joins.abs_seconds_join(left, right, ["cell"], "t_ts", "a_ts", WINDOW)), 3)
    gap = F.abs(F.unix_timestamp("t_ts") - F.unix_timestamp("a_ts")) <= WINDOW
    r = right.withColumnRenamed("cell", "a_cell")
    timed(f"cell_join_plain{suffix}", joined(left.join(r, (F.col("cell") == F.col("a_cell")) & gap)), 3)

    l2, r2 = left.drop("cell"), right.drop("cell")
    points = ("t_lat", "t_lon"), ("a_lat", "a_lon")
    timed(f"distance_join{suffix}", joined(joins.distance_time_join(l2, r2, *points, METRES, "t_ts", "a_ts", WINDOW)), 3)
    if os.environ.get("BENCH_BRUTE") and not suffix:
        near = haversine_m(F.col("t_lat"), F.col("t_lon"), F.col("a_lat"), F.col("a_lon")) <= METRES
        quarter = F.expr("INTERVAL 15 MINUTES")
        gap2 = F.col("a_ts").between(F.col("t_ts") - quarter, F.col("t_ts") + quarter)
        began = time.perf_counter()
        facts["distance_join_plain_rows"] = l2.join(r2, gap2 & near).count()
        facts["distance_join_plain_sec"] = round(time.perf_counter() - began, 3)
    left.unpersist()
    right.unpersist()


def main() -> None:
    spark = start(CPUS, CPUS)
    took: dict[str, float] = {}
    facts: dict[str, float] = {}

    def timed(name: str, run, times: int = 2) -> None:
        took[name], n = best(run, times)
        if n:
            facts[f"{name}_rows"] = n

    time_joins(spark, timed, facts, int(CPUS))
    refined = feeds.refined_tables(spark, SF)
    lookup = feeds.stored_lookup(spark, SF)
    timed("enrich_batch", lambda: consume(enrich(*refined, lookup, feeds.CFG)))
    facts["enriched_rows"] = feeds.business(spark, SF).count()
    facts["enriched_rows_per_sec"] = round(facts["enriched_rows"] / took["enrich_batch"])
    queries = registry.queries()
    for name in REPORTS + OPERATORS:
        timed(name, lambda name=name: consume(queries[name](spark, SF)))

    streams.message_files(spark, SF)
    began = time.perf_counter()
    streams.whole_flow(spark, SF)
    took["flow_whole"] = time.perf_counter() - began
    facts["streamed_rows_per_sec"] = round(facts["enriched_rows"] / took["flow_whole"])
    spark.stop()

    spark = start("2", "16")
    time_joins(spark, timed, facts, 16, "_local2")

    print(
        json.dumps(
            {
                "metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec",
                "queries": {n: round(s, 3) for n, s in took.items()},
                "sf": os.path.basename(SF.rstrip("/")).removeprefix("sf"), "cpus": CPUS, "facts": facts,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
