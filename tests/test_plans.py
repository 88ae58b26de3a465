"""What the physical plans must look like."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidegrid import Settings
from tidegrid.catalogue import feeds, operators, registry
from tidegrid.operators import ingest, joins
from tidegrid.plans import reports
from tidegrid.plans.enrich import with_weather

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(operators.QUERIES["interval_inner"][0](spark, SF))
    assert "PushedFilters: [In(event_type, [click,error])]" in text
    assert "props" not in text
    text = plan(ingest.within_radius(feeds.table(spark, SF, "supplier").withColumnRenamed("s_acctbal", "lat").withColumn("lon", F.lit(0.0)), "lat", "lon", (40.0, 0.0), 1000.0))
    assert "GreaterThanOrEqual(s_acctbal" in text


def test_no_query_leaves_the_jvm(spark):
    queries = registry.queries()
    for name in queries:
        if not name.startswith("stream_"):
            text = plan(queries[name](spark, SF))
            for step in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct"):
                assert step not in text, name


def test_time_is_part_of_the_join_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(operators.QUERIES["interval_const_key"][0](spark, SF))
        assert "SortMergeJoin" in text and "_bucket" in text.split("SortMergeJoin")[1].split("\n")[0]
        text = plan(operators.QUERIES["distance_time_join"][0](spark, SF))
        assert "SortMergeJoin" in text and "NestedLoop" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_is_broadcast_by_size_only(spark):
    text = plan(operators.QUERIES["static_lookup_join"][0](spark, SF))
    assert "BroadcastHashJoin" in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(operators.QUERIES["static_lookup_join"][0](spark, SF))
        assert "SortMergeJoin" in text and "Broadcast" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reports_prune_columns_and_days(spark):
    table = feeds.business(spark, SF)
    text = plan(reports.coverage_bins(table, F.lit("2024-01-20").cast("timestamp")))
    assert "ReadSchema: struct<traffic_event_ts:timestamp,aq_pm25_ugm3:double,weather_temperature:int>" in text
    assert "event_date" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_rank_limits_come_before_the_shuffle(spark):
    table = feeds.business(spark, SF)
    assert "WindowGroupLimit" in plan(reports.hotspot_persistence(table, F.lit("2024-01-30").cast("timestamp")))
    assert "WindowGroupLimit" in plan(operators.QUERIES["nearest_neighbor"][0](spark, SF))
    assert "TakeOrderedAndProject" in plan(reports.fanout(table))


@pytest.mark.parametrize("by_region,matches", [(False, 4), (True, 2)])
def test_weather_of_all_regions_or_of_the_own_one(spark, by_region, matches):
    t = datetime(2024, 1, 1)
    traffic = spark.createDataFrame([("Staten Island", t), ("Queens", t)], "traffic_borough string, traffic_event_ts timestamp")
    keys = ["staten_island", "queens"] if by_region else ["nyc", "nyc"]
    weather = spark.createDataFrame([(k, t) for k in keys], "weather_join_key string, weather_event_ts timestamp")
    joined = with_weather(traffic, weather, Settings(region_key=by_region))
    assert joined.where("has_weather_match").count() == matches


def test_cut_groups_are_joined_without_a_hint(spark):
    from tidegrid.config import Skew
    from tidegrid.operators.skew import find_hot

    right = operators.aq_points(spark, SF)
    hot = find_hot(right, ["cell"], "a_ts", 900, 900, Skew(hot_rows=1))
    assert hot.table.count() > 5
    left = operators.traffic_points(spark, SF)
    cut = joins.interval_join(left, right, ["cell"], "t_ts", "a_ts", 900, 900, "left", hot=hot).select("t_id", "a_id")
    plain = joins.interval_join(left, right, ["cell"], "t_ts", "a_ts", 900, 900, "left").select("t_id", "a_id")
    assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))
