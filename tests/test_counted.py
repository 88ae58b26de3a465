"""Reports on counted rows beside the same reports on the business rows themselves."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegrid import Settings
from tidegrid.catalogue import feeds
from tidegrid.operators import quality
from tidegrid.plans import counted, reports
from tidegrid.plans.enrich import enrich
from tidegrid.sinks.parts import put_parts
from tidegrid.sinks.streams import ONCE
from tidegrid.streaming import live_reports
from tidegrid.streaming.replay import finish

START = datetime(2024, 1, 10)
TRAFFIC = "id string, status string, speed double, travel_time double, link_name string, borough string, from_street string, to_street string, traffic_event_ts timestamp, traffic_lat double, traffic_lon double, h3_index string"
AQ = "aq_source string, aq_location_id string, aq_location_name string, aq_pm25_ugm3 double, aq_temperature double, aq_humidity double, aq_event_ts timestamp, h3_index string"
WEATHER = "weather_event_ts timestamp, weather_join_key string, weather_period_name string, weather_temperature int, weather_temperature_unit string, weather_wind_speed_mph int, weather_wind_direction string, weather_short_forecast string, weather_precip_probability int"


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(4)
    when = lambda: START + timedelta(seconds=r.randrange(0, 6 * 3600))
    traffic = [
        (str(i % 50), "0", r.choice([r.randint(0, 200) / 4, None]), 1.0, "l", r.choice(["one", "Two b", None]), "f", "t", when(), 40.5 + i % 3, r.choice([-74.0, None]), r.choice(["a", "b", "c", None]))
        for i in range(60)
    ]
    aq = [("s", str(i % 7), "n", r.choice([r.randint(0, 99) / 2, None]), None, None, when(), r.choice(["a", "b", None])) for i in range(80)]
    weather = [(when(), r.choice(["nyc", "one"]), f"p{i}", r.choice([r.randint(0, 90), None]), "F", r.choice([r.randint(-1, 20), None]), "NW", "x", 1) for i in range(30)]
    made = (spark.createDataFrame(traffic + traffic[:9], TRAFFIC), spark.createDataFrame(aq + aq[:9], AQ), spark.createDataFrame(weather + weather[:3], WEATHER))
    lookup = spark.createDataFrame([("a", True, False, True), ("b", False, True, False)], "h3_lookup_index string, is_in_congestion_zone boolean, is_near_truck_route boolean, is_near_high_emission_bldg boolean")
    return (*made, lookup)


def rows_of(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def ends():
    return F.lit(START).cast("timestamp"), F.lit(START + timedelta(hours=5)).cast("timestamp")


REPORTS = {
    f.__name__: (lambda df, f=f: f(df))
    for f in (
        reports.coverage_hourly_active, reports.region_rollup, reports.event_span, reports.fanout, reports.cell_rows, reports.match_pct,
        reports.match_pct_by_event, reports.flag_segments, reports.hour_pattern, reports.hot_slow_cells, reports.region_hour,
        reports.speed_buckets, reports.wind_buckets, reports.distinct_points, reports.acceptance, reports.acceptance_regions, reports.flag_distribution, reports.weather_enriched_count,
    )
} | {
    f.__name__: (lambda df, f=f: f(df, *ends()))
    for f in (reports.speed_pm25_by_minute, reports.region_speed_by_minute, reports.matched_by_minute, reports.coverage_hourly, reports.map_points, reports.map_regions, reports.slices, reports.availability)
} | {
    "known_wind": lambda df: reports.wind_buckets(df, known_only=True),
    "matched_rollup": lambda df: reports.region_rollup(df, matched_only=True),
    "segments": lambda df: reports.segment_by_minute(df, *ends(), False, True),
    "current": lambda df: reports.region_current(df, ends()[1], 90),
    "freshness": lambda df: reports.freshness(df, ends()[1]),
    "none": lambda df: reports.acceptance(df.limit(0)),
}


def test_reports_on_counted_rows_equal_those_on_business_rows(spark, tables, tmp_path):
    plain, counts = enrich(*tables), counted.event_counts(*tables)
    plain.write.parquet(f"{tmp_path}/plain")
    counts.write.parquet(f"{tmp_path}/counts")
    plain, counts = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("plain", "counts"))
    assert counts.count() < 69 < plain.count()  # equal events are one row
    for name, report in REPORTS.items():
        assert rows_of(report(counts)) == rows_of(report(plain)), name


def test_counts_with_a_region_key(tables):
    cfg = Settings(region_key=True)
    assert rows_of(reports.acceptance(counted.event_counts(*tables, cfg))) == rows_of(reports.acceptance(enrich(*tables, cfg)))


def test_recent_rows_hold_the_most_recent(tables):
    plain, counts = enrich(*tables), counted.event_counts(*tables)
    tie = ("traffic_id", "aq_event_ts", "aq_location_id", "weather_event_ts")
    full = counts.where(F.col(counted.FULL_WEATHER_ROWS) > 0)
    got = counted.recent_rows(full, 20, *tables)
    assert reports.weather_sample(got, 20, *tie).collect() == reports.weather_sample(plain, 20, *tie).collect()
    assert reports.acceptance_sample(counted.recent_rows(counts, 20, *tables), 20, *tie).collect() == reports.acceptance_sample(plain, 20, *tie).collect()
    assert counted.recent_rows(counts.limit(0), 20, *tables).count() == 0


def test_live_series_on_counted_rows_equal_those_on_business_rows(spark, tables, tmp_path):
    counts, out = counted.event_counts(*tables), str(tmp_path / "out")
    for i, half in enumerate((F.col("traffic_event_ts") < ends()[1], F.col("traffic_event_ts") >= ends()[1])):
        put_parts(counts.where(half).coalesce(1), f"{tmp_path}/table", f"q1-{i:012d}", "traffic_event_ts")
        finish(live_reports.start_report(spark, f"{tmp_path}/table", out, "speed_pm25", ONCE, schema=counts.schema))
    want = reports.speed_pm25_by_minute(enrich(*tables), ends()[0], ends()[1] + F.expr("INTERVAL 9 DAYS"))
    assert rows_of(live_reports.read_report(spark, out, "speed_pm25")) == rows_of(want)


def test_reports_do_not_write_the_business_rows_out(spark, monkeypatch):
    from tidegrid.catalogue import operators
    from tidegrid.catalogue import reports as queries

    monkeypatch.setattr(feeds, "business", None)  # it would fail if it were called
    names = ("rpt_acceptance_sample", "rpt_coverage_hourly", "rpt_fanout", "rpt_freshness", "rpt_hot_slow_cells", "rpt_in_window_sample", "rpt_segment_highway")
    names += ("rpt_speed_buckets", "rpt_wind_buckets", "rpt_wind_buckets_known")
    for name in names:
        assert queries.QUERIES[name][0](spark, "/root/testdata/sf0.001") is not None
    assert operators.QUERIES["late_audit"][0](spark, "/root/testdata/sf0.001").columns == ["id"]
    assert operators.QUERIES["missing_columns"][0](spark, "/root/testdata/sf0.001").first()["missing"] == 0


def test_events_and_readings_are_counted_without_pairs(spark, tables, monkeypatch):
    """What windows hold comes from running sums: no join of events with readings, which grows with the product of both."""
    counts = counted.event_counts(*tables)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "aq_event_ts" in plan and "Window" in plan
    # Joins are equi-joins on the key and the event's own time, none has a range of times.
    joins = [line for line in plan.splitlines() if " Join " in f" {line}" or "Join Left" in line or "Join Inner" in line]
    assert joins and not any(">=" in line or "<=" in line for line in joins)


def test_windows_hold_both_ends_and_slots_before_1970(spark):
    """Readings exactly at a window's ends count, those a microsecond beyond do not; equal events and missing keys stay."""
    def at(day, micro):
        return day + timedelta(microseconds=micro)

    half, rows, readings, want = 900 * 10**6, [], [], {}
    for n, day in enumerate((START, datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1970, 1, 1), START + timedelta(seconds=900 * 7 + 1))):
        name = f"k{n}"
        rows += [(str(n), "0", 5.0, 1.0, "l", None, "f", "t", day, 40.5, -74.0, name)] * (n + 1)
        readings += [("s", str(i), "n", 1.0 * 10**i, None, None, at(day, off), name) for i, off in enumerate((-half - 1, -half, 0, half, half + 1))]
        want[str(n)] = (3 * (n + 1), 1110.0 * (n + 1), at(day, -half), at(day, half))
    rows += [("none", "0", 5.0, 1.0, "l", None, "f", "t", START, 40.5, -74.0, None), ("no time", "0", 5.0, 1.0, "l", None, "f", "t", None, 40.5, -74.0, "k0")]
    want |= {"none": (1, None, None, None), "no time": (1, None, None, None)}
    aq = spark.createDataFrame([*readings, ("s", "x", "n", 7.0, None, None, START, None), ("s", "x", "n", 7.0, None, None, None, "k0")], AQ)
    lookup = spark.createDataFrame([], "h3_lookup_index string, is_in_congestion_zone boolean, is_near_truck_route boolean, is_near_high_emission_bldg boolean")
    found = counted.event_counts(spark.createDataFrame(rows, TRAFFIC), aq, spark.createDataFrame([], WEATHER), lookup)
    got = found.select("traffic_id", counted.ROWS, counted.PM25_TOTAL, "aq_first_ts", "aq_last_ts").collect()
    assert {r[0]: tuple(r[1:]) for r in got} == want


def test_windows_are_checked_per_pair_with_the_rows_it_stands_for(spark, tables, monkeypatch):
    plain, pairs = enrich(*tables), counted.reading_rows(*tables)
    for seconds in (900, 300):  # too narrow a window shows that each pair is looked at
        args = "traffic_event_ts", "aq_event_ts", seconds
        want = quality.window_violations(plain, *args).first()
        assert quality.window_violations(pairs, *args, counted.ROWS).first() == want
        assert want["checked_rows"] > pairs.count() and (want["violations"] > 0) == (seconds == 300)
    assert tuple(quality.window_violations(pairs.limit(0), *args, counted.ROWS).first()) == (0, 0)
    cfg = Settings(region_key=True)
    assert quality.window_violations(counted.reading_rows(*tables, cfg), *args, counted.ROWS).first() == quality.window_violations(enrich(*tables, cfg), *args).first()
    monkeypatch.setattr(feeds, "business", None)  # it would fail if it were called
    from tidegrid.catalogue import operators

    assert operators.QUERIES["window_violations"][0](spark, "/root/testdata/sf0.001").first()["violations"] == 0


def test_spread_of_large_values_that_differ_little(spark):
    """The deviation of counted rows is not lost in the squares of large values."""
    keys = [f"k{i}" for i in range(6)]
    rows = [(str(i), "0", 5.0, 1.0, "l", None, "f", "t", START, 40.5, -74.0, k) for i, k in enumerate(keys)]
    readings = [("s", str(i), "n", 1e9 + i % 3, None, None, START, k) for i, k in enumerate(keys * 4)]
    lookup = spark.createDataFrame([], "h3_lookup_index string, is_in_congestion_zone boolean, is_near_truck_route boolean, is_near_high_emission_bldg boolean")
    made = (spark.createDataFrame(rows, TRAFFIC), spark.createDataFrame(readings, AQ), spark.createDataFrame([], WEATHER), lookup)
    assert rows_of(reports.speed_buckets(counted.event_counts(*made))) == rows_of(reports.speed_buckets(enrich(*made)))
