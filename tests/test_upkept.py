"""What goes on from stored state: late loads, partial states, live windows, heartbeats, repairs."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_streaming import CFG, fill, lookup, message, sentinel, write

from tidegrid.config import TOPICS
from tidegrid.operators import ledger
from tidegrid.plans import reports, rollups, sketches
from tidegrid.plans.enrich import enrich
from tidegrid.schemas import BUSINESS
from tidegrid.sinks import parts
from tidegrid.sinks.streams import ONCE
from tidegrid.sources.topics import TopicSource, read_topic_batch
from tidegrid.streaming import flow, heartbeat, live_reports, repair
from tidegrid.streaming.replay import finish
from tidegrid.upkeep import tables as upkeep

DAY = datetime(2026, 5, 1)


# Late loads ------------------------------------------------------------------

SOURCE = "id int, ts timestamp, arrived timestamp, v string"


def arrivals(n=300, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        ts = DAY + timedelta(minutes=10 * i)
        rows.append((i, ts, ts + timedelta(minutes=r.choice([0, 1, 60, 700])), f"v{i}"))
    return sorted(rows, key=lambda x: x[2])


def test_rows_that_arrive_out_of_order_are_taken_once(spark, tmp_path):
    rows = arrivals()
    load = ledger.LateLoad(str(tmp_path / "load"), "ts", ("id",), "12 hours", "arrived")
    taken = []
    for upto in (40, 41, 41, 130, 131, 200, 300):
        source = spark.createDataFrame(rows[:upto], SOURCE)
        assert ledger.too_late(source, load, ledger.last_mark(spark, load)).count() == 0
        taken += [x.id for x in ledger.poll(source, load).collect()]
    assert sorted(taken) == list(range(300))
    assert sorted(x.id for x in ledger.loaded(spark, load).collect()) == list(range(300))
    assert ledger.last_mark(spark, load).poll == 6


def test_rows_beyond_the_bound_are_reported(spark, tmp_path):
    load = ledger.LateLoad(str(tmp_path / "load"), "ts", ("id",), "1 hour", "arrived")
    first = [(1, DAY + timedelta(hours=10), DAY + timedelta(hours=10), "a"), (2, None, DAY + timedelta(hours=10), "no time")]
    late = [(3, DAY + timedelta(hours=2), DAY + timedelta(hours=11), "too late"), (4, DAY + timedelta(hours=9, minutes=30), DAY + timedelta(hours=11), "late")]
    assert [x.id for x in ledger.poll(spark.createDataFrame(first, SOURCE), load).collect()] == [1]
    source = spark.createDataFrame(first + late + late, SOURCE)
    assert {x.id for x in ledger.too_late(source, load, ledger.last_mark(spark, load)).collect()} == {3}
    assert [x.id for x in ledger.poll(source, load).collect()] == [4]  # repeated rows once
    assert ledger.poll(source, load).count() == 0


def test_a_poll_that_was_cut_off_is_done_again(spark, tmp_path):
    load = ledger.LateLoad(str(tmp_path / "load"), "ts", ("id",), "12 hours")
    rows = arrivals(60)
    ledger.poll(spark.createDataFrame(rows[:30], SOURCE), load)
    ledger.poll(spark.createDataFrame(rows[:50], SOURCE), load)
    for f in sorted((tmp_path / "load" / "marks" / "poll=000001").iterdir()):
        f.unlink()  # rows and keys are there, the mark is not
    (tmp_path / "load" / "marks" / "poll=000001").rmdir()
    got = ledger.poll(spark.createDataFrame(rows[:40], SOURCE), load)
    assert {x.id for x in got.collect()} == {x[0] for x in rows[30:40]}
    ledger.poll(spark.createDataFrame(rows, SOURCE), load)
    assert sorted(x.id for x in ledger.loaded(spark, load).collect()) == list(range(60))


def test_polls_read_the_ledger_from_the_bound_on(spark, tmp_path):
    load = ledger.LateLoad(str(tmp_path / "load"), "ts", ("id",), "1 day")
    rows = [(i, DAY + timedelta(hours=i), DAY, "v") for i in range(240)]
    source = spark.createDataFrame(rows, SOURCE)
    ledger.poll(source, load)
    plan = ledger.fresh_rows(source, load, ledger.last_mark(spark, load))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert ledger.forget(spark, load) == 8 and len(parts.folders(spark, f"{load.folder}/keys/event_date=*")) == 2
    assert ledger.poll(source, load).count() == 0  # what was forgotten lies before the bound


# Partial states --------------------------------------------------------------

def business_rows(spark, days, seed=1, n=60):
    r = random.Random(seed)
    rows = []
    for d in days:
        for i in range(n):
            pm25 = r.choice([None, r.uniform(0, 80)])
            rows.append((f"{d}-{i}", r.uniform(0, 70), r.choice(["Queens", "Bronx", None]), DAY + timedelta(days=d, minutes=r.randrange(1440)), pm25, r.choice([None, 60, 71])))
    df = spark.createDataFrame(rows, "traffic_id string, traffic_speed double, traffic_borough string, traffic_event_ts timestamp, aq_pm25_ugm3 double, weather_temperature int")
    return df.select(*(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in BUSINESS.fields))


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, map(tuple, a.collect()))) == sorted(map(str, map(tuple, b.collect())))


def test_states_are_made_of_new_parts_only(spark, tmp_path):
    table, states = str(tmp_path / "table"), str(tmp_path / "states")
    parts.put_parts(business_rows(spark, range(5)), table, "q1-000000000000", "traffic_event_ts")
    first = rollups.refresh(spark, table, states)
    assert len(first.made) == 5
    # Files of days that have states are spoilt: a refresh that read them would fail.
    kept = {f: f.read_bytes() for f in (tmp_path / "table").rglob("*.parquet")}
    for f in kept:
        f.write_bytes(b"spoilt")
    parts.put_parts(business_rows(spark, [5], seed=2), table, "q1-000000000001", "traffic_event_ts")
    second = rollups.refresh(spark, table, states)
    assert [d for d, _ in second.made] == ["2026-05-06"] and all("2026-05-06" in f for f in second.files_read) and second.files_read
    assert rollups.refresh(spark, table, states) == rollups.Refreshed((), (), ())
    for f, raw in kept.items():
        f.write_bytes(raw)
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    whole, found = spark.read.parquet(table), rollups.read_states(spark, states)
    for name in ("region_rollup", "match_pct", "speed_buckets", "region_hour"):
        same(getattr(rollups, name)(found), getattr(reports, name)(whole))
    same(rollups.region_rollup(found, matched_only=True), reports.region_rollup(whole, matched_only=True))
    same(rollups.match_pct(found, "traffic_borough"), reports.match_pct(whole, "traffic_borough"))


def test_states_follow_compaction_and_retention(spark, tmp_path):
    table, states = str(tmp_path / "table"), str(tmp_path / "states")
    for i in range(4):
        parts.put_parts(business_rows(spark, range(3), seed=i).repartition(2), table, f"q1-{i:012d}", "traffic_event_ts")
    rollups.refresh(spark, table, states)
    assert upkeep.compact(spark, table).partitions == 3
    upkeep.drop_days_before(spark, table, "2026-05-02", really=True)
    done = rollups.refresh(spark, table, states)
    assert {b.split("-")[0] for _, b in done.made} == {"merged"} and len(done.removed) == 3 * 3 + 1
    same(rollups.speed_buckets(rollups.read_states(spark, states)), reports.speed_buckets(spark.read.parquet(table)))


# Live windows ----------------------------------------------------------------

def test_live_series_go_on_after_a_restart(spark, tmp_path):
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    for i in range(3):  # the same days again and again: windows change after the restart
        parts.put_parts(business_rows(spark, [0], seed=i), table, f"q1-{i:012d}", "traffic_event_ts")
        finish(live_reports.start_report(spark, table, out, "coverage_hourly", ONCE, delay="2 days"))
        finish(live_reports.start_report(spark, table, out, "region_speed", ONCE, delay="2 days"))
    rows, ends = spark.read.parquet(table), (F.lit(DAY), F.lit(DAY + timedelta(days=9)))
    digits = lambda df: df.select(*(F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))
    same(digits(live_reports.read_report(spark, out, "coverage_hourly")), digits(reports.coverage_hourly(rows, *ends)))
    same(digits(live_reports.read_report(spark, out, "region_speed")), digits(reports.region_speed_by_minute(rows, *ends)))
    assert spark.read.parquet(live_reports.report_path(out, "coverage_hourly")).count() > live_reports.read_report(spark, out, "coverage_hourly").count()


# Heartbeats ------------------------------------------------------------------

def test_an_idle_feed_holds_nothing_back_and_loses_nothing(spark, tmp_path):
    root, out, ticks = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ticks")

    def tick(hour):
        spark.createDataFrame([(datetime(2026, 4, 26, hour),)], "timestamp timestamp").coalesce(1).write.mode("append").parquet(ticks)

    def run(beats=True):
        finish(*flow.start_raw(spark, TopicSource(root), out, CFG, ONCE).values())
        finish(*flow.start_refined(spark, out, CFG, ONCE).values())
        clock = spark.readStream.schema("timestamp timestamp").parquet(ticks)
        finish(*flow.start_business(spark, out, lookup(spark), CFG, ONCE, clock=clock).values())
        found = parts.folders(spark, f"{out}/business/event_date=*")
        return {(r[0], r[1]) for r in spark.read.parquet(f"{out}/business").select("traffic_id", "weather_temperature").collect()} if found else set()

    spark.createDataFrame([], "value string, timestamp timestamp, topic string").write.parquet(f"{root}/{TOPICS['weather']}")
    write(spark, root, "traffic", message(0, id="a", speed="10"), message(30, id="b", speed="20"))
    write(spark, root, "openaq", message(10, sensor_id="s1", pm25=7.0))
    write(spark, root, "purpleair", message(50, sensor_id="p1", pm25=9.0))
    tick(15)
    assert run() == set()  # nothing is due: the clock is not far enough
    tick(18)
    assert run() == {("a", None), ("b", None)}  # the weather has sent nothing, its beats say 17:00
    # The feed comes back with a time within the hold, and is matched.
    write(spark, root, "weather", message(20, hour=17, temperature="61", windSpeed="3 mph"))
    write(spark, root, "traffic", message(15, hour=17, id="c", speed="30"))
    run()
    tick(22)
    assert run() == {("a", None), ("b", None), ("c", 61)}


def test_the_clock_ticks(spark):
    rows = heartbeat.rate_clock(spark, "1 second")
    assert rows.isStreaming and rows.columns == ["timestamp"]
    beat = heartbeat.with_heartbeat(spark.createDataFrame([("k", DAY, 1.0)], "key string, ts timestamp, v double"), spark.createDataFrame([(DAY,)], "timestamp timestamp"), "ts", "1 hour", {"key": heartbeat.MARK})
    assert sorted(map(tuple, beat.collect()), key=str) == sorted([("k", DAY, 1.0), (heartbeat.MARK, DAY - timedelta(hours=1), None)], key=str)
    assert heartbeat.without_heartbeat(beat, "key", "ts").count() == 1


# Repairs ---------------------------------------------------------------------

def rows_of(df):
    return sorted(map(str, df.where("traffic_id <> 'end'").select(BUSINESS.fieldNames()).collect()))


def test_late_rows_are_repaired_in_closed_days(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    fill(spark, root)
    flow.run_once(spark, TopicSource(root), lookup(spark), out, CFG)
    sentinel(spark, root)
    flow.run_once(spark, TopicSource(root), lookup(spark), out, CFG)
    repair.collect_late(spark, out, CFG)
    before = rows_of(spark.read.parquet(f"{out}/business"))
    # Of each feed a row that comes two days late, and of traffic one in a day that has none.
    write(spark, root, "traffic", message(20, id="late", speed="10"), message(20, day=25, id="alone", speed="10"))
    write(spark, root, "openaq", message(31, sensor_id="s3", pm25=1.0))
    write(spark, root, "weather", message(50, temperature="70", windSpeed="3 mph"))
    flow.run_once(spark, TopicSource(root), lookup(spark), out, CFG)
    assert rows_of(spark.read.parquet(f"{out}/business")) == before  # all of them were dropped
    assert repair.collect_late(spark, out, CFG) > 0
    days = repair.repair(spark, out, lookup(spark), CFG)
    assert {str(d) for d in days} == {"2026-04-25", "2026-04-26"}
    topics = {n: read_topic_batch(spark, t, TopicSource(root)) for n, t in TOPICS.items()}
    want = enrich(*flow.refined(flow.parse_feeds(topics), CFG), lookup(spark), CFG)
    spark.catalog.refreshByPath(f"{out}/business")
    assert rows_of(spark.read.parquet(f"{out}/business")) == rows_of(want)
    assert repair.repair(spark, out, lookup(spark), CFG) == [] and repair.collect_late(spark, out, CFG) == 0


def test_nothing_to_repair(spark, tmp_path):
    assert repair.stored_watermark(spark, str(tmp_path / "c")) is None
    assert repair.repair(spark, str(tmp_path / "out"), None, CFG) == []
    with pytest.raises(ValueError, match="arrived"):
        ledger.too_late(spark.range(1), ledger.LateLoad("x", "id", ()), ledger._START)


# Sketches --------------------------------------------------------------------

def test_sketches_of_parts_estimate_any_range(spark, tmp_path):
    table, kept = str(tmp_path / "table"), str(tmp_path / "sketches")
    for i in range(2):
        rows = spark.range(i * 30_000, 30_000 + i * 30_000).select(
            F.concat(F.lit("id"), F.col("id") % 40_000).alias("traffic_id"), F.concat(F.lit("c"), F.col("id") % 97).alias("h3_index"),
            F.when(F.col("id") % 3 > 0, F.concat(F.lit("s"), F.col("id") % 5_000)).alias("aq_location_id"), F.lit("Bronx").alias("traffic_borough"),
            (F.lit(DAY) + F.make_dt_interval(F.col("id") % 6)).alias("traffic_event_ts"),
        )
        rows = rows.select(*(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in BUSINESS.fields))
        parts.put_parts(rows, table, f"q1-{i:012d}", "traffic_event_ts")
        assert len(sketches.refresh(spark, table, kept).made) == 6
    for days in ((0, 5), (2, 4)):
        ends = [(DAY + timedelta(days=d)).date() for d in days]
        got, true = (sketches.distincts(spark, table, kept, *ends, exact_days=n).first() for n in (1, 99))
        assert not got.exact and true.exact
        for c in sketches.COUNTED:
            assert abs(got[c] - true[c]) <= 0.03 * true[c], c
    one = sketches.distincts(spark, table, kept, DAY.date(), DAY.date(), by="traffic_borough").collect()
    assert len(one) == 1 and one[0].exact
