import json
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidegrid import Settings, schemas
from tidegrid.config import TOPICS
from tidegrid.plans.enrich import enrich, thinned
from tidegrid.sinks import ddl, parts
from tidegrid.sinks.streams import ONCE, write_daily, write_memory
from tidegrid.sources.topics import TopicSource, read_topic_batch, read_topic_stream
from tidegrid.streaming import flow
from tidegrid.streaming.progress import ProgressLog, recent_progress_rows
from tidegrid.streaming.replay import finish

CFG = Settings(aq_salt=2, weather_salt=2)
POINT = {"lat": 40.7, "lon": -74.0, "latitude": 40.7, "longitude": -74.0, "link_points": "40.7,-74.0"}


def message(minute, hour=15, day=26, **fields):
    """A message at a UTC time of 2026-04-26; local time is four hours behind."""
    utc = datetime(2026, 4, day, hour, minute)
    local = datetime(2026, 4, day, hour - 4, minute)
    stamp = utc.strftime("%Y-%m-%dT%H:%M:%SZ")
    return {
        **POINT, "data_as_of": local.strftime("%Y-%m-%dT%H:%M:%S.000"), "timestamp": stamp, "startTime": stamp, **fields,
    }


def write(spark, root, feed, *records):
    rows = [(json.dumps(r) if isinstance(r, dict) else r, datetime(2026, 4, 26, 16), TOPICS[feed]) for r in records]
    spark.createDataFrame(rows, schemas.TOPIC).coalesce(1).write.mode("append").parquet(f"{root}/{TOPICS[feed]}")


def fill(spark, root):
    write(spark, root, "traffic", message(0, id="a", speed="10"), message(30, id="b", speed="20"), message(59, id="far", speed="5"), "{cut")
    write(spark, root, "openaq", message(10, sensor_id="s1", pm25=7.0), message(15, sensor_id="s2", pm25=8.0))
    write(spark, root, "purpleair", message(50, sensor_id="p1", pm25=9.0))
    write(spark, root, "weather", message(5, temperature="61", windSpeed="3 mph"))


def lookup(spark):
    return spark.createDataFrame([("hx1200_0_0", True, False, True)], "h3_lookup_index string, is_in_congestion_zone boolean, is_near_truck_route boolean, is_near_high_emission_bldg boolean")


def sentinel(spark, root):
    for feed in TOPICS:
        write(spark, root, feed, message(0, day=28, id="end", sensor_id="end", speed="1", pm25=1.0))


def rows_in(log, name):
    return log.rows().where(F.col("query") == name).agg(F.sum("rows_in")).first()[0]


def test_streamed_result_equals_bounded_result(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    fill(spark, root)
    log = ProgressLog(spark, str(tmp_path / "progress"), every=3)
    spark.streams.addListener(log)
    try:
        flow.run_once(spark, TopicSource(root), lookup(spark), out, CFG)
        sentinel(spark, root)
        queries = flow.run_once(spark, TopicSource(root), lookup(spark), out, CFG)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(log)
    assert len(queries) == 8
    topics = {n: read_topic_batch(spark, t, TopicSource(root)) for n, t in TOPICS.items()}
    tables = flow.refined(flow.parse_feeds(topics), CFG)
    want = enrich(*tables, lookup(spark), CFG).where("traffic_id <> 'end'")
    got = spark.read.parquet(f"{out}/business").drop("event_date", "batch_id").where("traffic_id <> 'end'")
    assert got.columns == schemas.BUSINESS.fieldNames()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    ids = sorted((r.traffic_id, r.aq_location_id, r.weather_temperature) for r in got.select("traffic_id", "aq_location_id", "weather_temperature").collect() if r)
    assert ids == [("a", "s1", 61), ("a", "s2", 61), ("b", "s2", None), ("far", "p1", None)]
    assert got.where("is_congestion_zone and not is_truck_route").count() == 4
    assert [r.raw_payload for r in flow.read_quarantine(spark, out).collect()] == ["{cut"]
    raw = flow.read_raw(spark, out, "traffic")
    assert "raw_payload" in raw.columns and raw.count() == 4
    # Every message is read once, by the query of its topic; later stages read stored rows.
    assert {n: rows_in(log, f"raw_{n}") for n in TOPICS} == {"traffic": 5, "openaq": 3, "purpleair": 2, "weather": 2}
    assert rows_in(log, "refined_traffic") == 4 and rows_in(log, "refined_air_quality") == 5
    assert recent_progress_rows(spark, queries["business"]).agg(F.sum("rows_in")).first()[0] >= 3


def test_progress_of_all_batches_is_kept(spark, tmp_path):
    """More batches than Spark itself retains."""
    log = ProgressLog(spark, str(tmp_path / "progress"), every=4)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 3)
    try:
        for i in range(9):
            spark.range(i + 1).withColumn("v", F.lit("x")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        spark.streams.addListener(log)
        stream = spark.readStream.schema("id bigint, v string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = stream.writeStream.format("noop").queryName("many").option("checkpointLocation", str(tmp_path / "c")).trigger(**ONCE).start()
        finish(query)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        assert len(query.recentProgress) <= 3
        assert rows_in(log, "many") == 45 and log.rows().where("rows_in > 0").count() == 9
    finally:
        spark.streams.removeListener(log)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_late_rows_are_dropped_from_the_join_but_kept_raw(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    fill(spark, root)
    for q in (0, 1, 2):
        if q == 1:
            for feed in TOPICS:
                write(spark, root, feed, message(0, hour=20, id="next", sensor_id="next", speed="1", pm25=1.0))
        if q == 2:
            write(spark, root, "traffic", message(1, id="late", speed="10"))
        queries = flow.run_once(spark, TopicSource(root), lookup(spark), out, CFG)
    dropped = recent_progress_rows(spark, queries["business"]).agg(F.sum("rows_dropped_by_watermark")).first()[0]
    business = {r[0] for r in spark.read.parquet(f"{out}/business").select("traffic_id").collect()}
    raw = {r[0] for r in flow.read_raw(spark, out, "traffic").select("id").collect()}
    assert "late" in raw and "late" not in business and dropped >= 1
    assert {"a", "b", "far"} <= business


def stored_stages(spark, root, out):
    fill(spark, root)
    finish(*flow.start_raw(spark, TopicSource(root), out, CFG, ONCE).values())
    finish(*flow.start_refined(spark, out, CFG, ONCE).values())


def test_unmatched_rows_wait_for_the_watermark(spark, tmp_path):
    stored_stages(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    query = write_memory(flow.business_rows(spark, str(tmp_path / "out"), lookup(spark), CFG), "waiting", ONCE)
    finish(query)
    assert {r[0] for r in spark.table("waiting").select("traffic_id").collect()} <= {"a"}


def test_plan_of_the_business_query(spark, tmp_path):
    stored_stages(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    rows = flow.business_rows(spark, str(tmp_path / "out"), lookup(spark), CFG)
    query = rows.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(**ONCE).start()
    finish(query)
    plan = query._jsq.explainInternal(False)
    assert plan.count("StreamingSymmetricHashJoin") >= 2
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "from_json" not in plan


def test_live_queries_start_side_by_side(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    fill(spark, root)
    queries = flow.start_all(spark, TopicSource(root), lookup(spark), out, CFG, {"processingTime": "1 second"})
    try:
        assert len(queries) == 8
        for _ in range(60):
            if all(q.isActive and q.lastProgress for q in queries.values()):
                break
            time.sleep(1)
        assert all(q.isActive and q.exception() is None for q in queries.values())
    finally:
        for q in queries.values():
            q.stop()


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    t, ckpt = str(tmp_path / "t"), tmp_path / "c"
    day = datetime(2026, 5, 1, 12)
    spark.createDataFrame([(1, day), (2, day)], "id int, ts timestamp").write.parquet(str(tmp_path / "in"))

    def run():
        stream = spark.readStream.schema("id int, ts timestamp").parquet(str(tmp_path / "in"))
        finish(write_daily(stream, t, str(ckpt), ONCE, "ts"))

    run()
    (ckpt / "commits" / "0").unlink()  # as after a failure between the write and the commit
    for crc in (ckpt / "commits").glob(".0.crc"):
        crc.unlink()
    run()
    assert sorted(r.id for r in spark.read.parquet(t).collect()) == [1, 2]


def test_live_thinning_refuses_bins_longer_than_its_memory(spark, tmp_path):
    spark.createDataFrame([("a", "1", datetime(2026, 5, 1))], "aq_source string, aq_location_id string, aq_event_ts timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("aq_source string, aq_location_id string, aq_event_ts timestamp").parquet(str(tmp_path / "in"))
    stream = stream.withWatermark("aq_event_ts", "15 minutes")
    with pytest.raises(ValueError, match="longer than the watermark delay"):
        thinned(stream, ["aq_source", "aq_location_id"], "aq_event_ts", Settings(thin_seconds=3600))
    assert thinned(stream, ["aq_source", "aq_location_id"], "aq_event_ts", Settings(thin_seconds=900)).isStreaming


def test_a_new_reader_refuses_merged_parts(spark, tmp_path):
    out = str(tmp_path / "out")
    (tmp_path / "out" / "event_date=2026-05-01" / "batch_id=merged-1").mkdir(parents=True)
    with pytest.raises(parts.MergedParts):
        parts.refuse_late_reader(spark, out, str(tmp_path / "c"))
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "metadata").write_text('{"id": "x"}')
    parts.refuse_late_reader(spark, out, str(tmp_path / "c"))


def test_newest_first_is_refused_for_files(spark, tmp_path):
    with pytest.raises(ValueError, match="earliest"):
        read_topic_stream(spark, TOPICS["traffic"], TopicSource(str(tmp_path)), starting="latest")


@pytest.mark.parametrize("kind", ["json", "text"])
def test_other_message_formats(spark, tmp_path, kind):
    folder = tmp_path / TOPICS["traffic"]
    df = spark.createDataFrame([('{"id": "1"}', datetime(2026, 1, 1), "x")], schemas.TOPIC)
    (df.write.json(str(folder)) if kind == "json" else df.select("value").write.text(str(folder)))
    source = TopicSource(str(tmp_path), kind)
    batch = read_topic_batch(spark, TOPICS["traffic"], source)
    assert [(r.value, r.topic) for r in batch.collect()] == [('{"id": "1"}', TOPICS["traffic"])]
    query = write_memory(read_topic_stream(spark, TOPICS["traffic"], source), f"m_{kind}", ONCE)
    finish(query)
    assert spark.table(f"m_{kind}").count() == 1


def test_table_definition_and_reset(spark, tmp_path):
    assert "days(traffic_event_ts)" in ddl.business_ddl("local.db.t", "iceberg")
    ddl.ensure_business_table(spark, "default.enriched", location=str(tmp_path / "t"))
    ddl.ensure_business_table(spark, "default.enriched", location=str(tmp_path / "t"))
    assert spark.table("default.enriched").columns[:34] == schemas.BUSINESS.fieldNames()
    with pytest.raises(ValueError):
        ddl.reset_table(spark, "default.enriched")
    ddl.reset_table(spark, "default.enriched", really=True)
    assert not spark.catalog.tableExists("default.enriched")
