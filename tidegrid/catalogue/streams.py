"""Streaming runs over the given tables: every source is read as a file stream until it is exhausted.

The topics are written once as message files. Each gets one more message far in
the future, which moves the watermark past all real rows at the end.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.catalogue import feeds
from tidegrid.catalogue.oracle import on_business, upto
from tidegrid.config import TOPICS
from tidegrid.functions import times
from tidegrid.operators.joins import interval_join
from tidegrid.plans.enrich import thinned
from tidegrid.plans.refine import refine_weather
from tidegrid.session import STATE_CONF, use_utc, work_dir
from tidegrid.sinks.streams import ONCE, checkpoint_path, write_daily, write_stream_parquet
from tidegrid.sources.tables import BATCH, PARTITION, read_table_stream
from tidegrid.sources.topics import TopicSource, read_topic_stream
from tidegrid.streaming import flow
from tidegrid.streaming.progress import ProgressLog
from tidegrid.streaming.replay import SENTINEL_UTC, finish
from tidegrid.upkeep.tables import compact, drop_days_before

CFG = feeds.CFG


def stream_session(spark: SparkSession) -> SparkSession:
    """Own session for state settings; the shuffle width is frozen in the checkpoint as the number of state partitions."""
    session = use_utc(spark.newSession())
    for name, value in STATE_CONF.items():
        session.conf.set(name, value)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return session


def _sentinel(name: str) -> str:
    point = '"lat": 40.7, "lon": -74.0, "latitude": 40.7, "longitude": -74.0, "link_points": "40.7,-74.0"'
    stamps = f'"timestamp": "{SENTINEL_UTC}Z", "startTime": "{SENTINEL_UTC}Z", "data_as_of": "{SENTINEL_UTC}"'
    # One message for all feeds: each schema takes the fields it knows.
    return f'{{"id": "sentinel", "sensor_id": "sentinel", "name": "sentinel", "speed": "1", "pm25": 1.0, {point}, {stamps}}}'


_messages: dict[tuple[str, str], str] = {}


def message_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder with one sub-folder of message files per topic."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _messages:
        root = work_dir(use_utc(spark), "topics")
        for name, topic in TOPICS.items():
            real = feeds.topic(spark, sf_dir, name)
            extra = spark.range(1).select(
                F.lit(_sentinel(name)).alias("value"), F.lit(SENTINEL_UTC).cast("timestamp").alias("timestamp"),
                F.lit(topic).alias("topic"),
            )
            real.write.parquet(f"{root}/{topic}")
            # Written later, so a file stream takes it last.
            extra.write.mode("append").parquet(f"{root}/{topic}")
        _messages[key] = root
    return _messages[key]


def source(spark: SparkSession, sf_dir: str) -> TopicSource:
    return TopicSource(message_files(spark, sf_dir))


_runs: dict[tuple[str, str], str] = {}


def whole_flow(spark: SparkSession, sf_dir: str) -> str:
    """Runs all eight queries of the live flow once and returns the output folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _runs:
        out = work_dir(spark, "flow")
        session = stream_session(spark)
        lookup = session.read.parquet(feeds.stored(spark, sf_dir, "lookup", lambda: feeds.lookup(spark, sf_dir)))
        log = ProgressLog(session, f"{out}/progress")
        session.streams.addListener(log)
        try:
            flow.run_once(session, source(spark, sf_dir), lookup, out, CFG)
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
            log.flush()
        finally:
            session.streams.removeListener(log)
        _runs[key] = out
    return _runs[key]


def _real(df: DataFrame, ident: str) -> DataFrame:
    """Without the message that only moves the watermark."""
    return df.where(F.coalesce(F.col(ident) != "sentinel", F.lit(True)))


def stream_enriched(spark, sf):
    """The business table as the stream wrote it."""
    table = spark.read.parquet(f"{whole_flow(spark, sf)}/business")
    return _real(table, "traffic_id").drop(PARTITION, BATCH)


def stream_quarantine(spark, sf):
    return flow.read_quarantine(spark, whole_flow(spark, sf))


def _kept(field: str) -> Column:
    """Whether the stored payload still says what the parsed field says."""
    return F.coalesce(F.get_json_object("raw_payload", f"$.{field}") == F.col(field), F.col(field).isNull()).alias("payload_kept")


def stream_raw_traffic(spark, sf):
    """Raw rows keep the payload text beside the parsed fields."""
    raw = flow.read_raw(spark, whole_flow(spark, sf), "traffic")
    return _real(raw, "id").select("id", "borough", "kafka_timestamp", _kept("id"))


def stream_raw_openaq(spark, sf):
    raw = flow.read_raw(spark, whole_flow(spark, sf), "openaq")
    return _real(raw, "sensor_id").select("sensor_id", "location_id", "value", "kafka_timestamp", _kept("sensor_id"))


def stream_raw_purpleair(spark, sf):
    raw = flow.read_raw(spark, whole_flow(spark, sf), "purpleair")
    return _real(raw, "name").select("name", "sensor_index", "kafka_timestamp", _kept("name"))


def stream_raw_weather(spark, sf):
    raw = flow.read_raw(spark, whole_flow(spark, sf), "weather")
    return _real(raw, "name").select("borough", "windSpeed", "kafka_timestamp", _kept("startTime"))


def stream_refined_traffic(spark, sf):
    traffic = spark.read.parquet(flow.refined_path(whole_flow(spark, sf), "traffic"))
    return _real(traffic, "id").select("id", "traffic_event_ts", "h3_index", "speed")


def stream_refined_aq(spark, sf):
    aq = spark.read.parquet(flow.refined_path(whole_flow(spark, sf), "air_quality"))
    return _real(aq, "aq_location_id").select("aq_source", "aq_location_id", "aq_event_ts", "h3_index", "aq_pm25_ugm3")


def _refined_paths(spark, sf):
    out = whole_flow(spark, sf)
    return f"{out}/refined/traffic", f"{out}/refined/air_quality"


def _interval_stream(spark: SparkSession, sf_dir: str, max_files: int) -> DataFrame:
    paths = _refined_paths(spark, sf_dir)
    schemas = tuple(spark.read.parquet(p).schema for p in paths)
    return flow.refined_interval_stream(stream_session(spark), *paths, schemas, 15, salt=2, max_files=max_files)


def stream_interval_inner(spark, sf):
    """Inner interval join of the stored refined tables, read as streams."""
    out = work_dir(spark, "inner")
    finish(write_stream_parquet(_interval_stream(spark, sf, 100), f"{out}/rows", f"{out}/ckpt", trigger=ONCE))
    return _real(spark.read.parquet(f"{out}/rows"), "traffic_id")


def stream_restart(spark, sf):
    """The weather join stopped after the first half of the files and restarted on the same checkpoint."""
    out = work_dir(spark, "restart")
    root = message_files(spark, sf)
    session = stream_session(spark)
    cut = F.lit("2024-01-16").cast("timestamp")
    halves = []
    for name in ("traffic", "weather"):
        topic = TOPICS[name]
        folder = f"{out}/in/{topic}"
        messages = spark.read.parquet(f"{root}/{topic}")
        messages.where(F.col("timestamp") < cut).write.parquet(folder)
        halves.append((messages.where(F.col("timestamp") >= cut), folder))

    def run() -> None:
        src = TopicSource(f"{out}/in")
        parsed = flow.parse_feeds({n: read_topic_stream(session, TOPICS[n], src, CFG) for n in ("traffic", "weather")})
        traffic = flow.refine.refine_traffic(parsed.valid["traffic"], CFG).withColumn("weather_join_key", F.lit(CFG.weather_key))
        weather = refine_weather(parsed.valid["weather"], CFG)
        joined = interval_join(
            traffic.select("id", "traffic_event_ts", "weather_join_key"),
            weather.select("weather_event_ts", "weather_join_key", "weather_temperature"),
            ["weather_join_key"], "traffic_event_ts", "weather_event_ts", 900, 900, "left", salt=CFG.weather_salt,
        ).drop("weather_join_key")
        finish(write_stream_parquet(joined, f"{out}/rows", checkpoint_path(out, "weather", 1), trigger=ONCE))

    run()
    for rest, folder in halves:
        rest.write.mode("append").parquet(folder)
    run()
    return _real(spark.read.parquet(f"{out}/rows"), "id")


def stream_without_resends(spark, sf):
    """Readings sent twice with the same time are kept once."""
    out = work_dir(spark, "resends")
    refined = _refined_paths(spark, sf)[1]
    aq = spark.read.parquet(refined)
    aq.write.parquet(f"{out}/in")
    aq.write.mode("append").parquet(f"{out}/in")
    stream = read_table_stream(stream_session(spark), f"{out}/in", aq.schema, 100)
    once = flow.without_resends(stream, ["aq_source", "aq_location_id", "aq_pm25_ugm3"], "aq_event_ts", CFG.watermark_delay)
    finish(write_stream_parquet(once, f"{out}/rows", f"{out}/ckpt", trigger=ONCE))
    rows = _real(spark.read.parquet(f"{out}/rows"), "aq_location_id")
    return rows.select("aq_source", "aq_location_id", "aq_event_ts", "aq_pm25_ugm3")


def stream_progress(spark, sf):
    """Rows that each raw query read, summed over all its batches: every message of its topic is read once."""
    log = spark.read.parquet(f"{whole_flow(spark, sf)}/progress")
    return log.where(F.col("query").startswith("raw_")).groupBy("query").agg(F.sum("rows_in").alias("rows_in"))


def _daily(spark: SparkSession, sf_dir: str, name: str):
    """A stream of refined traffic into a table by day and batch: (start, where its input goes, the table)."""
    out = work_dir(spark, name)
    session = stream_session(spark)
    rows = feeds.refined_tables(spark, sf_dir)[0].select("id", "traffic_event_ts", "speed")

    def run() -> None:
        stream = read_table_stream(session, f"{out}/in", rows.schema, 1)
        finish(write_daily(stream, f"{out}/table", f"{out}/ckpt", ONCE, "traffic_event_ts"))

    return run, rows, f"{out}/in", f"{out}/table"


def compact_streamed(spark, sf):
    """A streamed table, compacted between two runs of the stream on one checkpoint."""
    run, rows, folder, table = _daily(spark, sf, "compact")
    half = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    rows.where(half).repartition(3).write.parquet(folder)
    run()
    done = compact(spark, table)
    rows.where(~half).repartition(2).write.mode("append").parquet(folder)
    run()
    return spark.read.parquet(table).select("id", "traffic_event_ts", "speed", F.lit(done.files_after < done.files_before).alias("fewer_files"))


def versions_streamed(spark, sf):
    """Two versions of a query, each with its own checkpoint, on one table that is compacted between and after them."""
    out = work_dir(spark, "versions")
    session = stream_session(spark)
    rows = feeds.refined_tables(spark, sf)[0].select("id", "traffic_event_ts", "speed")
    for version in (1, 2):
        mine = F.pmod(F.xxhash64("id"), F.lit(3)) < 2 if version == 1 else F.pmod(F.xxhash64("id"), F.lit(3)) == 2
        rows.where(mine).repartition(3).write.parquet(f"{out}/in{version}")
        stream = read_table_stream(session, f"{out}/in{version}", rows.schema, 1)
        finish(write_daily(stream, f"{out}/table", checkpoint_path(out, "daily", version), ONCE, "traffic_event_ts"))
        compact(spark, f"{out}/table")
    return spark.read.parquet(f"{out}/table").select("id", "traffic_event_ts", "speed")


def flow_compacted(spark, sf):
    """The live flow over the first half of the messages, all its tables compacted, then the flow over the rest."""
    out = work_dir(spark, "kept-up")
    session = stream_session(spark)
    lookup = session.read.parquet(feeds.stored(spark, sf, "lookup", lambda: feeds.lookup(spark, sf)))
    root = message_files(spark, sf)
    cut = F.lit("2024-01-16").cast("timestamp")
    fewer = []
    for later in (False, True):
        for topic in TOPICS.values():
            messages = spark.read.parquet(f"{root}/{topic}")
            mine = F.col("timestamp") >= cut if later else F.col("timestamp") < cut
            for part in range(1 if later else 3):
                some = messages.where(mine if later else mine & (F.pmod(F.xxhash64("value"), F.lit(3)) == part))
                some.repartition(2).write.mode("append").parquet(f"{out}/in/{topic}")
        if later:
            flow.run_once(session, TopicSource(f"{out}/in"), lookup, out, CFG)
            break
        # Two files a batch, so that there are batches to put together.
        flow.run_once(session, TopicSource(f"{out}/in", max_files_per_trigger=2), lookup, out, CFG)
        for feed in TOPICS:
            fewer.append(compact(spark, flow.raw_path(out, feed), more=(flow.BROKEN,)))
        for name in flow.REFINED:
            fewer.append(compact(spark, flow.refined_path(out, name)))
        fewer.append(compact(spark, f"{out}/business"))
    rows = _real(spark.read.parquet(f"{out}/business"), "traffic_id").select("traffic_id", "traffic_event_ts", "aq_source", "aq_location_id", "aq_event_ts", "weather_event_ts")
    raw = flow.read_raw(spark, out, "traffic").count()
    return rows.withColumns({"fewer_files": F.lit(all(c.files_after <= c.files_before for c in fewer) and any(c.partitions for c in fewer)), "raw_rows": F.lit(raw - 1)})


def stream_thinned(spark, sf):
    """Readings of a stream thinned to one per station and quarter of an hour: how many rows each bin keeps."""
    out = work_dir(spark, "thinned")
    aq = spark.read.parquet(_refined_paths(spark, sf)[1]).drop(PARTITION, BATCH)
    aq.write.parquet(f"{out}/in")
    aq.write.mode("append").parquet(f"{out}/in")
    stream = read_table_stream(stream_session(spark), f"{out}/in", aq.schema, 100).withWatermark("aq_event_ts", CFG.watermark_delay)
    cfg = replace(CFG, thin_seconds=900)
    finish(write_stream_parquet(thinned(stream, ["aq_source", "aq_location_id"], "aq_event_ts", cfg), f"{out}/rows", f"{out}/ckpt", trigger=ONCE))
    rows = _real(spark.read.parquet(f"{out}/rows"), "aq_location_id")
    return rows.groupBy("aq_source", "aq_location_id", times.time_bin(F.col("aq_event_ts"), 900).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def retention_streamed(spark, sf):
    """A streamed table whose older days were removed, and the stream started again on its checkpoint."""
    run, rows, folder, table = _daily(spark, sf, "retention")
    rows.repartition(2).write.parquet(folder)
    run()
    drop_days_before(spark, table, "2024-01-15", really=True)
    run()
    return spark.read.parquet(table).select("id", "traffic_event_ts", "speed")


QUERIES = {
    "stream_enriched": (stream_enriched, on_business("SELECT * FROM business")),
    "stream_quarantine": (
        stream_quarantine,
        """SELECT CASE event_type WHEN 'view' THEN 'nyc_traffic_raw' WHEN 'click' THEN 'nyc_openaq_raw'
          WHEN 'error' THEN 'nyc_purpleair_raw' ELSE 'nyc_weather_raw' END AS source_topic,
          ts + INTERVAL 20 SECOND AS kafka_timestamp, '{"event": ' || event_id || ', "cut": "' AS raw_payload
        FROM events WHERE event_type IN ('view', 'click', 'error', 'signup') AND event_id % 10 = 0""",
    ),
    "stream_raw_traffic": (
        stream_raw_traffic,
        upto("traffic_raw", "SELECT id, borough, arrived AS kafka_timestamp, true AS payload_kept FROM traffic_raw"),
    ),
    "stream_raw_openaq": (
        stream_raw_openaq,
        """SELECT CASE WHEN event_id % 3 <> 0 THEN cast(user_id as varchar) END AS sensor_id,
          CASE WHEN event_id % 6 <> 0 THEN user_id + 1000 END AS location_id, value * cast(5 as double) AS value,
          ts + INTERVAL 20 SECOND AS kafka_timestamp, true AS payload_kept
        FROM events WHERE event_type = 'click' AND event_id % 10 <> 0""",
    ),
    "stream_raw_purpleair": (
        stream_raw_purpleair,
        """SELECT 'node ' || user_id AS name, user_id AS sensor_index, ts + INTERVAL 20 SECOND AS kafka_timestamp, true AS payload_kept
        FROM events WHERE event_type = 'error' AND event_id % 10 <> 0""",
    ),
    "stream_raw_weather": (
        stream_raw_weather,
        """SELECT lower(r_name) AS borough, CASE WHEN k % 4 = 0 THEN 'calm' WHEN k % 7 <> 0 THEN k || ' mph' END AS "windSpeed",
          ts + INTERVAL 20 SECOND AS kafka_timestamp, true AS payload_kept
        FROM (SELECT *, cast(json_extract_string(props, '$.k') as int) AS k FROM events) JOIN region ON r_regionkey = user_id % 5
        WHERE event_type = 'signup' AND event_id % 10 <> 0""",
    ),
    "stream_refined_traffic": (
        stream_refined_traffic,
        upto("traffic", "SELECT id, event_ts AS traffic_event_ts, cell AS h3_index, speed FROM traffic"),
    ),
    "stream_refined_aq": (
        stream_refined_aq,
        upto("aq", "SELECT aq_source, aq_location_id, aq_event_ts, cell AS h3_index, pm25 AS aq_pm25_ugm3 FROM aq"),
    ),
    "stream_interval_inner": (
        stream_interval_inner,
        upto(
            "aq",
            """SELECT id AS traffic_id, t.cell AS h3_index, event_ts AS traffic_event_ts, aq_event_ts,
            speed AS traffic_speed, pm25 AS aq_pm25_ugm3 FROM traffic t JOIN aq ON t.cell = aq.cell
            AND aq_event_ts >= event_ts - INTERVAL 15 MINUTE AND aq_event_ts <= event_ts + INTERVAL 15 MINUTE""",
        ),
    ),
    "stream_restart": (
        stream_restart,
        upto(
            "weather",
            """SELECT id, event_ts AS traffic_event_ts, weather_event_ts, weather_temperature FROM traffic
            LEFT JOIN weather ON weather_event_ts >= event_ts - INTERVAL 15 MINUTE
            AND weather_event_ts <= event_ts + INTERVAL 15 MINUTE""",
        ),
    ),
    "stream_without_resends": (
        stream_without_resends,
        upto("aq", "SELECT DISTINCT aq_source, aq_location_id, aq_event_ts, pm25 AS aq_pm25_ugm3 FROM aq"),
    ),
    "stream_progress": (
        stream_progress,
        """SELECT CASE event_type WHEN 'view' THEN 'raw_traffic' WHEN 'click' THEN 'raw_openaq'
          WHEN 'error' THEN 'raw_purpleair' ELSE 'raw_weather' END AS query, count(*) + 1 AS rows_in
        FROM events WHERE event_type IN ('view', 'click', 'error', 'signup') GROUP BY 1""",
    ),
    "compact_streamed": (
        compact_streamed,
        upto("traffic", "SELECT id, event_ts AS traffic_event_ts, speed, true AS fewer_files FROM traffic"),
    ),
    "versions_streamed": (
        versions_streamed,
        upto("traffic", "SELECT id, event_ts AS traffic_event_ts, speed FROM traffic"),
    ),
    "flow_compacted": (
        flow_compacted,
        on_business(
            """SELECT traffic_id, traffic_event_ts, aq_source, aq_location_id, aq_event_ts, weather_event_ts, true AS fewer_files,
            (SELECT count(*) FROM events WHERE event_type = 'view' AND event_id % 10 <> 0) AS raw_rows FROM business"""
        ),
    ),
    "stream_thinned": (
        stream_thinned,
        upto("aq", "SELECT DISTINCT aq_source, aq_location_id, time_bucket(INTERVAL 15 MINUTE, aq_event_ts) AS bin, 1 AS n FROM aq"),
    ),
    "retention_streamed": (
        retention_streamed,
        upto("traffic", "SELECT id, event_ts AS traffic_event_ts, speed FROM traffic WHERE event_ts >= TIMESTAMP '2024-01-15'"),
    ),
}

__all__ = ["QUERIES", "message_files", "stream_session", "whole_flow"]
