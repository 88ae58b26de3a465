"""The live flow in three stages: topics to raw tables, raw to refined tables, refined to the business table.

Each topic is read and parsed by one query, which stores the parsed fields, the
payload text and whether the message is broken. What comes later reads stored
columns only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StringType, StructField, StructType, TimestampType

from tidegrid.config import TOPICS, Settings
from tidegrid.operators.joins import interval_join
from tidegrid.operators.parse import parse_json, quarantine, split_valid, with_broken_mark
from tidegrid.plans import enrich as enriching
from tidegrid.plans import refine, versions
from tidegrid.schemas import FEEDS
from tidegrid.sinks.parts import part_schema, read_parts_stream, refuse_late_reader
from tidegrid.sinks.streams import checkpoint_path, every, write_business, write_daily
from tidegrid.sources.tables import BATCH, PARTITION, read_table_stream
from tidegrid.sources.topics import TopicSource, read_topic_stream
from tidegrid.streaming.heartbeat import MARK, kept_above, with_heartbeat, without_heartbeat
from tidegrid.streaming.replay import finish

SCHEMA_VERSION = 3
BROKEN = "broken"
_ARRIVAL = ["source_topic", "kafka_timestamp", "raw_payload"]


def with_event_time(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermark on an event time; set it once per stream, after unions."""
    return df.withWatermark(column, delay)


@dataclass
class Feeds:
    """Parsed feeds and the broken messages of all of them."""

    valid: dict[str, DataFrame]
    broken: DataFrame


def parse_feeds(topics: dict[str, DataFrame], keep_payload: bool = False) -> Feeds:
    parts = {name: split_valid(parse_json(df, FEEDS[name]), keep_payload) for name, df in topics.items()}
    return Feeds({n: v for n, (v, _) in parts.items()}, quarantine(*(b for _, b in parts.values())))


def raw_rows(topic: DataFrame, feed: str) -> DataFrame:
    """All messages of a topic: parsed fields (NULL where broken), payload, arrival, and the ``broken`` mark."""
    marked = with_broken_mark(parse_json(topic, FEEDS[feed]), BROKEN)
    fields = (F.when(~F.col(BROKEN), F.col("payload")[f.name]).alias(f.name) for f in FEEDS[feed].fields)
    return marked.select(*fields, *_ARRIVAL, BROKEN)


def raw_schema(feed: str) -> StructType:
    own = [StructField("source_topic", StringType()), StructField("kafka_timestamp", TimestampType()), StructField("raw_payload", StringType())]
    return StructType([*FEEDS[feed].fields, *own, StructField(BROKEN, BooleanType())])


def raw_path(out: str, feed: str) -> str:
    return f"{out}/raw/{feed}"


def read_raw(spark: SparkSession, out: str, feed: str) -> DataFrame:
    """The valid rows of a stored raw table, payload included."""
    rows = spark.read.schema(part_schema(raw_schema(feed), (BROKEN,))).parquet(raw_path(out, feed))
    return rows.where(~F.col(BROKEN)).drop(BROKEN, "source_topic", PARTITION, BATCH)


def read_quarantine(spark: SparkSession, out: str) -> DataFrame:
    """The broken messages of all raw tables; only their partitions are read."""
    parts = (
        spark.read.schema(part_schema(raw_schema(feed), (BROKEN,))).parquet(raw_path(out, feed)).where(F.col(BROKEN)).select(*_ARRIVAL)
        for feed in TOPICS
    )
    return reduce(DataFrame.unionByName, parts)


def _raw_stream(spark: SparkSession, out: str, feed: str) -> DataFrame:
    rows = read_parts_stream(spark, raw_path(out, feed), raw_schema(feed), more=(BROKEN,))
    return rows.where(~F.col(BROKEN)).drop(BROKEN, "source_topic", "raw_payload")


def refined(feeds: Feeds, cfg: Settings = Settings()) -> tuple[DataFrame, DataFrame, DataFrame]:
    valid = feeds.valid
    return (
        refine.refine_traffic(valid["traffic"], cfg),
        refine.refine_air_quality(valid["openaq"], valid["purpleair"], cfg),
        refine.refine_weather(valid["weather"], cfg),
    )


REFINED = {"traffic": "traffic_event_ts", "air_quality": "aq_event_ts", "weather": "weather_event_ts"}
_FEEDS_OF = {"traffic": ("traffic",), "air_quality": ("openaq", "purpleair"), "weather": ("weather",)}


def refined_path(out: str, name: str) -> str:
    return f"{out}/refined/{name}"


def _refined_plans(spark: SparkSession, out: str, cfg: Settings) -> dict[str, DataFrame]:
    rows = Feeds({feed: _raw_stream(spark, out, feed) for feed in TOPICS}, None)
    return dict(zip(REFINED, refined(rows, cfg), strict=True))


#: Per refined table what a heartbeat has beside its time: keys that meet no row, not even another feed's beat.
_BEATS = {
    "traffic": {"id": MARK, "h3_index": f"{MARK} of traffic", "borough": MARK},
    "air_quality": {"h3_index": f"{MARK} of air quality", "aq_source": MARK, "aq_location_id": MARK},
    "weather": {"weather_join_key": f"{MARK} of weather", "weather_period_name": MARK},
}


def business_rows(
    spark: SparkSession, out: str, lookup: DataFrame, cfg: Settings = Settings(), clock: DataFrame | None = None
) -> DataFrame:
    """The business rows as a stream over the stored refined tables.

    With a ``clock`` (``heartbeat.rate_clock``) and ``cfg.idle_hold`` no feed
    that falls silent holds back the rows of the others for longer than that.
    """
    plans = _refined_plans(spark, out, cfg)
    tables = {}
    for name, ts in REFINED.items():
        rows = read_parts_stream(spark, refined_path(out, name), plans[name].schema)
        if clock is not None:
            rows = with_heartbeat(rows, clock, ts, cfg.idle_hold, _BEATS[name])
        tables[name] = with_event_time(rows, ts, cfg.watermark_delay)
        if clock is not None:
            tables[name] = kept_above(tables[name], ts, "weather_join_key" if name == "weather" else "h3_index")
    rows = enriching.enrich(*tables.values(), lookup, cfg)
    return rows if clock is None else without_heartbeat(rows, "traffic_id", "traffic_event_ts")


def start_raw(spark: SparkSession, source: TopicSource, out: str, cfg: Settings = Settings(), trigger: dict | None = None) -> dict[str, StreamingQuery]:
    """One query per topic: the only ones that read and parse messages."""
    return {
        f"raw_{feed}": write_daily(
            raw_rows(read_topic_stream(spark, topic, source, cfg), feed), raw_path(out, feed),
            checkpoint_path(out, f"raw_{feed}", SCHEMA_VERSION), trigger or every(cfg.trigger), "kafka_timestamp", f"raw_{feed}", (BROKEN,),
        )
        for feed, topic in TOPICS.items()
    }


def start_refined(spark: SparkSession, out: str, cfg: Settings = Settings(), trigger: dict | None = None) -> dict[str, StreamingQuery]:
    started = {}
    for name, df in _refined_plans(spark, out, cfg).items():
        checkpoint = checkpoint_path(out, f"refined_{name}", SCHEMA_VERSION)
        for feed in _FEEDS_OF[name]:
            refuse_late_reader(spark, raw_path(out, feed), checkpoint)
        started[f"refined_{name}"] = write_daily(df, refined_path(out, name), checkpoint, trigger or every(cfg.trigger), REFINED[name], f"refined_{name}")
    return started


def start_business(
    spark: SparkSession, out: str, lookup: DataFrame | str, cfg: Settings = Settings(), trigger: dict | None = None,
    target: str | None = None, provider: str = "parquet", clock: DataFrame | None = None,
) -> dict[str, StreamingQuery]:
    """``lookup``: the flags as they are now and stay, or the path of their versions (``plans.versions``), read for each batch."""
    each = None
    if isinstance(lookup, str):
        path, lookup = lookup, versions.current(spark.createDataFrame([], versions.read_versions(spark, lookup).schema))

        def each(batch: DataFrame) -> DataFrame:
            return versions.with_versioned_flags(batch, versions.read_versions(batch.sparkSession, path))

    checkpoint = checkpoint_path(out, "business", SCHEMA_VERSION)
    for name in REFINED:
        refuse_late_reader(spark, refined_path(out, name), checkpoint)
    query = write_business(
        business_rows(spark, out, lookup, cfg, clock), target or f"{out}/business", checkpoint, trigger or every(cfg.trigger),
        provider=provider, each=each,
    )
    return {"business": query}


def start_all(
    spark: SparkSession, source: TopicSource, lookup: DataFrame | str, out: str, cfg: Settings = Settings(),
    trigger: dict | None = None, business_target: str | None = None, provider: str = "parquet", clock: DataFrame | None = None,
) -> dict[str, StreamingQuery]:
    """Eight live queries: four raw tables, three refined ones, and the business table.

    Each has its own checkpoint and restarts on its own; a later stage takes
    what the one before has stored.
    """
    trigger = trigger or every(cfg.trigger)
    return (
        start_raw(spark, source, out, cfg, trigger)
        | start_refined(spark, out, cfg, trigger)
        | start_business(spark, out, lookup, cfg, trigger, business_target, provider, clock)
    )


def run_once(
    spark: SparkSession, source: TopicSource, lookup: DataFrame | str, out: str, cfg: Settings = Settings(), trigger: dict | None = None
) -> dict[str, StreamingQuery]:
    """The same queries over what is there now: stage by stage, each until it has caught up."""
    trigger = trigger or {"availableNow": True}
    done: dict[str, StreamingQuery] = {}
    for start in (
        lambda: start_raw(spark, source, out, cfg, trigger),
        lambda: start_refined(spark, out, cfg, trigger),
        lambda: start_business(spark, out, lookup, cfg, trigger),
    ):
        queries = start()
        finish(*queries.values())
        done |= queries
    return done


def refined_interval_stream(
    spark: SparkSession, traffic_path: str, aq_path: str, schemas: tuple, minutes: int = 15, salt: int = 1,
    max_files: int | None = None,
) -> DataFrame:
    """Inner interval join of two stored refined tables, read as streams."""
    traffic = read_table_stream(spark, traffic_path, schemas[0], max_files)
    aq = read_table_stream(spark, aq_path, schemas[1], max_files)
    traffic = traffic.where(
        F.col("traffic_event_ts").isNotNull() & F.col("h3_index").isNotNull() & F.col("id").isNotNull()
    )
    aq = aq.na.drop(subset=["aq_event_ts", "h3_index", "aq_location_id", "aq_pm25_ugm3"])
    # Only what the result needs: everything else would sit in the state.
    traffic = traffic.select("id", "h3_index", "traffic_event_ts", "speed")
    aq = aq.select("h3_index", "aq_event_ts", "aq_pm25_ugm3")
    delay = f"{minutes} minutes"
    joined = interval_join(
        with_event_time(traffic, "traffic_event_ts", delay), with_event_time(aq, "aq_event_ts", delay),
        ["h3_index"], "traffic_event_ts", "aq_event_ts", minutes * 60, minutes * 60, "inner", salt=salt,
    )
    return joined.select(
        F.col("id").alias("traffic_id"), "h3_index", "traffic_event_ts", "aq_event_ts",
        F.col("speed").alias("traffic_speed"), "aq_pm25_ugm3",
    )


def without_resends(df: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drops readings a feed sends again with the same time; state is bounded by the watermark."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([*keys, ts])


__all__ = [
    "Feeds", "business_rows", "parse_feeds", "raw_rows", "read_quarantine", "read_raw", "refined",
    "refined_interval_stream", "run_once", "start_all", "start_business", "start_raw", "start_refined",
    "with_event_time", "without_resends",
]
