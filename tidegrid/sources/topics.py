"""Raw topics as DataFrames with columns ``value, timestamp, topic``.

A topic is a Kafka topic, or a folder of files in which each row is one message.
The Kafka reader needs the Kafka connector on the class path.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.config import Settings
from tidegrid.schemas import TOPIC


@dataclass(frozen=True)
class TopicSource:
    """``location`` is the folder of message files, or the Kafka bootstrap servers."""

    location: str
    kind: str = "parquet"  # parquet | json | text | kafka
    max_files_per_trigger: int | None = None
    options: dict[str, str] = field(default_factory=dict)


def _shape(df: DataFrame, topic: str) -> DataFrame:
    if "timestamp" not in df.columns:
        df = df.withColumn("timestamp", F.col("_metadata.file_modification_time"))
    return df.select(F.col("value").cast("string").alias("value"), "timestamp", F.lit(topic).alias("topic"))


def _files(reader, source: TopicSource, path: str) -> DataFrame:
    if source.kind == "text":
        return reader.format("text").load(path)
    return reader.format(source.kind).schema(TOPIC).load(path)


def read_topic_stream(
    spark: SparkSession, topic: str, source: TopicSource, cfg: Settings = Settings(),
    starting: str = "earliest", fail_on_loss: bool = True,
) -> DataFrame:
    reader = spark.readStream
    for name, value in source.options.items():
        reader = reader.option(name, value)
    if source.kind == "kafka":
        df = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", source.location)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .option("failOnDataLoss", str(fail_on_loss).lower())
        )
        if cfg.max_offsets_per_trigger is not None:
            df = df.option("maxOffsetsPerTrigger", cfg.max_offsets_per_trigger)
        df = df.load()
    else:
        if starting != "earliest":
            # A file stream has no end to start from; newest files first would make older rows late.
            raise ValueError("a stream over files starts with the earliest")
        if source.max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", source.max_files_per_trigger)
        df = _files(reader, source, f"{source.location}/{topic}")
    return _shape(df, topic)


def read_topic_batch(spark: SparkSession, topic: str, source: TopicSource) -> DataFrame:
    """All messages from the earliest to the latest at the time of the call."""
    reader = spark.read
    for name, value in source.options.items():
        reader = reader.option(name, value)
    if source.kind == "kafka":
        df = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", source.location)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .option("endingOffsets", "latest")
            .load()
        )
    else:
        df = _files(reader, source, f"{source.location}/{topic}")
    return _shape(df, topic)
