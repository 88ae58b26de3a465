"""JSON feeds to typed rows, with a quarantine for what does not parse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "unparsed_text"


def parse_json(topic: DataFrame, schema: StructType) -> DataFrame:
    """Adds ``payload``; columns ``value, timestamp, topic`` get their stored names."""
    target = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return topic.select(
        F.col("topic").alias("source_topic"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("value").cast("string").alias("raw_payload"),
        # Filters on the payload cannot be moved below a generator, so each text is parsed once,
        # not once more per filter that looks at the result.
        F.explode(F.array(F.from_json(F.col("value").cast("string"), target, options))).alias("payload"),
    )


def is_broken() -> F.Column:
    """NULL and empty payloads give a NULL struct; they are broken too, and so is text behind the JSON value,
    which the parser itself passes over."""
    within = lambda end: F.json_array_length(F.concat(F.lit("["), F.col("raw_payload"), F.lit(end)))
    # A text that closes the array itself shows in the second count.
    alone = (within("]") == 1) & (within(",0]") == 2)
    return (
        F.col("payload").isNull()
        | ~F.coalesce(alone, F.lit(False))
        | F.col(f"payload.{CORRUPT}").isNotNull()
        | (F.trim(F.col("raw_payload")) == "")
    )


def with_broken_mark(parsed: DataFrame, name: str = "broken") -> DataFrame:
    return parsed.withColumn(name, F.coalesce(is_broken(), F.lit(True)))


def split_valid(parsed: DataFrame, keep_payload: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid rows, broken rows). Valid rows are the payload fields and the arrival time."""
    broken = F.coalesce(is_broken(), F.lit(True))
    fields = [f.name for f in parsed.schema["payload"].dataType.fields if f.name != CORRUPT]
    valid = parsed.where(~broken).select(
        *(F.col("payload")[name].alias(name) for name in fields),
        "kafka_timestamp",
        *(["raw_payload"] if keep_payload else []),
    )
    return valid, parsed.where(broken).select("source_topic", "kafka_timestamp", "raw_payload")


def quarantine(*broken: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, broken)
