"""Table reads: by path, by name, in SQL text, as a stream."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PARTITION, BATCH = "event_date", "batch_id"


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A Parquet folder (anything with a slash) or a catalog table."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def sql_over_path(path: str) -> str:
    """The FROM item that reads a Parquet folder inside SQL text."""
    return f"parquet.`{path}`"


def read_table_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """New files of a Parquet folder, at most ``max_files`` per batch where a limit is given."""
    reader = spark.readStream.format("parquet").schema(schema)
    return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).load(path)


def register_views(spark: SparkSession, folder: str, names: Iterable[str]) -> None:
    for name in names:
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)


def between(df: DataFrame, ts: str, start: Column, end: Column) -> DataFrame:
    """Inclusive time range. A table partitioned by day also gets the day range, which prunes folders."""
    df = df.where(F.col(ts).between(start, end))
    if PARTITION in df.columns:
        df = df.where(F.col(PARTITION).between(start.cast("date"), end.cast("date")))
    return df


def later_than(df: DataFrame, ts: str, start: Column) -> DataFrame:
    df = df.where(F.col(ts) >= start)
    if PARTITION in df.columns:
        df = df.where(F.col(PARTITION) >= start.cast("date"))
    return df
