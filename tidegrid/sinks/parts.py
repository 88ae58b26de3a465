"""Tables in parts: a Parquet folder by event day and batch, written by streams and kept up beside them.

A part is the folder of one day and one batch. It appears at once and whole, by
a rename, and never changes afterwards: a batch that is repeated after a failure
leaves the parts that are there alone and adds those that are missing. So
streams that read the table meet each row once. The name of a batch says which
run wrote it (a checkpoint has one run, a new checkpoint another one), so a run
never meets parts of another. Parts that upkeep has put together are named
``merged-…``; they hold rows that readers of the live parts have had.

Renames of folders must be atomic, as on HDFS; on an object store use a table
format instead.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from tidegrid.sources.tables import BATCH, PARTITION

MERGED = "merged"


def files(spark: SparkSession, path: str):
    """Hadoop's file system of a path and the constructor of its paths: for renames and deletes of whole folders."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """The folders that a pattern names; none where nothing is there."""
    fs, at = files(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(at(pattern)) or () if s.isDirectory())


def parts(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(day, batch) of all parts, from the folder names."""
    found = folders(spark, f"{path.rstrip('/')}/{PARTITION}=*/{BATCH}=*")
    return [tuple(x.split("=", 1)[1] for x in f.rsplit("/", 2)[1:]) for f in found]


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """Short name of the run that a checkpoint holds; a checkpoint that is made anew has another one."""
    ident = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]
    return "q" + ident.replace("-", "")[:12]


def batch_name(run: str, batch_id: int) -> str:
    return f"{run}-{batch_id:012d}"


def merged_name() -> str:
    return f"{MERGED}-{uuid.uuid4().hex[:12]}"


def is_merged() -> Column:
    return F.col(BATCH).startswith(MERGED)


def newest_batches(found: Iterable[tuple[str, str]]) -> list[str]:
    """The last batch of each run, which the run may repeat after a restart."""
    last: dict[str, str] = {}
    for _, batch in found:
        run = batch.rsplit("-", 1)[0]
        if run != MERGED and "-" in batch:
            last[run] = max(last.get(run, ""), batch)
    return sorted(last.values())


def with_event_date(df: DataFrame, ts: str = "traffic_event_ts") -> DataFrame:
    return df.withColumn(PARTITION, F.col(ts).cast("date"))


def put_parts(rows: DataFrame, path: str, batch: str, ts: str, more: tuple[str, ...] = ()) -> None:
    """Adds the parts of a batch, by the day of ``ts``; ``more`` are columns by which a part is divided further."""
    add_parts(with_event_date(rows, ts).withColumn(BATCH, F.lit(batch)), path, batch, more)


def add_parts(rows: DataFrame, path: str, name: str, more: tuple[str, ...] = ()) -> None:
    """Adds the parts that ``event_date`` and ``batch_id`` of ``rows`` name; parts that are there stay as they are.

    Rows are written beside the parts first, in a folder of this ``name``, where no reader looks.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    waiting = f"{path}/_staging/{name}"
    rows.write.mode("overwrite").partitionBy(PARTITION, BATCH, *more).parquet(waiting)
    fs, at = files(spark, path)
    for ready in folders(spark, f"{waiting}/{PARTITION}=*/{BATCH}=*"):
        day, part = ready.rsplit("/", 2)[1:]
        target = at(f"{path}/{day}/{part}")
        if fs.exists(target):
            continue
        fs.mkdirs(at(f"{path}/{day}"))
        if not fs.rename(at(ready), target):
            raise OSError(f"{ready} cannot be moved to {target}")
    fs.delete(at(waiting), True)


def part_schema(schema: StructType, more: tuple[str, ...] = ()) -> StructType:
    """``schema`` with the columns that folders name, in the order of the folders.

    A stream takes columns by position, and those of folders come last, so the
    order has to be right before the first part is there. Stored columns may be
    NULL, whatever the plan that wrote them says.
    """
    own = [StructField(f.name, f.dataType) for f in schema.fields if f.name not in (PARTITION, BATCH, *more)]
    return StructType([*own, StructField(PARTITION, DateType()), StructField(BATCH, StringType()), *(schema[c] for c in more)])


class MergedParts(RuntimeError):
    pass


def read_parts_stream(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None, more: tuple[str, ...] = ()
) -> DataFrame:
    """The live parts as a stream, in the columns of ``schema``: each row once, whatever upkeep does meanwhile."""
    reader = spark.readStream.format("parquet").schema(part_schema(schema, more))
    rows = (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).load(path)
    return rows.where(~is_merged()).select(*(F.col(f"`{f.name}`") for f in schema.fields if f.name not in (PARTITION, BATCH)))


def refuse_late_reader(spark: SparkSession, path: str, checkpoint: str) -> None:
    """A query with a new checkpoint would not see merged parts: it must take them in a batch first (``upkeep.repair``)."""
    fs, at = files(spark, checkpoint)
    if not fs.exists(at(f"{checkpoint.rstrip('/')}/metadata")) and folders(spark, f"{path.rstrip('/')}/{PARTITION}=*/{BATCH}={MERGED}*"):
        raise MergedParts(f"{path} has merged parts, which a new stream does not read; see upkeep.repair")
