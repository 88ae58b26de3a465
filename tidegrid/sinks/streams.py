"""Append sinks of the streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidegrid.sinks.parts import batch_name, files, put_parts, run_of, with_event_date

ONCE = {"availableNow": True}


def every(interval: str) -> dict:
    return {"processingTime": interval}


def checkpoint_path(root: str, name: str, version: int) -> str:
    """State and schema changes need a new checkpoint: raise the version."""
    return f"{root.rstrip('/')}/checkpoints/{name}_v{version}"


def write_stream_parquet(
    df: DataFrame, path: str, checkpoint: str, name: str | None = None, trigger: dict | None = None,
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def write_daily(
    df: DataFrame, path: str, checkpoint: str, trigger: dict, ts: str, name: str | None = None, more: tuple[str, ...] = (),
    mode: str = "append", each: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Rows to a table in parts by event day and batch (see ``sinks.parts``).

    A batch that is repeated after a failure adds no row twice. Batches are
    named by the run that its checkpoint holds: a new version with a new
    checkpoint adds to the table and replaces nothing. ``each`` is applied to
    every batch, for joins with tables that change meanwhile.
    """
    run: list[str] = []

    def put(batch: DataFrame, batch_id: int) -> None:
        if not run:
            run.append(run_of(batch.sparkSession, checkpoint))
        put_parts(each(batch) if each else batch, path, batch_name(run[0], batch_id), ts, more)

    fs, at = files(df.sparkSession, path)
    fs.mkdirs(at(path))  # readers may start before the first part is there
    writer = df.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", checkpoint).trigger(**trigger)
    return (writer.queryName(name) if name else writer).start()


def write_business(
    df: DataFrame, target: str, checkpoint: str, trigger: dict, name: str = "business", provider: str = "parquet",
    each: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Business rows to a Parquet folder by event day and batch, or to a catalog table of another provider.

    A table with its own day partition transform (Iceberg) takes the 34 columns as they are.
    """
    if provider == "parquet":
        return write_daily(df, target, checkpoint, trigger, "traffic_event_ts", name, each=each)
    if each is not None:
        raise ValueError("batches are only changed on the way to a table in parts")
    writer = df.writeStream.format(provider).outputMode("append").queryName(name).trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint).toTable(target)


def write_memory(df: DataFrame, name: str, trigger: dict | None = None) -> StreamingQuery:
    """For probes and tests: the rows land on the driver."""
    writer = df.writeStream.format("memory").queryName(name).outputMode("append")
    return (writer.trigger(**trigger) if trigger else writer).start()


__all__ = [
    "ONCE", "checkpoint_path", "every", "with_event_date", "write_business", "write_daily", "write_memory", "write_stream_parquet",
]
