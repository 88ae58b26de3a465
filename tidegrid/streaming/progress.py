"""Progress of streaming queries as rows."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = (
    "query string, batch_id bigint, rows_in bigint, rows_per_second double, trigger_ms bigint,"
    " state_rows bigint, rows_dropped_by_watermark bigint, watermark string"
)


def _row(progress) -> tuple:
    state = progress.stateOperators
    return (
        progress.name or f"stream_{str(progress.id)[:8]}",
        progress.batchId,
        progress.numInputRows,
        float(progress.processedRowsPerSecond),
        progress.durationMs.get("triggerExecution"),
        sum(s.numRowsTotal for s in state),
        sum(s.numRowsDroppedByWatermark for s in state),
        progress.eventTime.get("watermark"),
    )


def fail_on_error(query: StreamingQuery) -> None:
    error = query.exception()
    if error is not None:
        raise RuntimeError(f"query {query.id} failed") from error


def recent_progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The progress records that Spark itself still retains of a query; raises when the query has failed.

    A long run has more batches than that: ``ProgressLog`` keeps them all.
    """
    fail_on_error(query)
    return spark.createDataFrame([_row(p) for p in query.recentProgress], SCHEMA)


class ProgressLog(StreamingQueryListener):
    """Appends the progress of every batch of all queries to a table; register with ``spark.streams.addListener``.

    Records wait on the driver until ``every`` of them are there or a query
    ends, so what it holds is bounded and the table has no file per batch.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 200):
        self._spark, self.path, self._every = spark, path, every
        self._waiting: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._waiting.append(_row(event.progress))
        if len(self._waiting) >= self._every:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        with self._lock:
            rows, self._waiting = self._waiting, []
            if rows:
                self._spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        """All records so far."""
        self.flush()
        return self._spark.read.schema(SCHEMA).parquet(self.path)
