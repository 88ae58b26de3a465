"""Bounded runs of a stream: process what is there, then stop."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQuery

from tidegrid.streaming.progress import fail_on_error

# A message this far ahead in every source moves the watermark past all real
# rows, so outer joins release their unmatched rows. Drop it from the result.
SENTINEL_UTC = "2100-01-01T00:00:00.000"


def finish(*queries: StreamingQuery) -> None:
    for query in queries:
        query.awaitTermination()
        fail_on_error(query)
