"""What became of streaming queries, kept as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from skyledger.sources.tables import read_table

EVENTS = (
    "query string, name string, event string, at string, batch bigint, rows bigint, rows_per_second double, error string"
)


class QueryLog(StreamingQueryListener):
    """Collects start, progress and end of each query of a session, and the error of a failed one.

    ``path`` is a table to which the events are added when a query ends and whenever
    ``flush_after`` of them have come, so the driver holds no more than that.
    """

    def __init__(self, spark: SparkSession, path: str, flush_after: int = 1000):
        self.spark, self.path, self.flush_after, self.events = spark, path, flush_after, []
        spark.streams.addListener(self)

    def _add(self, *event) -> None:
        self.events.append(event)
        if len(self.events) >= self.flush_after:
            self.flush()

    def onQueryStarted(self, event) -> None:
        self._add(str(event.id), event.name, "started", event.timestamp, None, None, None, None)

    def onQueryProgress(self, event) -> None:
        found = event.progress
        self._add(
            str(found.id), found.name, "progress", found.timestamp, found.batchId, found.numInputRows,
            found.processedRowsPerSecond, None,
        )

    def onQueryIdle(self, event) -> None:
        """Waiting for input is not kept."""

    def onQueryTerminated(self, event) -> None:
        kind = "failed" if event.exception else "ended"
        self._add(str(event.id), None, kind, None, None, None, None, event.exception)
        self.flush()

    def flush(self) -> None:
        """Add the events at hand to the table."""
        events, self.events = self.events, []
        if events:
            self.spark.createDataFrame(events, EVENTS).coalesce(1).write.mode("append").parquet(self.path)

    def stop(self) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def table(self) -> DataFrame:
        return read_table(self.spark, self.path, EVENTS)
