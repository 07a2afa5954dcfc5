"""The progress of streams as a table: a row per micro-batch."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from vanewright.sources import files

PROGRESS = (
    "query_name string, query_id string, run_id string, batch_id bigint, started_at timestamp, input_rows bigint, "
    "late_rows bigint, state_rows bigint, duration_ms bigint"
)


class ProgressLog(StreamingQueryListener):
    """Writes every micro-batch of the session's streams below ``root``, in a small file named by run and batch, so a
    batch told twice is there once.

    ``late_rows`` are those that the watermark dropped; where rows are aggregated they are counted after the tasks
    have combined them. ``with`` starts and stops the log::

        with ProgressLog(spark, root) as log:
            query = upsert_stream(...)
            log.wait(query)
        log.table()
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._over: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def __enter__(self) -> "ProgressLog":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def _ended(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._over.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's name
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        states = p.stateOperators
        row = {
            "query_name": p.name, "query_id": str(p.id), "run_id": str(p.runId), "batch_id": p.batchId,
            "started_at": p.timestamp, "input_rows": p.numInputRows,
            "late_rows": sum(s.numRowsDroppedByWatermark for s in states),
            "state_rows": sum(s.numRowsTotal for s in states), "duration_ms": p.batchDuration,
        }
        files.write_text(self.spark, f"{self.root}/run={p.runId}-batch={p.batchId:09d}.json", json.dumps(row))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait for a stream to end and for its last batch to be told."""
        query.awaitTermination()
        if not self._ended(str(query.runId)).wait(seconds):
            raise TimeoutError(f"the end of stream {query.runId} was not told")

    def table(self) -> DataFrame:
        """``PROGRESS``: a row per micro-batch told so far."""
        return self.spark.read.schema(PROGRESS).json(f"{self.root}/*.json")
