"""Pushed progress of streams (R7, A13): every micro-batch reports to a table.

A listener gets Spark's progress events and publishes each as a small file, so the progress of any
query of the session can be read like any other table, also while it runs and after
the driver has gone.  Nothing polls.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from vitalis.sources import store

SCHEMA = (
    "query_id string, run_id string, name string, batch_id long, at string, input_rows long, input_rows_per_second double, "
    "processed_rows_per_second double, duration_ms long, rows_dropped_by_watermark long, state_rows long, watermark string"
)


class ProgressTable(StreamingQueryListener):
    """Publishes a record per micro-batch under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.running: set[str] = set()
        self.seen: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self.changed:
            self.running.add(str(event.runId))
            self.seen.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        states = p.get("stateOperators", [])
        row = {
            "query_id": p["id"],
            "run_id": p["runId"],
            "name": p.get("name"),
            "batch_id": p["batchId"],
            "at": p["timestamp"],
            "input_rows": p.get("numInputRows", 0),
            "input_rows_per_second": p.get("inputRowsPerSecond") or 0.0,
            "processed_rows_per_second": p.get("processedRowsPerSecond") or 0.0,
            "duration_ms": p.get("durationMs", {}).get("triggerExecution", 0),
            "rows_dropped_by_watermark": sum(s.get("numRowsDroppedByWatermark", 0) for s in states),
            "state_rows": sum(s.get("numRowsTotal", 0) for s in states),
            "watermark": p.get("eventTime", {}).get("watermark"),
        }
        # idle triggers report the batch to come: the time keeps their records apart
        name = f"{p['runId']}-{p['batchId']:012d}-{p['timestamp'].replace(':', '')}.json"
        store.publish_text(self.spark, f"{self.path}/{name}", json.dumps(row) + "\n")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.running.discard(str(event.runId))
            self.changed.notify_all()

    def wait(self, run_id: str, seconds: float = 30.0) -> bool:
        """Until all events of a run have come (they are delivered in order, the last one at its end)."""
        with self.changed:
            return self.changed.wait_for(lambda: run_id in self.seen and run_id not in self.running, seconds)

    def table(self) -> DataFrame:
        if not store.names(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).json(self.path)


@contextmanager
def progress_to(spark: SparkSession, path: str) -> Iterator[ProgressTable]:
    """Let the streams that run inside the block report to ``path``."""
    listener = ProgressTable(spark, path)
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


__all__ = ["ProgressTable", "progress_to"]
