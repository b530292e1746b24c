"""Batch progress as a table, and a scheduler pool for each query (SNK-4, AGG-9,
STR-8).

A listener writes one small file for each (query, batch): rows read, rows
counted and rejected (observed while the batch ran, no extra pass), rows
dropped behind the watermark, the watermark and the batch's time.  The batch
number is part of the name, so a batch that runs again after a crash is in the
table once.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from viewtally.sinks import snapshot

SCHEMA = ("query string, batch_id bigint, stream_id string, input_rows bigint, rows bigint, rejected bigint, "
          "dropped_late bigint, watermark string, duration_ms bigint, at string")
POOL = "spark.scheduler.pool"


class ProgressTable(StreamingQueryListener):
    """``spark.streams.addListener(ProgressTable(spark, root))``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        observed = next(iter((p.get("observedMetrics") or {}).values()), {})
        row = {"query": p.get("name") or p["id"], "batch_id": p["batchId"], "stream_id": p["id"],
               "input_rows": p["numInputRows"], "rows": observed.get("rows"), "rejected": observed.get("rejected"),
               "dropped_late": sum(s.get("numRowsDroppedByWatermark", 0) for s in p.get("stateOperators", [])),
               "watermark": (p.get("eventTime") or {}).get("watermark"), "at": p["timestamp"],
               "duration_ms": (p.get("durationMs") or {}).get("triggerExecution")}
        snapshot.put_text(self.spark, f"{self.root}/{row['query']}-{row['batch_id']:012d}.json", json.dumps(row))


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    """One row per query and batch (``SCHEMA``)."""
    if not snapshot.exists(spark, root):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(root)


def wait_for(spark: SparkSession, root: str, query: StreamingQuery, seconds: float = 30) -> None:
    """Until the listener, which runs beside the query, has written the query's
    last batch."""
    last = query.lastProgress
    if last is None:
        return
    end = time.time() + seconds
    name = f"{last.name or last.id}-{last.batchId:012d}.json"
    while time.time() < end and not snapshot.exists(spark, f"{root.rstrip('/')}/{name}"):
        time.sleep(0.1)


@contextmanager
def pool(spark: SparkSession, name: str) -> Iterator[None]:
    """Jobs of a query started inside run in the scheduler pool ``name``.  With
    ``spark.scheduler.mode=FAIR`` the queries of a session then share its cores
    evenly; without it the pool has no effect."""
    sc = spark.sparkContext
    before = sc.getLocalProperty(POOL)
    sc.setLocalProperty(POOL, name)
    try:
        yield
    finally:
        sc.setLocalProperty(POOL, before)
