"""Keyed state with timers and TTL (STR-4, STR-5, AGG-1..3, AGG-7, AGG-8).

Two processors for ``transformWithState``:

* ``ActiveUsers`` holds a user's open periods of activity.  A timer at the last
  event plus the horizon purges the user by time itself: no event, no scan of
  the set.  It tells when a user is active and, once, when they have left.
* ``ExpiringCounters`` holds one number per bucket with a TTL that each write
  renews.  A bucket that expired is told with 0 and restarts from 1, as a key of the
  original store does.

In event time a timer fires when the watermark passes it, which replays the
same way every time; in processing time by the wall clock, also while nothing
arrives.  State is one small row (or a few) a key in RocksDB; rows of one key
are merged chunk by chunk and never held together.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from viewtally import config as C
from viewtally.sinks import snapshot

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

ACTIVE = "metric string, uid string, since_ms bigint, last_ms bigint, n bigint, active boolean"
SEEN = Row("metric", "uid", "since_ms", "last_ms", "n", "active")
COUNTER = "metric string, bucket_ms bigint, n bigint"

#: events of a key that a task holds at a time
CHUNK = 10_000

Span = tuple[int, int, int]     # first event, last event, events


def merge_spans(spans: list[Span], horizon_ms: int) -> list[Span]:
    """Spans that no gap of ``horizon_ms`` separates become one."""
    out: list[Span] = []
    for since, last, n in sorted(spans):
        if out and since - out[-1][1] < horizon_ms:
            a, b, m = out[-1]
            out[-1] = a, max(b, last), m + n
        else:
            out.append((since, last, n))
    return out


def spans_of(ts: np.ndarray, horizon_ms: int) -> list[Span]:
    """The spans of event times in any order."""
    ts = np.sort(ts)
    cuts = np.flatnonzero(np.diff(ts) >= horizon_ms) + 1
    return [(int(p[0]), int(p[-1]), len(p)) for p in np.split(ts, cuts) if len(p)]


class ActiveUsers(StatefulProcessor):
    """Key (metric, uid).  A user seen at ``t`` is active until ``t + horizon``,
    that moment excluded (the purge includes it)."""

    def __init__(self, horizon_ms: int, event_time: bool):
        self.horizon_ms, self.event_time = horizon_ms, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "since_ms bigint, last_ms bigint, n bigint")

    def _read(self) -> list[Span]:
        return [tuple(map(int, s)) for s in self.open.get()]

    def _timer(self, spans: list[Span]) -> int:
        """When the first of the spans ends: the one timer that a key has."""
        return min(last for _, last, _ in spans) + self.horizon_ms

    @staticmethod
    def _rows(key, spans: list[Span], active: bool) -> Iterator[Row]:
        return (SEEN(*key, *s, active) for s in spans)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        spans = self._read()
        old = self._timer(spans) if spans else None     # as it was set beside these spans
        while ts := [row["ts_ms"] for row in islice(rows, CHUNK)]:
            spans = merge_spans(spans + spans_of(np.array(ts), self.horizon_ms), self.horizon_ms)
        self.open.put(spans)
        if (at := self._timer(spans)) != old:
            if old is not None:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(at)
        yield from self._rows(key, spans[-1:], True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        spans = self._read()
        gone = [s for s in spans if s[1] + self.horizon_ms <= now]
        stay = [s for s in spans if s[1] + self.horizon_ms > now]
        if stay:
            self.open.put(stay)
            self.handle.registerTimer(self._timer(stay))    # the one that fired goes by itself
        else:
            self.open.clear()
        yield from self._rows(key, gone, False)
        if gone and stay:       # the user has not left
            yield from self._rows(key, stay[-1:], True)

    def close(self) -> None:
        pass


class ExpiringCounters(StatefulProcessor):
    """Key (metric, bucket_ms).  The counter of a metric lives ``ttl_ms[metric]``
    from its last write on, by the wall clock."""

    def __init__(self, ttl_ms: dict[str, int]):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.states = {ttl: handle.getValueState(f"n_{ttl}", "n bigint", ttl) for ttl in set(self.ttl_ms.values())}

    @staticmethod
    def _row(key, n: int) -> pd.DataFrame:
        return pd.DataFrame([(*key, n)], columns=["metric", "bucket_ms", "n"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ttl = self.ttl_ms[key[0]]
        state = self.states[ttl]
        n = (int(state.get()[0]) if state.exists() else 0) + sum(len(chunk) for chunk in rows)
        state.update((n,))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + ttl)
        yield self._row(key, n)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.states[self.ttl_ms[key[0]]].clear()
        yield self._row(key, 0)

    def close(self) -> None:
        pass


def active_users(events: DataFrame, horizon_ms: int = C.LAST_SEEN_HORIZON_MS, event_time: bool = True,
                 delay_ms: int = 0) -> DataFrame:
    """``metric, uid, since_ms, last_ms, n, active`` from events (``metric,
    ts_ms, uid, ts``): one row when a batch brings a user events, one
    (``active`` false) for each period that ended and, beside these, one for the
    newest that lasts.  ``delay_ms``: how late events may come, in event time."""
    seen = events.where(F.col("metric").isin("pageview", "order") & F.col("uid").isNotNull()) \
        .select("metric", "uid", "ts_ms", "ts")
    if event_time:
        seen = seen.withWatermark("ts", f"{delay_ms} milliseconds")
    return seen.groupBy("metric", "uid").transformWithState(
        statefulProcessor=ActiveUsers(horizon_ms, event_time), outputStructType=ACTIVE, outputMode="update",
        timeMode="EventTime" if event_time else "ProcessingTime")


def expiring_counters(events: DataFrame, ttl_ms: dict[str, int] | None = None) -> DataFrame:
    """``metric, bucket_ms, n`` per minute as the key store holds it now: the
    number after each batch, 0 when the bucket has expired."""
    ttl_ms = ttl_ms or {m: s * 1000 for m, (_key, s) in C.COUNTER_OF_METRIC.items()}
    bucket = F.col("ts_ms") - F.pmod("ts_ms", F.lit(C.MINUTE_MS))
    cells = events.where(F.col("metric").isin(*ttl_ms)).select("metric", bucket.alias("bucket_ms"))
    return cells.groupBy("metric", "bucket_ms").transformWithStateInPandas(
        statefulProcessor=ExpiringCounters(ttl_ms), outputStructType=COUNTER, outputMode="update",
        timeMode="ProcessingTime")


@contextmanager
def _rocksdb(spark: SparkSession):
    """A query started inside keeps its state in RocksDB, which timers need."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


def _start(df: DataFrame, name: str, out_root: str, ckpt_root: str, trigger: dict, write) -> StreamingQuery:
    root = f"{out_root.rstrip('/')}/{name}"

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        snapshot.claim(spark, root, spark.sparkContext.getLocalProperty("sql.streaming.queryId"))
        batch = batch.persist()     # state is updated once
        try:
            write(batch, root, batch_id)
        finally:
            batch.unpersist()

    with _rocksdb(df.sparkSession):
        return (df.writeStream.queryName(name).outputMode("update")
                .option("checkpointLocation", f"{ckpt_root.rstrip('/')}/{name}")
                .trigger(**trigger).foreachBatch(sink).start())


def start_active_users(events: DataFrame, out_root: str, ckpt_root: str, trigger: dict, **kw) -> StreamingQuery:
    """The active set as a table (``read_active``) and its ended periods
    (``read_periods``)."""
    def write(batch: DataFrame, root: str, batch_id: int) -> None:
        ended = batch.where(~F.col("active")).drop("active")
        ended.write.mode("overwrite").parquet(f"{root}_periods/batch_id={batch_id}")
        # the newest word on a user in this batch: active, unless all periods ended
        newest = batch.groupBy("metric", "uid").agg(F.max(F.struct("since_ms", ~F.col("active"), "last_ms", "n", "active"))
                                                    .alias("v")).select("metric", "uid", "v.since_ms", "v.last_ms", "v.n", "v.active")
        snapshot.write(newest, root, batch_id)

    return _start(active_users(events, **kw), "active", out_root, ckpt_root, trigger, write)


def read_active(spark: SparkSession, out_root: str) -> DataFrame:
    """Who is active now: ``metric, uid, since_ms, last_ms, n``."""
    found = snapshot.latest(spark, f"{out_root.rstrip('/')}/active", ["metric", "uid"])
    return found.where("active").drop("active")


def read_periods(spark: SparkSession, out_root: str) -> DataFrame:
    """The periods that ended: ``metric, uid, since_ms, last_ms, n``."""
    return spark.read.parquet(f"{out_root.rstrip('/')}/active_periods").drop("batch_id")


def start_expiring_counters(events: DataFrame, out_root: str, ckpt_root: str, trigger: dict, **kw) -> StreamingQuery:
    """The counters that live now as a table (``read_expiring``)."""
    return _start(expiring_counters(events, **kw), "expiring", out_root, ckpt_root, trigger,
                  lambda batch, root, batch_id: snapshot.write(
                      batch.groupBy("metric", "bucket_ms").agg(F.max("n").alias("n")), root, batch_id))


def read_expiring(spark: SparkSession, out_root: str) -> DataFrame:
    found = snapshot.latest(spark, f"{out_root.rstrip('/')}/expiring", ["metric", "bucket_ms"])
    return found.where("n > 0")
