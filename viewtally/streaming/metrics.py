"""Live metrics as Structured Streaming queries (STR-1..8, SNK-8).

Several independent queries in one session (STR-8), each a stateful
aggregation in ``update`` mode — counters are visible as soon as a batch
ends, as with the key store — whose changed rows go to a day-partitioned
snapshot table per micro-batch (``sinks.snapshot``).  Watermarks equal the
key TTLs, so state stays bounded.  Rows later than the watermark, which Spark
drops, are looked up again over a staged stream, kept and added to their
buckets (``streaming.late``); over other sources they are only counted, in
``numRowsDroppedByWatermark``.

At the end of every batch the trend (STR-3) and the active / ordering users
(STR-5) are published for the batch's tick, reading only the snapshot days
their horizon covers.  The tick is the wall clock at the batch end
(``clock="processing"``, as the original job) or the newest event time seen so
far (``clock="event"``, deterministic; used by tests and replays).  It is
stored per batch, so a replayed batch publishes the same tick again.  A stream
without data has no batches: ``start_ticker`` publishes on a timer instead, so
users expire and the trend moves on while nothing arrives.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from viewtally import config as C
from viewtally.functions import parse as P
from viewtally.functions import time as tm
from viewtally.operators.trending import trend_at
from viewtally.session import ensure_checkpoint_dir
from viewtally.sinks import snapshot
from viewtally.streaming import late as LT
from viewtally.streaming.progress import pool

KEYS = {"counters": ["metric", "bucket_ms"], "topvideos_m": ["bucket_ms", "video"],
        "topvideos_h": ["bucket_ms", "video"], "last_seen": ["metric", "uid", "bucket_ms"]}


def events_stream(msgs: DataFrame, strict: bool = False) -> DataFrame:
    """Parsed, valid events with an event-time instant ``ts`` for watermarks."""
    ev = P.valid_events(msgs, strict)
    return ev.withColumn("ts", tm.ms_to_instant("ts_ms"))


def _window_ms(col: str = "window") -> F.Column:
    return F.unix_millis(F.col(f"{col}.start"))


def minute_counters(events: DataFrame) -> DataFrame:
    """AGG-1..3: ``metric, bucket_ms, n, last_ms`` per minute."""
    ttl = max(s for _k, s in C.COUNTER_OF_METRIC.values())
    return (events.withWatermark("ts", f"{ttl} seconds")
            .groupBy("metric", F.window("ts", "1 minute"))
            .agg(F.count(F.lit(1)).alias("n"), F.max("ts_ms").alias("last_ms"))
            .select("metric", _window_ms().alias("bucket_ms"), "n", "last_ms"))


def hour_window_start(tz: str = C.LABEL_TZ) -> str:
    """``startTime`` that aligns 1-hour windows with the hours of ``tz``
    (e.g. ``30 minutes`` for UTC+5:30).  Window boundaries are fixed offsets
    from the epoch, so a zone with daylight saving keeps its standard-time
    alignment here."""
    from datetime import datetime
    from zoneinfo import ZoneInfo
    off = datetime(2024, 1, 1, tzinfo=ZoneInfo(tz)).utcoffset()
    minutes = int(off.total_seconds() // 60)
    return f"{(-minutes) % 60} minutes"


def video_tier(events: DataFrame, grain: str, tz: str = C.LABEL_TZ) -> DataFrame:
    """AGG-4 / AGG-5: ``bucket_ms, video, n, last_ms`` of page views."""
    if grain == "minute":
        window, ttl = F.window("ts", "1 minute"), C.TOP_VIDEOS_MINUTE_TTL
    else:
        window, ttl = F.window("ts", "1 hour", startTime=hour_window_start(tz)), C.TOP_VIDEOS_HOUR_TTL
    return (events.where(F.col("metric") == "pageview")
            .withWatermark("ts", f"{ttl} seconds")
            .groupBy(window, "video")
            .agg(F.count(F.lit(1)).alias("n"), F.max("ts_ms").alias("last_ms"))
            .select(_window_ms().alias("bucket_ms"), "video", "n", "last_ms"))


def last_seen_minutes(events: DataFrame, horizon_ms: int = C.LAST_SEEN_HORIZON_MS) -> DataFrame:
    """AGG-7 / AGG-8 with bounded state: newest event per (metric, uid,
    minute).  The last-seen set at ``t`` is the max over a uid's rows with
    ``last_ms > t - horizon`` (``users_at``)."""
    return (events.where(F.col("metric").isin("pageview", "order") & F.col("uid").isNotNull())
            .withWatermark("ts", f"{horizon_ms // 1000 + 60} seconds")
            .groupBy("metric", "uid", F.window("ts", "1 minute"))
            .agg(F.max("ts_ms").alias("last_ms"))
            .select("metric", "uid", _window_ms().alias("bucket_ms"), "last_ms"))


def users_at(seen: DataFrame, tick_ms: int, metric: str = "pageview",
             horizon_ms: int = C.LAST_SEEN_HORIZON_MS) -> DataFrame:
    """STR-5 read side: ``uid, last_ms`` with ``tick - horizon < last_ms <= tick``
    (the purge drops scores in ``[0, tick - horizon]``)."""
    return (seen.where((F.col("metric") == metric) & (F.col("last_ms") <= tick_ms)
                       & (F.col("last_ms") > tick_ms - horizon_ms))
            .groupBy("uid").agg(F.max("last_ms").alias("last_ms")))


def _now(previous: int | None) -> int:
    return int(time.time() * 1000)


def _newest_event(batch: DataFrame):
    """The newest event time of the batch, never before the previous tick."""
    def tick(previous: int | None) -> int | None:
        seen = [t for t in (batch.agg(F.max("last_ms")).first()[0], previous) if t is not None]
        return max(seen) if seen else None
    return tick


@dataclass
class Publisher:
    """Publication of the derived tables at a tick."""
    out_root: str
    clock: str = "processing"
    mode: str = "exact"
    tz: str = C.LABEL_TZ
    keep: int = 1440    # newest ticks of a published table that stay

    def _path(self, name: str) -> str:
        return f"{self.out_root.rstrip('/')}/{name}"

    def tick(self, batch: DataFrame, batch_id: int, name: str) -> int | None:
        value = _now if self.clock == "processing" else _newest_event(batch)
        return snapshot.remember(batch.sparkSession, self._path(f"_ticks/{name}"), batch_id, value)

    def _publish(self, df: DataFrame, name: str, tick: int) -> None:
        # one directory per tick (read back as the ``tick_ms`` column), overwritten on replay;
        # files by size: a large table is written by many tasks, a small one by one
        df.hint("rebalance").write.mode("overwrite").parquet(f"{self._path(name)}/tick_ms={tick}")
        spark = df.sparkSession
        ticks = sorted(int(n.split("=")[1]) for n in snapshot.names(spark, self._path(name)) if n.startswith("tick_ms="))
        for old in ticks[:-self.keep]:
            snapshot.remove(spark, f"{self._path(name)}/tick_ms={old}")

    def _recent(self, spark: SparkSession, name: str, lo: int, tick: int, schema: str) -> DataFrame:
        found = snapshot.latest(spark, self._path(name), KEYS[name], snapshot.days_between(lo, tick),
                                where=(F.col("bucket_ms") >= lo) & (F.col("bucket_ms") <= tick))
        return spark.createDataFrame([], schema) if found is None else found

    def trend(self, spark: SparkSession, tick: int) -> None:
        lo = tick - tick % C.MINUTE_MS - C.TREND_HOURS * C.HOUR_MS
        tier = self._recent(spark, "topvideos_m", lo, tick, "bucket_ms long, video string, n long, last_ms long")
        if self.mode != "ttl":
            self._publish(trend_at(tier, tick, tz=self.tz, mode=self.mode), C.TOP_VIDEOS_KEY, tick)
            return
        tier = tier.persist()       # bucket ages and counts from one scan
        try:
            self._publish(trend_at(tier, tick, tz=self.tz, mode=self.mode), C.TOP_VIDEOS_KEY, tick)
        finally:
            tier.unpersist()

    def users(self, spark: SparkSession, tick: int) -> None:
        lo = tick - C.LAST_SEEN_HORIZON_MS - C.MINUTE_MS
        seen = self._recent(spark, "last_seen", lo, tick, "metric string, uid string, bucket_ms long, last_ms long")
        seen = seen.persist()
        try:
            self._publish(users_at(seen, tick, "pageview"), C.ACTIVE_USERS_KEY, tick)
            self._publish(users_at(seen, tick, "order"), C.ORDER_USERS_KEY, tick)
        finally:
            seen.unpersist()


@dataclass
class MetricStreams:
    counters: StreamingQuery
    video_minute: StreamingQuery
    video_hour: StreamingQuery
    last_seen: StreamingQuery

    def all(self) -> list[StreamingQuery]:
        return [self.counters, self.video_minute, self.video_hour, self.last_seen]

    def process_all_available(self) -> None:
        for q in self.all():
            q.processAllAvailable()

    def stop(self) -> None:
        for q in self.all():
            q.stop()


#: files of a day in one batch's folder, and batches between two compactions
TABLE_FILES = 4
COMPACT_EVERY = 60


def _start(df: DataFrame, name: str, out_root: str, ckpt_root: str, trigger: dict,
           after=None, files: int = TABLE_FILES, compact_every: int = COMPACT_EVERY,
           late: LT.LateRows | None = None) -> StreamingQuery:
    root = f"{out_root.rstrip('/')}/{name}"
    ckpt = f"{ckpt_root.rstrip('/')}/{name}"

    def with_late(batch: DataFrame, batch_id: int) -> DataFrame:
        """The batch's rows and the buckets that its late rows changed."""
        spark = batch.sparkSession
        found = late.find(spark, ckpt, batch_id)
        if found is None or late.cells(found).isEmpty():
            return batch
        LT.keep(found, out_root, name, batch_id)
        # computed before the folder it reads is written
        repaired = late.repaired(spark, found, root, batch_id).checkpoint()
        return batch.unionByName(repaired)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        snapshot.claim(spark, root, spark.sparkContext.getLocalProperty("sql.streaming.queryId"))
        batch = batch.persist()     # written, then read for the tick: one pass
        try:
            rows = with_late(batch, batch_id) if late is not None else batch
            snapshot.write(rows, root, batch_id, day_of="bucket_ms", files=files)
            if after is not None:
                after(batch, batch_id)
        finally:
            batch.unpersist()
        if batch_id and batch_id % compact_every == 0:
            snapshot.compact(spark, root, KEYS[name], batch_id - 1, compact_every)

    ensure_checkpoint_dir(df.sparkSession)
    with pool(df.sparkSession, name):
        return (df.writeStream.queryName(name).outputMode("update")
                .option("checkpointLocation", ckpt)
                .trigger(**trigger).foreachBatch(sink).start())


def late_of(spark: SparkSession, name: str, stage_dir: str, tz: str = C.LABEL_TZ) -> LT.LateRows:
    """How the table takes in the late rows of a staged stream."""
    def reread(files: list[str]) -> DataFrame:
        return _staged(spark.read.schema(STAGED_EVENT).option("basePath", stage_dir).parquet(*files))

    start = int(hour_window_start(tz).split()[0]) * C.MINUTE_MS
    cells, width, start = {
        "counters": (minute_counters, C.MINUTE_MS, 0),
        "topvideos_m": (lambda ev: video_tier(ev, "minute"), C.MINUTE_MS, 0),
        "topvideos_h": (lambda ev: video_tier(ev, "hour", tz), C.HOUR_MS, start),
        "last_seen": (last_seen_minutes, C.MINUTE_MS, 0)}[name]
    return LT.LateRows(reread, cells, KEYS[name], width, start)


def start_counters(events: DataFrame, out_root: str, ckpt_root: str, trigger: dict, **kw) -> StreamingQuery:
    """The minute counters alone (AGG-1..3)."""
    return _start(minute_counters(events), "counters", out_root, ckpt_root, trigger, **kw)


STAGED_EVENT = ("metric string, ts_ms bigint, video string, uid string, reject_reason string, topic string, "
                "partition int, offset bigint, key string, value string, rejected boolean")


def start_staging(msgs: DataFrame, stage_dir: str, ckpt_root: str,
                  trigger: dict | None = None, strict: bool = False) -> StreamingQuery:
    """Fan-out source: parse every message once and append the compact
    events (``metric, ts_ms, video, uid``) as Parquet.  Rejected messages go to
    a partition of their own with reason, coordinates, key and raw value
    (``staged_rejects``).  Stateless, and exactly-once through the file sink's
    own log."""
    ev = P.parse_messages(msgs, strict, raw=True).withColumn("rejected", F.col("reject_reason").isNotNull())
    names = [c.split()[0] for c in STAGED_EVENT.split(", ")]
    query = (ev.select(*names).writeStream.queryName("stage_events").format("parquet")
             .option("path", stage_dir).partitionBy("rejected")
             .option("checkpointLocation", f"{ckpt_root.rstrip('/')}/stage_events")
             .trigger(**(trigger or {"processingTime": "60 seconds"})).start())
    try:    # the sink's log would skip the batches of another stream
        snapshot.claim(msgs.sparkSession, stage_dir.rstrip("/"), str(query.id))
    except Exception:
        query.stop()
        raise
    return query


def staged_events(spark: SparkSession, stage_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The staged compact events as a stream, with the event-time instant."""
    r = spark.readStream.schema(STAGED_EVENT)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _staged(r.parquet(stage_dir))


def _staged(rows: DataFrame) -> DataFrame:
    return (rows.where(~F.col("rejected")).select("metric", "ts_ms", "video", "uid")
            .withColumn("ts", tm.ms_to_instant("ts_ms")))


def staged_rejects(spark: SparkSession, stage_dir: str) -> DataFrame:
    """Messages that count in no metric: reason, coordinates, key, raw value."""
    return (spark.read.schema(STAGED_EVENT).parquet(stage_dir).where("rejected")
            .select(F.col("reject_reason").alias("reason"), "topic", "partition", "offset", "key", "value"))


def start(msgs: DataFrame | None, out_root: str, ckpt_root: str, trigger: dict | None = None,
          clock: str = "processing", trend_mode: str = "exact",
          events: DataFrame | None = None, tz: str = C.LABEL_TZ, publish: bool = True,
          files: int = TABLE_FILES, compact_every: int = COMPACT_EVERY, strict: bool = False,
          stage_dir: str | None = None) -> MetricStreams:
    """Start the four metric queries over one message stream.

    ``trigger`` defaults to ``{"processingTime": "60 seconds"}``; tests pass
    ``{"availableNow": True}``.  The checkpoint root must be on shared storage
    on a cluster.  Each query reads its input on its own; pass ``events``
    (``staged_events`` behind ``start_staging``) instead of ``msgs`` so the
    JSON is parsed once for all four instead of once per query.  ``publish=False``
    leaves publication to ``start_ticker``.  ``stage_dir``: the folder ``events``
    come from; late rows are then looked up there and added (``streaming.late``).
    """
    trigger = trigger or {"processingTime": "60 seconds"}
    ev = events if events is not None else events_stream(msgs, strict)
    pub = Publisher(out_root, clock, trend_mode, tz)

    def after_minutes(batch: DataFrame, batch_id: int) -> None:
        tick = pub.tick(batch, batch_id, "topvideos_m")
        if tick is not None:
            pub.trend(batch.sparkSession, tick)

    def after_seen(batch: DataFrame, batch_id: int) -> None:
        tick = pub.tick(batch, batch_id, "last_seen")
        if tick is not None:
            pub.users(batch.sparkSession, tick)

    def query(df: DataFrame, name: str, after=None) -> StreamingQuery:
        late = late_of(ev.sparkSession, name, stage_dir, tz) if stage_dir else None
        return _start(df, name, out_root, ckpt_root, trigger, after if publish else None, files, compact_every, late)

    return MetricStreams(
        counters=query(minute_counters(ev), "counters"),
        video_minute=query(video_tier(ev, "minute"), "topvideos_m", after_minutes),
        video_hour=query(video_tier(ev, "hour", tz), "topvideos_h"),
        last_seen=query(last_seen_minutes(ev), "last_seen", after_seen),
    )


def start_ticker(spark: SparkSession, out_root: str, ckpt_root: str, seconds: int = 60,
                 trend_mode: str = "exact", tz: str = C.LABEL_TZ) -> StreamingQuery:
    """Publish trend and users by the wall clock every ``seconds``, whether or
    not messages arrive (STR-3, STR-5); reads the snapshot tables only."""
    pub = Publisher(out_root, "processing", trend_mode, tz)

    def sink(batch: DataFrame, batch_id: int) -> None:
        tick = pub.tick(batch, batch_id, "ticker")
        pub.trend(batch.sparkSession, tick)
        pub.users(batch.sparkSession, tick)

    beat = spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    return (beat.writeStream.queryName("ticker")
            .option("checkpointLocation", f"{ckpt_root.rstrip('/')}/ticker")
            .trigger(processingTime=f"{seconds} seconds").foreachBatch(sink).start())


def read_table(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """Current content of a snapshot table written by ``start``."""
    return snapshot.latest(spark, f"{out_root.rstrip('/')}/{name}", KEYS[name])


def read_published(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """Published per-tick table (``topvideos``, ``activeusers``, ``orderusers``)."""
    return spark.read.parquet(f"{out_root.rstrip('/')}/{name}")
