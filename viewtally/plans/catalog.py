"""Query catalogue: every metric and storage operator as a batch query over
the driver tables (``events`` mapped to Kafka-shaped messages).

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names and types match ``viewtally.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtally import config as C
from viewtally import schemas as S
from viewtally.functions import parse as P
from viewtally.functions import time as tm
from viewtally.operators import audience as A
from viewtally.operators import counters as K
from viewtally.operators import ledger as L
from viewtally.operators import trending as TR
from viewtally.operators.ranking import rank_members
from viewtally.operators.ticks import TickGrid, every_minutes, hourly_at
from viewtally.plans import ingest as I
from viewtally.plans.sizing import share
from viewtally.session import ensure_checkpoint_dir
from viewtally.sinks import by_key as BK
from viewtally.sinks import parquet as PS
from viewtally.sources import json as SJ
from viewtally.sources import log as LG
from viewtally.sources import messages as M
from viewtally.streaming import keyed as KD
from viewtally.streaming import late as LT
from viewtally.streaming import metrics as SM
from viewtally.streaming import progress as PG
from viewtally.streaming import running as RT
from viewtally.streaming import sketches as SK
from viewtally.streaming import storage as SS

PREFIX = "test"
# A previous ingestion run stopped here (2024-01-15 00:00 UTC); one partition
# never got a ledger row.
PREVIOUS_RUN_CUTOFF_MS = 1_705_276_800_000
UNLEDGERED = ("test-order", 3)
TOP_K = 3
LEX_RANGE = ("[1", "(5")
# Purge of the ordering-user set as at a batch ending 2024-01-30 00:00 UTC.
PURGE_AT_MS = 1_706_572_800_000
# A half-hour zone: hour buckets start at :30 UTC there.
ALT_TZ = "Asia/Kolkata"
CORRUPT_EVERY = 10
APPROX_TOLERANCE = 0.05
MINUTES_BACK = 5
LATE_EVERY = 10
HEARTBEAT = "heartbeat"


def _events(spark, sf_dir) -> DataFrame:
    return M.read_table(spark, sf_dir, "events")


def _messages(spark, sf_dir, with_offsets=True, **kw) -> DataFrame:
    return M.events_as_messages(_events(spark, sf_dir), PREFIX, with_offsets=with_offsets, **kw)


def _parsed(spark, sf_dir) -> DataFrame:
    return P.valid_events(_messages(spark, sf_dir, with_offsets=False))


def _grid(spark, sf_dir, step_offset) -> TickGrid:
    step, offset = step_offset
    ev = _events(spark, sf_dir).select(tm.ntz_to_ms("ts").alias("ts_ms"))
    return TickGrid.covering_days(ev, "ts_ms", step, offset)


# -- counters ---------------------------------------------------------------

def views_per_minute(spark, sf_dir):
    return K.metric_per_minute(_parsed(spark, sf_dir), "pageview")


def clicks_per_minute(spark, sf_dir):
    return K.metric_per_minute(_parsed(spark, sf_dir), "click")


def orders_per_minute(spark, sf_dir):
    return K.metric_per_minute(_parsed(spark, sf_dir), "order")


def video_views_per_minute(spark, sf_dir):
    return K.video_views(_parsed(spark, sf_dir), "minute")


def video_views_per_hour(spark, sf_dir):
    return K.video_views(_parsed(spark, sf_dir), "hour")


def visible_minute_counters(spark, sf_dir):
    return K.visible_counters(_parsed(spark, sf_dir), _grid(spark, sf_dir, hourly_at(30)))


def batch_counts(spark, sf_dir):
    return K.batch_counts(_parsed(spark, sf_dir), C.HOUR_MS)


# -- trend ------------------------------------------------------------------

def _views(spark, sf_dir):
    return _parsed(spark, sf_dir).where(F.col("metric") == "pageview").select("ts_ms", "video")


def trending_exact(spark, sf_dir):
    grid = _grid(spark, sf_dir, hourly_at(30))
    return TR.present_trend(TR.trending(_views(spark, sf_dir), grid, mode="exact"))


def trending_ttl(spark, sf_dir):
    grid = _grid(spark, sf_dir, hourly_at(30))
    return TR.present_trend(TR.trending(_views(spark, sf_dir), grid, mode="ttl"))


def trending_top_k(spark, sf_dir):
    grid = _grid(spark, sf_dir, hourly_at(30))
    top = TR.top_k(TR.trending(_views(spark, sf_dir), grid, mode="exact"), TOP_K)
    return top.select(tm.ms_to_ntz("tick_ms").alias("tick"), "video", "n", "rank")


def trend_bucket_keys(spark, sf_dir):
    grid = _grid(spark, sf_dir, hourly_at(30))
    return TR.trend_bucket_keys(grid.frame(spark))


# -- audience ---------------------------------------------------------------

def _users(spark, sf_dir, metric):
    grid = _grid(spark, sf_dir, every_minutes(5))
    ev = _parsed(spark, sf_dir).where(F.col("metric") == metric).select("uid", "ts_ms")
    return A.present_users(A.users_at_ticks(ev, grid))


def active_users(spark, sf_dir):
    return _users(spark, sf_dir, "pageview")


def order_users(spark, sf_dir):
    return _users(spark, sf_dir, "order")


def uid_fallback(spark, sf_dir):
    v = _parsed(spark, sf_dir).where(F.col("metric") == "pageview")
    src = (F.when(F.col("viewer").isNull(), F.lit("absent"))
           .when(F.col("viewer") == "", F.lit("empty")).otherwise(F.lit("viewer")))
    return (v.groupBy(src.alias("uid_source"))
            .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("uid").alias("n_uids")))


def expire_by_lex(spark, sf_dir):
    v = _parsed(spark, sf_dir).where(F.col("metric") == "pageview")
    kept = A.expire_by_lex(A.last_seen(v), *LEX_RANGE)
    return kept.select("uid", tm.ms_to_ntz("last_ms").alias("last_seen"))


def expire_by_score(spark, sf_dir):
    """STR-5 with Redis score-range syntax: drop ordering users whose last
    order scores in ``[0, now - 6 min]``."""
    o = _parsed(spark, sf_dir).where(F.col("metric") == "order")
    kept = A.expire_by_score(A.last_seen(o), "0", str(PURGE_AT_MS - C.LAST_SEEN_HORIZON_MS))
    return kept.select("uid", tm.ms_to_ntz("last_ms").alias("last_seen"))


def video_views_per_hour_alt_zone(spark, sf_dir):
    """AGG-5 with the label zone set to a half-hour offset zone."""
    return K.video_views(_parsed(spark, sf_dir), "hour", tz=ALT_TZ)


def approx_active_users(spark, sf_dir):
    return A.approx_users(_parsed(spark, sf_dir).where(F.col("metric") == "pageview"))


def approx_users_accuracy(spark, sf_dir):
    """AGG-10: whether each day's estimate is within ``APPROX_TOLERANCE`` of
    the exact count, which stands beside it."""
    views = _parsed(spark, sf_dir).where(F.col("metric") == "pageview").select("uid", "ts_ms")
    exact = (views.groupBy(tm.ms_to_ntz(tm.floor_ms("ts_ms", C.DAY_MS)).alias("period"))
             .agg(F.countDistinct("uid").alias("users")))
    off = F.abs(F.col("approx_users") - F.col("users"))
    return (exact.join(A.approx_users(views), "period", "left")
            .select("period", "users",
                    F.coalesce(off <= F.col("users") * APPROX_TOLERANCE, F.lit(False)).alias("close")))


def minute_list(spark, sf_dir):
    """PRJ-12: labels of the last ``MINUTES_BACK`` minutes at every tick."""
    ticks = _grid(spark, sf_dir, hourly_at(30)).frame(spark)
    return (ticks.select(tm.ms_to_ntz("tick_ms").alias("tick"),
                         F.posexplode(tm.minute_list_before(F.col("tick_ms"), MINUTES_BACK)).alias("pos", "label"))
            .withColumn("pos", F.col("pos").cast("bigint")))


# -- ledger / ingestion -----------------------------------------------------

def _offsets(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(latest offsets, ledger of a previous run): one pass over three narrow
    columns; one row per topic partition is all that is kept of it."""
    msgs = _messages(spark, sf_dir)
    before = F.when(tm.key_to_ms("key") < PREVIOUS_RUN_CUTOFF_MS, F.col("offset"))
    found = share(msgs.groupBy("topic", F.col("partition").alias("part"))
                  .agg((F.max("offset") + 1).cast("bigint").alias("until_off"),
                       (F.max(before) + 1).cast("bigint").alias("off")))
    unledgered = (F.col("topic") == UNLEDGERED[0]) & (F.col("part") == UNLEDGERED[1])
    return (found.select("topic", "part", "until_off"),
            found.where(F.col("off").isNotNull() & ~unledgered).select("topic", "part", "off"))


def offset_plan(spark, sf_dir):
    return L.offset_plan(*_offsets(spark, sf_dir))


def bounded_read(spark, sf_dir):
    sel = L.select_range(_messages(spark, sf_dir), L.offset_plan(*_offsets(spark, sf_dir)))
    return sel.select("topic", "partition", "offset",
                      P.metric_of_topic("topic").alias("metric"),
                      tm.ms_to_ntz(tm.key_to_ms("key")).alias("log_date"),
                      P.message_id().alias("msg_id"))


def ledger_bootstrap(spark, sf_dir):
    latest, previous = _offsets(spark, sf_dir)
    return L.bootstrap(previous, latest)


def ledger_commit(spark, sf_dir):
    latest, previous = _offsets(spark, sf_dir)
    return L.commit(L.bootstrap(previous, latest), L.offset_plan(latest, previous))


# -- log storage ------------------------------------------------------------

def log_rows(spark, sf_dir):
    return P.log_rows(_messages(spark, sf_dir), with_id=True)


def log_rows_per_day(spark, sf_dir):
    rows = P.log_rows(_messages(spark, sf_dir, with_offsets=False))
    day = F.date_format("log_date", "yyyy_MM_dd")
    return (rows.groupBy(day.alias("log_day"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("log_date").alias("first_log"),
                 F.max("log_date").alias("last_log")))


def json_reject_split(spark, sf_dir):
    msgs = _messages(spark, sf_dir, with_offsets=False, corrupt_every=CORRUPT_EVERY)
    parsed = P.parse_messages(msgs)
    status = F.when(F.col("reject_reason").isNull(), F.lit("valid")).otherwise(F.lit("rejected"))
    return parsed.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def reject_reasons(spark, sf_dir):
    """PRJ-3 / FLT-4: messages by the reason that keeps them out (valid ones too)."""
    msgs = _messages(spark, sf_dir, with_offsets=False, corrupt_every=CORRUPT_EVERY)
    reason = F.coalesce("reject_reason", F.lit("valid"))
    return P.parse_messages(msgs).groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def day_range_check(spark, sf_dir):
    """FLT-5: rows per day partition, and how many lie outside their day."""
    rows = PS.with_log_day(P.log_rows(_messages(spark, sf_dir, with_offsets=False)))
    bad = PS.outside_day().cast("bigint")
    return rows.groupBy("log_day").agg(F.count(F.lit(1)).alias("n"), F.sum(bad).alias("outside"))


def _work_folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _staged_messages(spark, sf_dir, folder: str) -> DataFrame:
    path = f"{folder}/messages"
    _messages(spark, sf_dir).select(*S.MESSAGE.fieldNames()).write.parquet(path)
    return spark.read.schema(S.MESSAGE).parquet(path)


class _NoCommit(I.ParquetLedger):
    """A run that ends before its commit."""
    def write(self, ledger: DataFrame) -> None:
        pass


def ingest_replay(spark, sf_dir):
    """STR-9: a run saves what is there but ends before its commit; messages
    go on arriving; the next run starts at the same offsets and reaches
    further.  Rows and distinct ids stored per topic partition."""
    folder = _work_folder(spark, "ingest")
    msgs = _staged_messages(spark, sf_dir, folder)
    save = I.parquet_sink(f"{folder}/stored")
    early = msgs.where(tm.key_to_ms("key") < PREVIOUS_RUN_CUTOFF_MS)
    I.run(spark, early, _NoCommit(spark, f"{folder}/ledger"), save, bootstrap=True)
    I.run(spark, msgs, I.ParquetLedger(spark, f"{folder}/ledger"), save, bootstrap=True, dense=True)
    return (spark.read.option("basePath", f"{folder}/stored").parquet(f"{folder}/stored")
            .groupBy("topic", "partition")
            .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("msg_id").alias("n_ids")))


def json_schema_columns(spark, sf_dir):
    """SRC-7: the columns found in the payloads, and how many messages of each
    topic carry them."""
    msgs = _messages(spark, sf_dir, with_offsets=False)
    schema = SJ.infer_schema(msgs)
    fields = F.from_json("value", schema)
    parsed = msgs.select("topic", F.explode(F.array(fields)).alias("j")).select("topic", "j.*")
    names = [c for c in parsed.columns if c != "topic"]
    counts = parsed.groupBy("topic").agg(*[F.count(c).alias(c) for c in names])
    return counts.unpivot(["topic"], names, "column", "n").where(F.col("n") > 0)


def parquet_round_trip(spark, sf_dir):
    """SNK-1, SNK-5: typed rows of all days to the day-partitioned store and
    back."""
    path = f"{_work_folder(spark, 'logs')}/typed"
    rows = P.typed_log_rows(_messages(spark, sf_dir))
    PS.write_logs(rows.where(F.col("reject_reason").isNull()).drop("reject_reason", "key", "value"), path)
    return PS.read_logs(spark, path).select("log_day", "metric", "log_date", "viewer", "video", "order", "msg_id")


def stream_minute_counters(spark, sf_dir):
    """STR-1, STR-7: the live minute counters over a folder that grows between
    two runs from one checkpoint."""
    folder = _work_folder(spark, "stream")
    msgs = _messages(spark, sf_dir, with_offsets=False).select(*S.MESSAGE.fieldNames())
    before = tm.key_to_ms("key") < PREVIOUS_RUN_CUTOFF_MS
    for arrived in (before, ~before):
        msgs.where(arrived).write.mode("append").parquet(f"{folder}/in")
        live = SM.events_stream(spark.readStream.schema(S.MESSAGE).parquet(f"{folder}/in"))
        query = SM.start_counters(live, f"{folder}/out", f"{folder}/checkpoint", {"availableNow": True})
        try:
            query.awaitTermination()
        finally:
            query.stop()
    return SM.read_table(spark, f"{folder}/out", "counters").select(
        "metric", tm.ms_to_ntz("bucket_ms").alias("bucket"), "n")


def late_rows(spark, sf_dir):
    """STR-7: every tenth event arrives behind all others.  Minute counters of
    the live table, late rows added, and how many rows of each came too late for
    the stream."""
    folder = _work_folder(spark, "late")
    msgs = _messages(spark, sf_dir, with_offsets=False)
    held, early = F.col("event_id") % LATE_EVERY == 0, tm.key_to_ms("key") < PREVIOUS_RUN_CUTOFF_MS
    columns = [f for f in S.MESSAGE.fieldNames() if f in msgs.columns]
    for arrived in (~held & early, ~held & ~early, held):
        msgs.where(arrived).select(*columns).write.mode("append").parquet(f"{folder}/in")
        live = spark.readStream.schema(S.MESSAGE).parquet(f"{folder}/in")
        staging = SM.start_staging(live, f"{folder}/staged", f"{folder}/checkpoint", {"availableNow": True})
        _finish(staging)
        _finish(SM.start_counters(SM.staged_events(spark, f"{folder}/staged"), f"{folder}/out", f"{folder}/checkpoint",
                                  {"availableNow": True}, late=SM.late_of(spark, "counters", f"{folder}/staged")))
    keys = ["metric", "bucket_ms"]
    late = LT.late_rows(spark, f"{folder}/out", "counters").groupBy("metric", LT.bucket_start(C.MINUTE_MS).alias("bucket_ms")) \
        .agg(F.count(F.lit(1)).alias("n_late"))
    return (SM.read_table(spark, f"{folder}/out", "counters").join(late, keys, "left")
            .select("metric", tm.ms_to_ntz("bucket_ms").alias("bucket"), "n", F.coalesce("n_late", F.lit(0)).alias("n_late")))


def active_periods(spark, sf_dir):
    """STR-5, AGG-7, AGG-8 by keyed state: the periods in which a user was in
    the active (or ordering) set, over two runs from one checkpoint.  A heartbeat
    a day behind the last event lets the timers of all users expire."""
    folder = _work_folder(spark, "active")
    ev = _parsed(spark, sf_dir).select("metric", "ts_ms", "uid")
    before = F.col("ts_ms") < PREVIOUS_RUN_CUTOFF_MS
    beat = ev.agg((F.max("ts_ms") + C.DAY_MS).alias("ts_ms")).select(
        F.lit("pageview").alias("metric"), "ts_ms", F.lit(HEARTBEAT).alias("uid"))
    for arrived in (ev.where(before), ev.where(~before), beat):
        arrived.write.mode("append").parquet(f"{folder}/in")
        live = spark.readStream.schema("metric string, ts_ms bigint, uid string").parquet(f"{folder}/in")
        _finish(KD.start_active_users(live.withColumn("ts", tm.ms_to_instant("ts_ms")), f"{folder}/out",
                                      f"{folder}/checkpoint", {"availableNow": True}))
    return KD.read_periods(spark, f"{folder}/out").where(F.col("uid") != HEARTBEAT).select(
        "metric", "uid", tm.ms_to_ntz("since_ms").alias("since"), tm.ms_to_ntz("last_ms").alias("last"), "n")


def trend_rank(spark, sf_dir):
    """RNK-1: every video's rank at every hourly tick."""
    grid = _grid(spark, sf_dir, hourly_at(30))
    ranked = rank_members(TR.trending(_views(spark, sf_dir), grid, mode="exact"))
    return ranked.select(tm.ms_to_ntz("tick_ms").alias("tick"), "video", "n", "rank")


def live_trend(spark, sf_dir):
    """STR-3 live: the running trend at the newest event, over two runs from
    one checkpoint, every video ranked."""
    folder = _work_folder(spark, "trend")
    ev = _parsed(spark, sf_dir).select("metric", "ts_ms", "video")
    before = F.col("ts_ms") < PREVIOUS_RUN_CUTOFF_MS
    for arrived in (before, ~before):
        ev.where(arrived).write.mode("append").parquet(f"{folder}/in")
        live = spark.readStream.schema("metric string, ts_ms bigint, video string").parquet(f"{folder}/in")
        _finish(RT.start(live, f"{folder}/out", f"{folder}/checkpoint", {"availableNow": True}, clock="event"))
    return RT.RunningTrend(spark, f"{folder}/out/trend").ranked().select(
        tm.ms_to_ntz("tick_ms").alias("tick"), "video", "n", "rank")


def footer_offsets(spark, sf_dir):
    """SRC-4, AGG-11: newest offsets of a laid-out log from its file footers."""
    folder = _work_folder(spark, "log")
    LG.write_log(_messages(spark, sf_dir), f"{folder}/log")
    return LG.latest_offsets(spark, f"{folder}/log")


def planned_read(spark, sf_dir):
    """SRC-3, JOIN-1: what a previous run left, read from the laid-out log by
    its plan's ranges."""
    folder = _work_folder(spark, "log")
    LG.write_log(_messages(spark, sf_dir), f"{folder}/log")
    _latest, previous = _offsets(spark, sf_dir)
    plan = L.check_plan(L.offset_plan(LG.latest_offsets(spark, f"{folder}/log"), previous), bootstrap=True)
    return LG.read_ranges(spark, f"{folder}/log", plan).select(
        "topic", "partition", "offset", P.metric_of_topic("topic").alias("metric"),
        tm.ms_to_ntz(tm.key_to_ms("key")).alias("log_date"), P.message_id().alias("msg_id"))


def sketch_users(spark, sf_dir):
    """AGG-10: users per 6 minutes, hour and day from the sketches that a stream
    stored over two runs: whether each estimate is within ``APPROX_TOLERANCE``
    of the exact count, which stands beside it."""
    folder = _work_folder(spark, "sketches")
    ev = _parsed(spark, sf_dir).where(F.col("metric") == "pageview").select("metric", "ts_ms", "uid")
    before = F.col("ts_ms") < PREVIOUS_RUN_CUTOFF_MS
    for arrived in (before, ~before):
        ev.where(arrived).write.mode("append").parquet(f"{folder}/in")
        live = spark.readStream.schema("metric string, ts_ms bigint, uid string").parquet(f"{folder}/in")
        _finish(SK.start(live.withColumn("ts", tm.ms_to_instant("ts_ms")), f"{folder}/out", f"{folder}/checkpoint",
                         {"availableNow": True}))
    stored, out = SK.read(spark, f"{folder}/out"), []
    for label, grain in (("6 minutes", C.LAST_SEEN_HORIZON_MS), ("hour", C.HOUR_MS), ("day", C.DAY_MS)):
        exact = ev.groupBy("metric", tm.floor_ms("ts_ms", grain).alias("period_ms")).agg(F.countDistinct("uid").alias("users"))
        off = F.abs(F.col("approx_users") - F.col("users"))
        out.append(exact.join(SK.users_per(stored, grain), ["metric", "period_ms"], "left").select(
            F.lit(label).alias("grain"), tm.ms_to_ntz("period_ms").alias("period"), "users",
            F.coalesce(off <= F.col("users") * APPROX_TOLERANCE, F.lit(False)).alias("close")))
    return out[0].union(out[1]).union(out[2])


def key_lookup(spark, sf_dir):
    """SNK-8: one video's minute counts over all days, by key, from a table
    written in three batches and compacted."""
    folder = _work_folder(spark, "keys")
    root, keys = f"{folder}/topvideos_m", ["bucket_ms", "video"]
    cells = (_views(spark, sf_dir).groupBy((F.col("ts_ms") - F.pmod("ts_ms", F.lit(C.MINUTE_MS))).alias("bucket_ms"), "video")
             .agg(F.count(F.lit(1)).alias("n"))).persist()
    try:
        third = F.pmod(F.xxhash64("bucket_ms", "video"), F.lit(3))
        # earlier batches hold counts that later ones replace
        for b in range(3):
            BK.write(cells.where(third >= b).withColumn("n", F.when(third == b, F.col("n")).otherwise(F.lit(0))), root, b, "video",
                     "bucket_ms")
        BK.compact(spark, root, keys, "video", 1, 2)
        wanted = cells.agg(F.min("video")).first()[0]
    finally:
        cells.unpersist()
    return BK.lookup(spark, root, "video", wanted, keys, "bucket_ms bigint, video string, n bigint").select(
        tm.ms_to_ntz("bucket_ms").alias("bucket"), "video", "n")


def variant_fields(spark, sf_dir):
    """FLT-4, SNK-1: payloads stored as variants in two batches, the second
    with a number where the first has text, read back together by path."""
    path = f"{_work_folder(spark, 'variant')}/logs"
    rows = P.checked_log_rows(_messages(spark, sf_dir)).where(F.col("reject_reason").isNull()).drop("reject_reason", "key")
    late = F.col("log_date") >= tm.ms_to_ntz(F.lit(PREVIOUS_RUN_CUTOFF_MS))
    bare = F.regexp_replace("data", r'"timestamp":"(\d+)"', r'"timestamp":$1')
    for batch in (rows.where(~late), rows.where(late).withColumn("data", bare)):
        PS.write_logs(P.with_variant(batch), path)
    field = lambda name, kind: F.variant_get("payload", f"$.{name}", kind)
    return PS.read_logs(spark, path).select("metric", "msg_id", field("video", "string").alias("video"),
                                            field("viewer", "string").alias("viewer"),
                                            field("timestamp", "bigint").alias("sent_ms"))


def progress_rows(spark, sf_dir):
    """SNK-4, AGG-9: rows counted and rejected by the log stream, from its
    progress table, over two runs from one checkpoint."""
    folder = _work_folder(spark, "progress")
    msgs = _messages(spark, sf_dir, corrupt_every=CORRUPT_EVERY).select(*S.MESSAGE.fieldNames())
    before = tm.key_to_ms("key") < PREVIOUS_RUN_CUTOFF_MS
    listener = PG.ProgressTable(spark, f"{folder}/progress")
    spark.streams.addListener(listener)
    try:
        for arrived in (before, ~before):
            msgs.where(arrived).write.mode("append").parquet(f"{folder}/in")
            query = SS.start_parquet(spark.readStream.schema(S.MESSAGE).parquet(f"{folder}/in"), f"{folder}/out",
                                     f"{folder}/checkpoint", {"availableNow": True})
            _finish(query)
        PG.wait_for(spark, f"{folder}/progress", query)
    finally:
        spark.streams.removeListener(listener)
    own = PG.read_progress(spark, f"{folder}/progress").where(F.col("stream_id") == str(query.id))
    return own.groupBy("query").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("input_rows", "rows", "rejected", "dropped_late")])


def _finish(query) -> None:
    try:
        query.awaitTermination()
    finally:
        query.stop()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "views_per_minute": views_per_minute,
    "clicks_per_minute": clicks_per_minute,
    "orders_per_minute": orders_per_minute,
    "video_views_per_minute": video_views_per_minute,
    "video_views_per_hour": video_views_per_hour,
    "visible_minute_counters": visible_minute_counters,
    "batch_counts": batch_counts,
    "trending_exact": trending_exact,
    "trending_ttl": trending_ttl,
    "trending_top_k": trending_top_k,
    "trend_bucket_keys": trend_bucket_keys,
    "active_users": active_users,
    "order_users": order_users,
    "uid_fallback": uid_fallback,
    "expire_by_lex": expire_by_lex,
    "expire_by_score": expire_by_score,
    "video_views_per_hour_alt_zone": video_views_per_hour_alt_zone,
    "approx_active_users": approx_active_users,
    "approx_users_accuracy": approx_users_accuracy,
    "minute_list": minute_list,
    "offset_plan": offset_plan,
    "bounded_read": bounded_read,
    "ledger_bootstrap": ledger_bootstrap,
    "ledger_commit": ledger_commit,
    "log_rows": log_rows,
    "log_rows_per_day": log_rows_per_day,
    "json_reject_split": json_reject_split,
    "reject_reasons": reject_reasons,
    "day_range_check": day_range_check,
    "ingest_replay": ingest_replay,
    "json_schema_columns": json_schema_columns,
    "parquet_round_trip": parquet_round_trip,
    "stream_minute_counters": stream_minute_counters,
    "late_rows": late_rows,
    "active_periods": active_periods,
    "trend_rank": trend_rank,
    "live_trend": live_trend,
    "footer_offsets": footer_offsets,
    "planned_read": planned_read,
    "sketch_users": sketch_users,
    "key_lookup": key_lookup,
    "variant_fields": variant_fields,
    "progress_rows": progress_rows,
}
