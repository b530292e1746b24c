"""Batch backfill of every metric table over a span of days — the batch twin
of the live metrics job.

Messages are parsed once; the projected events (``metric, ts_ms, video,
uid``) are written as a Parquet table under the cluster's shared checkpoint
folder (``spark.checkpoint.dir``), which cuts the lineage and lets every
output read compact columns instead of re-parsing JSON.  An executor lost
after that point recomputes from the table, not from the raw log.

Outputs (Parquet, one folder each under ``out_root``): ``counters``,
``topvideos_m``, ``topvideos_h``, ``visible_counters``, ``topvideos``
(trend per hourly tick), ``topvideos_top`` (top-k), ``activeusers`` and
``orderusers`` (per 5-minute tick), and ``rejects``: every message that is in
none of them, with its reason.

With ``days`` only messages of those days, and of the ``REACH_MS`` before
them that their ticks look back on, are parsed; all tables hold those days.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtally import config as C
from viewtally.functions import parse as P
from viewtally.functions import time as tm
from viewtally.operators import audience as A
from viewtally.operators import counters as K
from viewtally.operators import trending as TR
from viewtally.operators.ticks import TickGrid, every_minutes, hourly_at
from viewtally.plans.sizing import checkpoint_dir


@dataclass
class BackfillSpec:
    trend_tick: tuple[int, int] = hourly_at(30)
    users_tick: tuple[int, int] = every_minutes(5)
    trend_mode: str = "exact"
    top_k: int = 10
    tz: str = C.LABEL_TZ
    # (first_day, last_day) ISO dates; None derives them from the data (a
    # min/max pass over the event times)
    days: tuple[str, str] | None = None


#: how far a tick looks back: six clock hours hold the longest horizon
REACH_MS = 6 * 3_600_000
REJECTED = "_rejected"


def day_span(first: str, last: str) -> tuple[int, int]:
    """[start, end) in epoch ms of whole UTC days."""
    at = lambda d: int(datetime(d.year, d.month, d.day, tzinfo=timezone.utc).timestamp() * 1000)
    return at(date.fromisoformat(first)), at(date.fromisoformat(last) + timedelta(days=1))


def stage_events(spark: SparkSession, msgs: DataFrame, folder: str | None = None,
                 strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Parse once and persist the compact event columns as Parquet in the
    shared checkpoint folder; returns (events, rejects) re-read from there."""
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/viewtally-events-{uuid.uuid4().hex}"
    where = [c for c in ("topic", "partition", "offset") if c in msgs.columns]
    told = F.col("reject_reason")
    rows = P.parse_messages(msgs, strict, raw=True).select(
        F.when(told.isNull(), F.col("metric")).otherwise(REJECTED).alias("metric"), "ts_ms", "video", "uid",
        told.alias("reason"), *[F.when(told.isNotNull(), F.col(c)).alias(c) for c in where], "key", "value")
    rows.hint("rebalance", "metric").write.mode("overwrite").partitionBy("metric").parquet(folder)
    # the metric column of an empty table has no folder to be found in
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    back = spark.read.schema(schema).parquet(folder)
    return (back.where(F.col("metric") != REJECTED).select("metric", "ts_ms", "video", "uid"),
            back.where(F.col("metric") == REJECTED).select("reason", *where, "key", "value"))


def run(spark: SparkSession, msgs: DataFrame, out_root: str,
        spec: BackfillSpec | None = None, grid_from: DataFrame | None = None,
        parallel_jobs: int = 4, strict: bool = False) -> dict[str, str]:
    """Compute and write all metric tables; returns name -> path.

    The tick grids cover the whole days of the data (``grid_from``, default
    the staged events).  The outputs are independent once the events are
    staged, so up to ``parallel_jobs`` of them run as concurrent Spark jobs."""
    spec = spec or BackfillSpec()
    out = out_root.rstrip("/")
    inside = F.lit(True)
    if spec.days:
        start, end = day_span(*spec.days)
        key = tm.key_to_ms("key")
        # what has no plausible time can't be told to be outside: it is rejected
        msgs = msgs.where(P.bad_key(key).isNotNull() | ((key >= start - REACH_MS) & (key < end)))
        inside = (F.col("ts_ms") >= start) & (F.col("ts_ms") < end)
    ev, rejects = stage_events(spark, msgs, strict=strict)
    own = ev.where(inside)
    if spec.days:
        trend_grid = TickGrid.for_days(*spec.days, *spec.trend_tick)
    else:
        src = grid_from if grid_from is not None else ev
        trend_grid = TickGrid.covering_days(src, "ts_ms", *spec.trend_tick)
    users_grid = TickGrid(trend_grid.start_ms - spec.trend_tick[1] + spec.users_tick[1],
                          trend_grid.end_ms, spec.users_tick[0])
    paths: dict[str, str] = {}

    def save(df: DataFrame, name: str, part: str | None = None) -> None:
        w = df.write.mode("overwrite")
        if part:
            w = w.partitionBy(part)
        w.parquet(f"{out}/{name}")
        paths[name] = f"{out}/{name}"

    views = ev.where(F.col("metric") == "pageview")

    def trend_and_top() -> None:
        trend = TR.trending(views.select("ts_ms", "video"), trend_grid, tz=spec.tz,
                            mode=spec.trend_mode)
        save(trend, "topvideos")
        # top-k from the written trend table: no second trend computation
        save(TR.top_k(spark.read.parquet(paths["topvideos"]), spec.top_k), "topvideos_top")

    def users(metric: str, name: str) -> None:
        ev_m = ev.where(F.col("metric") == metric).select("uid", "ts_ms")
        save(A.users_at_ticks(ev_m, users_grid), name)

    tasks = [
        lambda: save(rejects, "rejects"),
        lambda: save(K.bucket_counts(own, "minute", ["metric"], spec.tz), "counters", "metric"),
        lambda: save(K.bucket_counts(views.where(inside), "minute", ["video"], spec.tz), "topvideos_m"),
        lambda: save(K.bucket_counts(views.where(inside), "hour", ["video"], spec.tz), "topvideos_h"),
        lambda: save(K.visible_counters(ev, trend_grid), "visible_counters", "metric"),
        trend_and_top,
        lambda: users("pageview", C.ACTIVE_USERS_KEY),
        lambda: users("order", C.ORDER_USERS_KEY),
    ]
    # independent outputs over the staged table: submitted as concurrent jobs
    with ThreadPoolExecutor(max_workers=parallel_jobs) as pool:
        for f in [pool.submit(t) for t in tasks]:
            f.result()
    return paths
