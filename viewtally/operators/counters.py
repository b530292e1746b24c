"""Bucket counters and rollup tiers (AGG-1..5, AGG-9, STR-2, STR-4).

All aggregates are plain ``groupBy`` on computed bucket columns, so Spark
combines map-side before the shuffle: a hot video or a busy minute only costs
one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtally import config as C
from viewtally.functions import time as tm
from viewtally.operators.ticks import TickGrid


def bucket_of(grain: str, ms="ts_ms", tz: str = C.LABEL_TZ):
    if grain == "minute":
        return tm.minute_start(ms)
    if grain == "hour":
        return tm.hour_start(ms, tz)
    raise ValueError(f"unknown grain {grain!r}")


def label_of(grain: str, ms, tz: str = C.LABEL_TZ):
    return tm.minute_label(ms, tz) if grain == "minute" else tm.hour_label(ms, tz)


def bucket_counts(events: DataFrame, grain: str = "minute", by: list[str] | None = None,
                  tz: str = C.LABEL_TZ) -> DataFrame:
    """Rows per (bucket[, by...]): ``bucket_ms, *by, n, last_ms`` (raw tier).

    ``last_ms`` is the newest event time in the group, the stand-in for the
    last write that refreshes a key's TTL.
    """
    by = by or []
    return (events.groupBy(bucket_of(grain, "ts_ms", tz).alias("bucket_ms"), *by)
            .agg(F.count(F.lit(1)).alias("n"), F.max("ts_ms").alias("last_ms")))


def present(df: DataFrame, key_name: str | None, grain: str = "minute",
            tz: str = C.LABEL_TZ, keep: list[str] | None = None) -> DataFrame:
    """``bucket_ms`` -> ``bucket`` (UTC TIMESTAMP_NTZ) [+ ``bucket_key`` = ``<name>:<label>``]."""
    keep = keep if keep is not None else [c for c in df.columns if c not in ("bucket_ms", "last_ms")]
    cols = [tm.ms_to_ntz("bucket_ms").alias("bucket")]
    if key_name:
        cols.append(tm.bucket_key(key_name, label_of(grain, F.col("bucket_ms"), tz)).alias("bucket_key"))
    return df.select(*cols, *keep)


def metric_per_minute(events: DataFrame, metric: str, tz: str = C.LABEL_TZ) -> DataFrame:
    """AGG-1..3: ``videoviews`` / ``pageclicks`` / ``orders`` per minute, all videos together."""
    key, _ttl = C.COUNTER_OF_METRIC[metric]
    counts = bucket_counts(events.where(F.col("metric") == metric), "minute", tz=tz)
    return present(counts, key, "minute", tz, keep=["n"])


def video_views(events: DataFrame, grain: str = "minute", tz: str = C.LABEL_TZ) -> DataFrame:
    """AGG-4 / AGG-5: page views per (minute | hour, video)."""
    key = C.TOP_VIDEOS_MINUTE_KEY if grain == "minute" else C.TOP_VIDEOS_HOUR_KEY
    counts = bucket_counts(events.where(F.col("metric") == "pageview"), grain, ["video"], tz)
    return present(counts, key, grain, tz, keep=["video", "n"])


def _default_ttls() -> dict[str, int]:
    return {m: ttl for m, (_k, ttl) in C.COUNTER_OF_METRIC.items()}


def _ttl_ms(ttl_s: dict[str, int]):
    """The TTL (ms) of the row's metric as a column expression."""
    out = None
    for m, sec in ttl_s.items():
        v = F.lit(sec * 1000).cast("bigint")
        out = F.when(F.col("metric") == m, v) if out is None else out.when(F.col("metric") == m, v)
    return out


def visible_counters(events: DataFrame, grid: TickGrid,
                     ttl_s: dict[str, int] | None = None) -> DataFrame:
    """STR-4: minute counters as a reader sees them at each tick.

    A bucket is visible at tick ``t`` iff its last write (newest event with
    ``ts <= t``) plus the key's TTL is after ``t``; its value counts the events
    with ``ts <= t``.  Events are first combined per (metric, bucket, first
    tick they reach); each such row is then spread over the ticks it can
    still be visible at: ``[first tick, bucket end + ttl)``, a bounded count.
    Output ``metric, tick, bucket, n``.
    """
    ttl_s = ttl_s or _default_ttls()
    ttl_ms = _ttl_ms(ttl_s)
    ev = events.where(F.col("metric").isin(*ttl_s))
    first = (ev.groupBy("metric", tm.minute_start("ts_ms").alias("bucket_ms"),
                        grid.first_at_or_after("ts_ms").alias("ft"))
             .agg(F.count(F.lit(1)).alias("c"), F.max("ts_ms").alias("lw")))
    spread = first.select(
        "metric", "bucket_ms", "c", "lw",
        F.explode(grid.ticks_in(F.col("ft"), F.col("bucket_ms") + C.MINUTE_MS + ttl_ms)).alias("tick_ms"))
    vis = (spread.groupBy("metric", "tick_ms", "bucket_ms")
           .agg(F.sum("c").alias("n"), F.max("lw").alias("lw"))
           .where(F.col("lw") + ttl_ms > F.col("tick_ms")))
    return vis.select("metric", tm.ms_to_ntz("tick_ms").alias("tick"),
                      tm.ms_to_ntz("bucket_ms").alias("bucket"), F.col("n").cast("bigint").alias("n"))


def visible_at(counters: DataFrame, tick_ms: int, ttl_s: dict[str, int] | None = None) -> DataFrame:
    """STR-4 read side on a live counter table (``metric, bucket_ms, n,
    last_ms``, e.g. the streaming snapshot): the buckets a key lookup still
    finds at ``tick_ms`` — written at or before the tick and not yet expired."""
    ttl_ms = _ttl_ms(ttl_s or _default_ttls())
    return counters.where((F.col("last_ms") <= tick_ms) & (F.col("last_ms") + ttl_ms > tick_ms))


def batch_counts(events: DataFrame, batch_ms: int = C.HOUR_MS) -> DataFrame:
    """AGG-9 / SNK-4: rows per metric and micro-batch, batches cut every ``batch_ms``
    of event time.  Output ``metric, batch, n``."""
    return (events.groupBy("metric", tm.floor_ms("ts_ms", batch_ms).alias("b"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("metric", tm.ms_to_ntz("b").alias("batch"), "n"))
