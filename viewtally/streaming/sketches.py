"""Stored, mergeable sketches of users (AGG-10).

A tier of HyperLogLog sketches, one per (metric, minute), written by a stream
like the counters.  Sketches merge without the users: any horizon is the union
of its minutes, however many events they saw.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from viewtally import config as C
from viewtally.functions import time as tm
from viewtally.sinks import snapshot

NAME, KEYS = "users_hll", ["metric", "bucket_ms"]
SCHEMA = "metric string, bucket_ms bigint, sketch binary, last_ms bigint"
#: 2^LG_K registers: 1.6 % standard error at 12, 4 KB a full sketch
LG_K = 12


def minute_sketches(events: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """``metric, bucket_ms, sketch, last_ms`` per minute (of a stream: in
    update mode, the counters' watermark bounds its state).  A null or empty
    uid is no user."""
    ttl = max(s for _k, s in C.COUNTER_OF_METRIC.values())
    return (events.where(F.col("uid") != "").withWatermark("ts", f"{ttl} seconds")
            .groupBy("metric", F.window("ts", "1 minute"))
            .agg(F.hll_sketch_agg("uid", F.lit(lg_k)).alias("sketch"), F.max("ts_ms").alias("last_ms"))
            .select("metric", F.unix_millis("window.start").alias("bucket_ms"), "sketch", "last_ms"))


def start(events: DataFrame, out_root: str, ckpt_root: str, trigger: dict, lg_k: int = LG_K, files: int = 4) -> StreamingQuery:
    """Keep the sketch tier at ``<out_root>/users_hll``."""
    root = f"{out_root.rstrip('/')}/{NAME}"

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        snapshot.claim(spark, root, spark.sparkContext.getLocalProperty("sql.streaming.queryId"))
        snapshot.write(batch, root, batch_id, day_of="bucket_ms", files=files)

    return (minute_sketches(events, lg_k).writeStream.queryName(NAME).outputMode("update")
            .option("checkpointLocation", f"{ckpt_root.rstrip('/')}/{NAME}")
            .trigger(**trigger).foreachBatch(sink).start())


def read(spark: SparkSession, out_root: str, lo_ms: int | None = None, hi_ms: int | None = None) -> DataFrame:
    """The newest sketch of each (metric, minute), of minutes in ``[lo, hi]``:
    only the days of that range are opened."""
    bounded = lo_ms is not None and hi_ms is not None
    found = snapshot.latest(spark, f"{out_root.rstrip('/')}/{NAME}", KEYS,
                            snapshot.days_between(lo_ms, hi_ms) if bounded else None,
                            where=F.col("bucket_ms").between(lo_ms, hi_ms) if bounded else None)
    return spark.createDataFrame([], SCHEMA) if found is None else found


def users_in(spark: SparkSession, out_root: str, tick_ms: int, horizon_ms: int = C.LAST_SEEN_HORIZON_MS) -> DataFrame:
    """``metric, approx_users`` of the minutes that start in the horizon before
    the tick, the tick's own included."""
    lo = tick_ms - horizon_ms + 1
    return (read(spark, out_root, lo, tick_ms).groupBy("metric")
            .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_users")))


def users_per(sketches: DataFrame, grain_ms: int) -> DataFrame:
    """``metric, period_ms, approx_users`` per period of any grain of whole
    minutes, from the stored sketches."""
    return (sketches.groupBy("metric", tm.floor_ms("bucket_ms", grain_ms).alias("period_ms"))
            .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_users")))
