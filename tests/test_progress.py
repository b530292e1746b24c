"""Progress table over a restart, pools, the sketch tier and the job that runs
them all."""

import os

from pyspark.sql import functions as F

from conftest import SF001
from viewtally import config as C
from viewtally import jobs
from viewtally import schemas as S
from viewtally.functions import parse as P
from viewtally.sources import messages as M
from viewtally.streaming import keyed as KD
from viewtally.streaming import metrics as SM
from viewtally.streaming import progress as PG
from viewtally.streaming import running as RT
from viewtally.streaming import sketches as SK
from viewtally.streaming import storage as SS


def parts(spark, msgs, src, n=3):
    edges = [i / n for i in range(1, n)]
    cuts = msgs.select(F.col("key").try_cast("bigint").alias("k")).approxQuantile("k", edges, 0.0)
    bounds = [0, *cuts, float(1 << 62)]
    key = F.col("key").try_cast("bigint")
    for lo, hi in zip(bounds, bounds[1:]):
        yield lambda lo=lo, hi=hi: msgs.where((key >= lo) & (key < hi)).coalesce(1).write.mode("append").parquet(src)


def test_progress_equals_the_input_over_a_restart(spark, tmp):
    msgs = M.messages(spark, SF001, corrupt_every=10).select(*S.MESSAGE.fieldNames())
    src, root = os.path.join(tmp, "in"), os.path.join(tmp, "progress")
    listener, pools, ids = PG.ProgressTable(spark, root), [], set()
    spark.streams.addListener(listener)
    try:
        for more in parts(spark, msgs, src):
            more()
            for _ in range(2):      # the second start finds nothing new
                q = SS.start_parquet(spark.readStream.schema(S.MESSAGE).parquet(src), os.path.join(tmp, "out"),
                                     os.path.join(tmp, "ck"), {"availableNow": True})
                q.awaitTermination()
                PG.wait_for(spark, root, q)
                ids.add(str(q.id))
            live = SM.events_stream(spark.readStream.schema(S.MESSAGE).parquet(src))
            with PG.pool(spark, "mine"):
                q = live.writeStream.foreachBatch(
                    lambda df, b: pools.append((df.sparkSession.sparkContext.getLocalProperty(PG.POOL)))) \
                    .option("checkpointLocation", os.path.join(tmp, "ck2")).trigger(availableNow=True).start()
            q.awaitTermination()
    finally:
        spark.streams.removeListener(listener)
    assert len(ids) == 1 and set(pools) == {"mine"} and spark.sparkContext.getLocalProperty(PG.POOL) is None
    rows = [r for r in PG.read_progress(spark, root).collect() if r.stream_id in ids]
    assert len({r.batch_id for r in rows}) == len(rows) >= 3
    stored = spark.read.parquet(os.path.join(tmp, "out")).count()
    total = lambda c: sum(r[c] or 0 for r in rows)
    assert total("input_rows") == total("rows") == msgs.count() and total("rows") - total("rejected") == stored
    assert PG.read_progress(spark, os.path.join(tmp, "none")).count() == 0


def test_each_metric_query_has_its_pool(spark, tmp, monkeypatch):
    seen = {}
    real = SM.snapshot.write

    def spy(df, root, batch_id, **kw):
        seen[os.path.basename(root)] = df.sparkSession.sparkContext.getLocalProperty(PG.POOL)
        real(df, root, batch_id, **kw)

    monkeypatch.setattr(SM.snapshot, "write", spy)
    src = os.path.join(tmp, "in")
    M.messages(spark, SF001, with_offsets=False).select(*S.MESSAGE.fieldNames()).limit(50).write.parquet(src)
    streams = SM.start(spark.readStream.schema(S.MESSAGE).parquet(src), os.path.join(tmp, "out"), os.path.join(tmp, "ck"),
                       {"availableNow": True}, publish=False)
    for q in streams.all():
        q.awaitTermination()
    assert seen == {n: n for n in ("counters", "topvideos_m", "topvideos_h", "last_seen")}


def test_stored_sketches_union_to_any_horizon(spark, tmp):
    events = P.valid_events(M.messages(spark, SF001, with_offsets=False)).where("uid != ''") \
        .select("metric", "ts_ms", "uid").cache()
    src, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    cut = events.approxQuantile("ts_ms", [0.5], 0.0)[0]
    for part in (events.where(F.col("ts_ms") < cut), events.where(F.col("ts_ms") >= cut)):
        part.write.mode("append").parquet(src)
        live = spark.readStream.schema("metric string, ts_ms bigint, uid string").parquet(src)
        SK.start(live.withColumn("ts", (F.col("ts_ms") / 1000).cast("timestamp")), out, os.path.join(tmp, "ck"),
                 {"availableNow": True}).awaitTermination()
    tick = events.agg(F.max("ts_ms")).first()[0]
    for horizon in (C.LAST_SEEN_HORIZON_MS, 5 * C.HOUR_MS, 40 * C.DAY_MS):
        bucket = F.col("ts_ms") - F.pmod("ts_ms", F.lit(C.MINUTE_MS))
        exact = {r.metric: r.n for r in events.where((bucket > tick - horizon) & (bucket <= tick))
                 .groupBy("metric").agg(F.countDistinct("uid").alias("n")).collect()}
        got = {r.metric: r.approx_users for r in SK.users_in(spark, out, tick, horizon).collect()}
        assert got.keys() == exact.keys() and all(abs(got[m] - n) <= 0.05 * n for m, n in exact.items())
    assert SK.read(spark, os.path.join(tmp, "none")).count() == 0


def test_metrics_job_with_all_tables(spark, tmp):
    msgs = M.messages(spark, SF001, with_offsets=False).select(*S.MESSAGE.fieldNames())
    src, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    msgs.coalesce(1).write.json(src)
    jobs.main(["metrics", "--input", src, "--once", "--clock", "event", "--checkpoint", os.path.join(tmp, "ck"), "--out", out,
               "--also", "trend", "--also", "sketches", "--also", "active", "--progress", os.path.join(tmp, "progress")], spark)
    run = RT.RunningTrend(spark, f"{out}/trend", clock="event")
    tick, sums = run.trend()
    newest = SM.read_published(spark, out, C.TOP_VIDEOS_KEY).where(F.col("tick_ms") == tick).select("video", "n")
    assert {tuple(r) for r in newest.collect()} == {tuple(r) for r in sums.collect()}
    users = SK.read(spark, out)     # minutes with a user
    assert 0 < users.count() == users.join(SM.read_table(spark, out, "counters"), ["metric", "bucket_ms"], "left_semi").count()
    assert KD.read_active(spark, out).count() > 0
