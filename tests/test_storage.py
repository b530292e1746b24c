"""Round trips: day-partitioned Parquet, embedded Derby JDBC, snapshots,
and the restartable ingestion job."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from viewtally import schemas as S
from viewtally.functions import parse as P
from viewtally.operators import ledger as L
from viewtally.plans import ingest as I
from viewtally.sinks import jdbc as JS
from viewtally.sinks import parquet as PS
from viewtally.sinks import snapshot
from viewtally.sources import jdbc as JR
from viewtally.sources import json as SJ
from viewtally.sources import messages as M

DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def msgs(spark):
    return M.messages(spark, SF001)


def test_parquet_day_partitions(spark, tmp):
    rows = P.log_rows(msgs(spark), with_id=True)
    path = os.path.join(tmp, "logs")
    PS.write_logs(rows, path)
    back = PS.read_logs(spark, path)
    assert back.count() == rows.count()
    assert PS.day_range_violations(back).count() == 0
    day = back.where(F.col("log_day") == "2024_01_05")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_day" in plan
    assert day.count() == rows.where(F.date_format("log_date", "yyyy_MM_dd") == "2024_01_05").count()


def test_batch_overwrite_is_replay_safe(spark, tmp):
    rows = P.log_rows(msgs(spark), with_id=True)
    root = os.path.join(tmp, "stream")
    assert PS.write_batch(rows, root, 3)
    assert PS.write_batch(rows, root, 3)            # replay of batch 3
    assert not PS.write_batch(rows.limit(0), root, 4)   # empty batch skipped
    assert spark.read.parquet(root).count() == rows.count()


def test_jdbc_round_trip_and_idempotent_append(spark, tmp):
    url = f"jdbc:derby:{os.path.join(tmp, 'db')};create=true"
    props = {"driver": DERBY}
    rows = P.log_rows(msgs(spark), with_id=True)
    n = rows.count()
    types = "metric VARCHAR(50), data VARCHAR(32000), msg_id VARCHAR(200)"
    JS.append(rows, url, "log_event", props, column_types=types)
    JS.append_new(spark, rows, url, "log_event", props=props, column_types=types)
    back = JR.read_table(spark, url, "log_event", props)
    assert back.count() == n
    assert back.select("msg_id").distinct().count() == n


def test_snapshot_latest(spark, tmp):
    root = os.path.join(tmp, "snap")
    snapshot.write(spark.createDataFrame([("a", 1), ("b", 1)], "k string, n long"), root, 0)
    snapshot.write(spark.createDataFrame([("a", 5)], "k string, n long"), root, 1)
    snapshot.write(spark.createDataFrame([("a", 7)], "k string, n long"), root, 1)   # replay
    got = {r.k: r.n for r in snapshot.latest(spark, root, ["k"]).collect()}
    assert got == {"a": 7, "b": 1}


def test_json_schema_discovery(spark):
    m = msgs(spark)
    schema = SJ.infer_schema(m)
    parsed = SJ.parse_with(m, schema)
    assert {"video", "uuid", "timestamp", "order"} <= set(parsed.columns)


def _run(spark, m, store, root, **kw):
    return I.run(spark, m, store, I.parquet_sink(root), **kw)


def test_ingestion_resume_and_replay(spark, tmp):
    m = msgs(spark)
    store = I.ParquetLedger(spark, os.path.join(tmp, "ledger"))
    out = os.path.join(tmp, "out")
    topics = ["test-pageview", "test-click", "test-order"]
    # no ledger rows yet: the job stops before writing anything
    with pytest.raises(L.LedgerError):
        _run(spark, m, store, out, topics=topics)
    assert not os.path.exists(out)
    # first run with bootstrap reads everything and commits the offsets
    half = m.where(F.col("offset") < 50)
    r1 = _run(spark, half, store, out, topics=topics, bootstrap=True)
    assert r1.rows_written == half.count()
    # next run resumes from the ledger
    r2 = _run(spark, m, store, out, topics=topics)
    assert r2.rows_written == m.count() - half.count()
    stored = spark.read.parquet(out)
    assert stored.count() == m.count() and stored.select("msg_id").distinct().count() == m.count()
    # nothing new: a rerun writes nothing and changes nothing
    r3 = _run(spark, m, store, out, topics=topics)
    assert r3.rows_written == 0 and spark.read.parquet(out).count() == m.count()
    led = {(r.topic, r.part): r.off for r in store.read().collect()}
    want = {(r.topic, r.part): r.until_off for r in L.latest_offsets(m).collect()}
    assert led == want


def test_ingestion_crash_before_commit_is_replayed_once(spark, tmp):
    m = msgs(spark)
    store = I.ParquetLedger(spark, os.path.join(tmp, "ledger"))
    store.write(L.bootstrap(spark.createDataFrame([], S.LEDGER), L.latest_offsets(m)))
    out = os.path.join(tmp, "out")

    class Crash(RuntimeError):
        pass

    def crashing(rows, plan):
        I.parquet_sink(out)(rows, plan)
        raise Crash()

    with pytest.raises(Crash):
        I.run(spark, m, store, crashing)
    I.run(spark, m, store, I.parquet_sink(out))       # same ranges again
    assert spark.read.parquet(out).count() == m.count()


def test_jdbc_ledger_and_sink(spark, tmp):
    url = f"jdbc:derby:{os.path.join(tmp, 'db2')};create=true"
    props = {"driver": DERBY}
    m = msgs(spark)
    seed = L.bootstrap(spark.createDataFrame([], S.LEDGER), L.latest_offsets(m)) \
        .withColumn("off", F.lit(0).cast("bigint"))
    JS.append(seed, url, "topic_offsets", props, column_types="topic VARCHAR(255)")
    store = I.JdbcLedger(spark, url, "topic_offsets", props)
    sink = I.jdbc_sink(spark, url, "log_event", props)
    I.run(spark, m.where(F.col("offset") < 20), store, sink)
    I.run(spark, m, store, sink)
    back = JR.read_table(spark, url, "log_event", props)
    assert back.count() == m.count()
    assert JR.read_ledger(spark, url, "topic_offsets", "test-click", props).count() == 4


def test_ingestion_stops_before_writing_on_unknown_latest(spark, tmp):
    m = msgs(spark)
    store = I.ParquetLedger(spark, os.path.join(tmp, "ledger"))
    store.write(L.bootstrap(spark.createDataFrame([], S.LEDGER), L.latest_offsets(m)))
    bad = L.latest_offsets(m).withColumn("until_off", F.when(F.col("part") == 2, -1)
                                         .otherwise(F.col("until_off")).cast("bigint"))
    out = os.path.join(tmp, "out")
    with pytest.raises(L.LedgerError, match="unknown"):
        I.run(spark, m, store, I.parquet_sink(out), latest=bad)
    assert not os.path.exists(out)
    assert {r.off for r in store.read().collect()} == {0}


def test_snapshot_range_read_prunes(spark, tmp):
    root = os.path.join(tmp, "snap")
    snapshot.write(spark.createDataFrame([(0, "a", 1), (60_000, "a", 2)], "bucket_ms long, video string, n long"),
                   root, 0, day_of="bucket_ms")
    snapshot.write(spark.createDataFrame([(60_000, "a", 5)], "bucket_ms long, video string, n long"),
                   root, 1, day_of="bucket_ms")
    got = snapshot.latest(spark, root, ["bucket_ms", "video"], ["1970-01-01"],
                          where=F.col("bucket_ms") >= 60_000)
    assert [(r.bucket_ms, r.n) for r in got.collect()] == [(60_000, 5)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(bucket_ms), GreaterThanOrEqual(bucket_ms,60000)]" in plan
