"""Nothing is lost or doubled: rejects, re-runs after a crash, new checkpoints, day ranges."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from viewtally import jobs
from viewtally import schemas as S
from viewtally.functions import parse as P
from viewtally.functions import time as tm
from viewtally.operators import ledger as L
from viewtally.plans import backfill as B
from viewtally.plans import ingest as I
from viewtally.sources import messages as M

MESSAGE = ["topic", "partition", "offset", "key", "value"]


def table(spark, corrupt=False):
    m = M.messages(spark, SF001).select(*MESSAGE)
    if not corrupt:
        return m
    odd = F.col("offset") % 10
    return m.withColumns({
        "key": F.when(odd == 1, "soon").when(odd == 2, F.concat("key", F.lit("000"))).otherwise(F.col("key")),
        "value": F.when(odd == 3, F.lit('{"a":')).otherwise(F.col("value")),
        "topic": F.when((odd == 4), "nometric").otherwise(F.col("topic"))})


REASONS = {"bad key", "key out of range", "bad json", "unknown metric"}


def test_reject_reasons_of_log_rows(spark):
    rows = P.checked_log_rows(table(spark, corrupt=True))
    assert {r[0] for r in rows.select("reject_reason").distinct().collect()} == REASONS | {None}
    with pytest.raises(Exception, match="rejected message"):
        P.checked_log_rows(table(spark, corrupt=True), strict=True).collect()


def test_backfill_writes_every_message_once(spark, tmp):
    m = table(spark, corrupt=True)
    paths = B.run(spark, m, os.path.join(tmp, "out"), B.BackfillSpec(days=("2024-01-01", "2024-01-31")))
    rejects = spark.read.parquet(paths["rejects"])
    counted = spark.read.parquet(paths["counters"]).agg(F.sum("n")).first()[0]
    assert rejects.count() and counted + rejects.count() == m.count()
    assert {r.reason for r in rejects.select("reason").distinct().collect()} == REASONS
    assert rejects.where("key is null or value is null or offset is null").count() == 0
    with pytest.raises(Exception, match="rejected message|Malformed"):
        B.run(spark, m, os.path.join(tmp, "strict"), strict=True)


def test_one_day_equals_that_day_of_the_full_run(spark, tmp):
    m = table(spark)
    full = B.run(spark, m, os.path.join(tmp, "full"), B.BackfillSpec(days=("2024-01-01", "2024-01-30")))
    day = B.run(spark, m, os.path.join(tmp, "day"), B.BackfillSpec(days=("2024-01-09", "2024-01-09")))
    a, b = B.day_span("2024-01-09", "2024-01-09")
    for name in sorted(set(full) - {"rejects"}):
        whole, one = spark.read.parquet(full[name]), spark.read.parquet(day[name])
        at = next((F.col(c) for c in ("tick_ms", "bucket_ms") if c in whole.columns), tm.ntz_to_ms("tick"))
        want = whole.where((at >= a) & (at < b)).select(*one.columns)
        key = lambda df: sorted(map(str, df.collect()))
        assert key(one) == key(want) and one.count(), name


def _crash_run(spark, m, store, out):
    class Crash(RuntimeError):
        pass

    def crashing(rows, plan):
        I.parquet_sink(out)(rows, plan)
        raise Crash()
    with pytest.raises(Crash):
        I.run(spark, m, store, crashing)


def test_crash_then_more_messages(spark, tmp):
    m = table(spark)
    store = I.ParquetLedger(spark, os.path.join(tmp, "ledger"))
    store.write(L.bootstrap(spark.createDataFrame([], S.LEDGER), L.latest_offsets(m)))
    out = os.path.join(tmp, "out")
    _crash_run(spark, m.where("offset < 20"), store, out)
    done = I.run(spark, m, store, I.parquet_sink(out), dense=True)      # the log has grown meanwhile
    stored = spark.read.parquet(out)
    assert stored.count() == stored.select("msg_id").distinct().count() == m.count() == done.rows_written
    gone = m.where("offset % 7 != 3")
    store2 = I.ParquetLedger(spark, os.path.join(tmp, "ledger2"))
    store2.write(L.bootstrap(spark.createDataFrame([], S.LEDGER), L.latest_offsets(m)))
    with pytest.raises(L.LedgerError, match="ranges hold"):
        I.run(spark, gone, store2, I.parquet_sink(os.path.join(tmp, "o2")), dense=True)
    r = I.run(spark, gone, store2, I.parquet_sink(os.path.join(tmp, "o3")))
    assert r.rows_written == gone.count() < r.rows_expected


def test_ingestion_rejects(spark, tmp):
    m = table(spark, corrupt=True).where("topic != 'nometric'")
    store = I.ParquetLedger(spark, os.path.join(tmp, "ledger"))
    rej = os.path.join(tmp, "rejects")
    r = I.run(spark, m, store, I.parquet_sink(os.path.join(tmp, "out")), bootstrap=True, save_rejects=I.parquet_rejects(rej))
    assert r.rows_rejected == spark.read.parquet(rej).count() > 0
    assert r.rows_written + r.rows_rejected == m.count()
    with pytest.raises(Exception, match="rejected message"):
        I.run(spark, m, I.ParquetLedger(spark, os.path.join(tmp, "l2")), I.parquet_sink(os.path.join(tmp, "o2")), bootstrap=True)


def test_ledger_keeps_other_topics_and_raises_on_errors(spark, tmp):
    m = table(spark)
    root = os.path.join(tmp, "ledger")
    one, two = I.ParquetLedger(spark, root), I.ParquetLedger(spark, root)
    offs = L.latest_offsets(m).withColumnRenamed("until_off", "off")
    click, view = (offs.where(F.col("topic") == t) for t in ("test-click", "test-pageview"))
    one.write(click)
    two.write(view)                                  # a job that read the ledger before that
    one.write(click.withColumn("off", F.col("off") + 5).limit(1))
    got = {(r.topic, r.part): r.off for r in one.read().collect()}
    want = {(r.topic, r.part): r.off for r in offs.where("topic != 'test-order'").collect()}
    changed = {k for k in want if got[k] != want[k]}
    assert got.keys() == want.keys() and len(changed) == 1
    bad = os.path.join(tmp, "bad", "topic=t", "version=1")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        I.ParquetLedger(spark, os.path.join(tmp, "bad")).read().collect()


def test_new_checkpoint_keeps_stored_batches(spark, tmp):
    m = table(spark, corrupt=True)
    out, n = os.path.join(tmp, "logs"), m.count()
    for run, cut in enumerate(("offset < 30", "offset >= 30")):
        src = os.path.join(tmp, f"in{run}")
        m.where(cut).coalesce(1).write.json(src)
        for _ in range(2):      # a restart from the same checkpoint adds nothing
            jobs.main(["store", "--input", src, "--max-files-per-trigger", "5", "--once",
                       "--checkpoint", os.path.join(tmp, f"ck{run}"), "--out", out], spark)
    good, bad = spark.read.parquet(out), spark.read.parquet(f"{out}_rejects")
    assert good.count() + bad.count() == n and bad.count() > 0
    assert good.select("msg_id").distinct().count() == good.count()
