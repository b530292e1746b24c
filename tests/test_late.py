"""Late rows: what the streams drop is kept and counted, once, also over a
crash; other buckets are left alone."""

import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from viewtally import config as C
from viewtally import schemas as S
from viewtally.functions import parse as P
from viewtally.operators import counters as K
from viewtally.sinks import snapshot
from viewtally.sources import messages as M
from viewtally.streaming import late as LT
from viewtally.streaming import metrics as SM

TABLES = ["counters", "topvideos_m", "topvideos_h", "last_seen"]


def expected(events, name):
    ev = events.withColumn("ts", (F.col("ts_ms") / 1000).cast("timestamp"))
    cells = {"counters": SM.minute_counters, "topvideos_m": lambda e: SM.video_tier(e, "minute"),
             "topvideos_h": lambda e: SM.video_tier(e, "hour"), "last_seen": SM.last_seen_minutes}[name](ev)
    return {tuple(r) for r in cells.collect()}


@pytest.fixture(scope="module")
def arrivals(spark):
    """Events in an order of arrival that mixes old ones in, cut into 5 parts."""
    msgs = M.messages(spark, SF001, with_offsets=False)
    day = F.floor(F.col("key").cast("bigint") / (6 * C.DAY_MS))
    part = F.when(F.col("event_id") % 4 == 0, F.pmod(F.xxhash64("event_id"), F.lit(5))).otherwise(F.pmod(day, F.lit(5)))
    first = msgs.agg(F.min(day)).first()[0]
    return msgs.withColumn("part", F.when(F.col("event_id") % 4 == 0, part).otherwise(F.least(day - first, F.lit(4)))).cache()


def feed(spark, arrivals, src, i):
    arrivals.where(F.col("part") == i).select(*S.MESSAGE.fieldNames()).coalesce(1).write.mode("append").parquet(src)


def run_all(spark, src, stage, out, ck, names=TABLES):
    q = SM.start_staging(spark.readStream.schema(S.MESSAGE).parquet(src), stage, ck, {"availableNow": True})
    q.awaitTermination()
    streams = SM.start(None, out, ck, {"availableNow": True}, events=SM.staged_events(spark, stage), publish=False,
                       stage_dir=stage, compact_every=3)
    for q in streams.all():
        q.awaitTermination()
    return streams


def test_late_rows_are_added_once(spark, tmp, arrivals, monkeypatch):
    src, stage, out, ck = (os.path.join(tmp, x) for x in ("in", "staged", "out", "ck"))
    real, crashes = snapshot.write, []

    def crash_behind_the_write(df, root, batch_id, **kw):
        real(df, root, batch_id, **kw)
        late = os.path.join(LT.late_root(out, os.path.basename(root)), f"batch_id={batch_id}")
        if os.path.exists(late) and len(crashes) < 2 and root not in crashes:
            crashes.append(root)        # rows and late rows written, not committed
            raise RuntimeError("crash")

    monkeypatch.setattr(snapshot, "write", crash_behind_the_write)
    for i in range(5):
        feed(spark, arrivals, src, i)
        for _ in range(3):
            try:
                run_all(spark, src, stage, out, ck)
                break
            except Exception as e:
                assert "crash" in str(e)
                for q in spark.streams.active:
                    q.stop()
    assert len(crashes) == 2
    events = P.valid_events(arrivals)
    late = {}
    for name in TABLES:
        got = SM.read_table(spark, out, name)
        assert {tuple(r) for r in got.collect()} == expected(events, name), name
        late[name] = LT.late_rows(spark, out, name).count()
    assert all(late.values()) and late["counters"] > late["topvideos_h"]


def test_files_and_watermark_of_a_batch(spark, tmp):
    src, stage, out, ck = (os.path.join(tmp, x) for x in ("in", "staged", "out", "ck"))
    rows = [("pageview", t, "v1", "u1", None, None, None, None, None, None, False) for t in (10_000_000, 20_000_000)]
    for r in rows:
        spark.createDataFrame([r], SM.STAGED_EVENT).write.mode("append").partitionBy("rejected").parquet(stage)
        time.sleep(1.1)
    q = SM.start_counters(SM.staged_events(spark, stage, 1), out, ck, {"availableNow": True})
    q.awaitTermination()
    at = os.path.join(ck, "counters")
    batches = sorted(int(n) for n in os.listdir(os.path.join(at, "commits")) if n.isdigit())
    files = [LT.batch_files(spark, at, b) for b in batches]
    assert [len(f) for f in files[:2]] == [1, 1] and files[0] != files[1] and not sum(map(len, files[2:]))
    marks = [LT.judging_watermark(spark, at, b) for b in (*batches, batches[-1] + 1)]
    assert marks[0] == marks[1] == 0 and marks == sorted(marks) and marks[-1] == 20_000_000 - 1_800_000
