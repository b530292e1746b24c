"""Keyed state: users expire and buckets restart from 1 by time alone, also
over a restart."""

import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from viewtally.streaming import keyed as KD


def brute_spans(ts, horizon):
    out = []
    for t in sorted(ts):
        if out and t - out[-1][1] < horizon:
            out[-1] = (out[-1][0], t, out[-1][2] + 1)
        else:
            out.append((t, t, 1))
    return out


def test_spans_in_any_order_and_chunks():
    rng = random.Random(5)
    for _ in range(300):
        ts = [rng.randrange(200) for _ in range(rng.randrange(1, 30))]
        spans, at = [], 0
        while at < len(ts):     # chunk by chunk, unsorted
            step = rng.randrange(1, 6)
            spans = KD.merge_spans(spans + KD.spans_of(np.array(ts[at:at + step]), 10), 10)
            at += step
        assert spans == brute_spans(ts, 10)


class OneKey:
    """A key's state and timers in memory; counts what would be calls to the JVM."""

    def __init__(self):
        self.held, self.timers, self.calls = [], set(), 0

    def getListState(self, *_):
        return self

    def exists(self):
        self.calls += 1
        return bool(self.held)

    def get(self):
        self.calls += 1
        return iter(self.held)

    def put(self, rows):
        self.calls, self.held = self.calls + 1, list(rows)

    def clear(self):
        self.calls, self.held = self.calls + 1, []

    def listTimers(self):
        self.calls += 1
        return iter(self.timers)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


class At:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):
        return self.now


def test_a_key_needs_few_calls_and_no_frame(monkeypatch):
    monkeypatch.setattr(KD, "CHUNK", 4)
    rng = random.Random(6)
    for _ in range(100):
        state, users, now, seen, ended = OneKey(), KD.ActiveUsers(10, True), 0, [], []
        users.init(state)
        for _ in range(rng.randrange(1, 8)):
            ts = [now + rng.randrange(60) for _ in range(rng.randrange(1, 15))]
            seen += ts
            new, state.calls = not state.held, 0
            rows = iter([Row(metric="order", uid="u", ts_ms=t) for t in ts])
            [told] = users.handleInputRows(("order", "u"), rows, At(now))
            assert state.calls <= (3 if new else 4)
            assert (told.metric, told.uid, told.active) == ("order", "u", True)
            assert (told.since_ms, told.last_ms, told.n) == state.held[-1]
            now += rng.choice([0, 5, 40, 100])
            while state.timers and min(state.timers) <= now:
                state.calls, fired = 0, min(state.timers)
                gone = list(users.handleExpiredTimer(("order", "u"), At(now), None))
                assert state.calls <= 3
                # the newest period that lasts is told beside those that ended
                assert [tuple(r)[2:5] for r in gone if r.active] == state.held[-1:]
                ended += [(r.since_ms, r.last_ms, r.n) for r in gone if not r.active]
                state.timers.discard(fired)     # Spark does
            # one timer, at the end of the first period
            assert state.timers == ({min(last for _, last, _ in state.held) + 10} if state.held else set())
        assert sorted(ended + state.held) == brute_spans(seen, 10)


def source(spark, folder):
    os.makedirs(folder, exist_ok=True)
    schema = "metric string, ts_ms bigint, uid string"
    return spark.readStream.schema(schema).parquet(folder).withColumn("ts", (F.col("ts_ms") / 1000).cast("timestamp"))


def feed(spark, folder, rows):
    spark.createDataFrame(rows, "metric string, ts_ms bigint, uid string").coalesce(1).write.mode("append").parquet(folder)


def until(what, seconds=90):
    end = time.time() + seconds
    while time.time() < end:
        try:
            if what():
                return True
        except Exception:       # the table is not there yet
            pass
        time.sleep(0.5)
    return False


@pytest.fixture()
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_user_expires_without_an_event(spark, tmp, few_partitions):
    src, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    events = source(spark, src)
    start = lambda: KD.start_active_users(events, out, ck, {"processingTime": "1 second"}, horizon_ms=15_000, event_time=False)
    active = lambda: {r.uid: r.n for r in KD.read_active(spark, out).collect()}
    q = start()
    now = int(time.time() * 1000)
    feed(spark, src, [("pageview", now, "a"), ("pageview", now, "a"), ("order", now + 600_000, "b")])
    assert until(lambda: active() == {"a": 2, "b": 1})
    q.stop()                    # a restart keeps state and timers
    q = start()
    try:
        assert until(lambda: active() == {"b": 1})      # nothing arrived
        [gone] = KD.read_periods(spark, out).collect()
        assert (gone.metric, gone.uid, gone.since_ms, gone.n) == ("pageview", "a", now, 2)
    finally:
        q.stop()


def test_a_bucket_restarts_from_1(spark, tmp, few_partitions):
    src, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    ttl = {"pageview": 20_000, "click": 3_600_000}
    start = lambda: KD.start_expiring_counters(source(spark, src), out, ck, {"processingTime": "1 second"}, ttl_ms=ttl)
    live = lambda: {(r.metric, r.bucket_ms): r.n for r in KD.read_expiring(spark, out).collect()}
    q = start()
    feed(spark, src, [("pageview", 60_001, "a"), ("pageview", 119_999, "b"), ("click", 60_000, "a")])
    assert until(lambda: live() == {("pageview", 60_000): 2, ("click", 60_000): 1})
    feed(spark, src, [("pageview", 60_500, "c")])
    assert until(lambda: live().get(("pageview", 60_000)) == 3)
    q.stop()
    q = start()
    try:
        assert until(lambda: live() == {("click", 60_000): 1})      # expired, nothing arrived
        feed(spark, src, [("pageview", 60_500, "c"), ("click", 60_500, "c")])
        assert until(lambda: live() == {("pageview", 60_000): 1, ("click", 60_000): 2})
    finally:
        q.stop()


def test_a_user_with_an_ended_period_stays_active(spark, tmp, few_partitions):
    src, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    feed(spark, src, [("pageview", 1_000_000, "a"), ("pageview", 9_000_000, "a"), ("pageview", 2_000_000, "b")])
    KD.start_active_users(source(spark, src), out, ck, {"availableNow": True}).awaitTermination()
    assert [(r.uid, r.since_ms) for r in KD.read_active(spark, out).collect()] == [("a", 9_000_000)]
    assert sorted(r.uid for r in KD.read_periods(spark, out).collect()) == ["a", "b"]


def test_event_time_closes_periods_and_takes_rows_in_between(spark, tmp, few_partitions):
    src, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    for rows in ([("pageview", 1_000_000, "a"), ("pageview", 1_500_000, "a"), ("click", 9_000_000, "a")],
                 [("pageview", 1_250_000, "a"), ("pageview", 3_000_000, "b")], [("order", 90_000_000, "z")]):
        feed(spark, src, rows)
        q = KD.start_active_users(source(spark, src), out, ck, {"availableNow": True}, delay_ms=1_000_000)
        q.awaitTermination()
    got = {tuple(r) for r in KD.read_periods(spark, out).collect()}
    # the row in between joined both periods; the click counts for no set
    assert got == {("pageview", "a", 1_000_000, 1_500_000, 3), ("pageview", "b", 3_000_000, 3_000_000, 1)}
    assert [r.uid for r in KD.read_active(spark, out).collect()] == ["z"]
