"""The running trend equals the trend over all cells at every tick; full ranks."""

import os
import random

import pytest
from pyspark.sql import functions as F

from viewtally import config as C
from viewtally.functions import time as tm
from viewtally.operators.ranking import rank_members
from viewtally.operators.trending import trend_at
from viewtally.streaming import running as RT

EVENTS = "metric string, ts_ms bigint, video string"
H, M = C.HOUR_MS, C.MINUTE_MS


def brute(events, tick):
    low, out = tick - tick % M - 5 * H, {}
    for metric, ts, video in events:
        if metric == "pageview" and low <= ts - ts % M <= tick:
            out[video] = out.get(video, 0) + 1
    return out


def sums(run):
    return {r.video: r.n for r in run.trend()[1].collect()}


def batches(rng, n, start=1_700_000_000_000):
    """Steps of minutes to hours, late and repeated events, other metrics."""
    now, out = start, []
    for _ in range(n):
        now += rng.choice([0, 20_000, 5 * M, 50 * M, 2 * H, 9 * H])
        out.append([(rng.choice(["pageview"] * 4 + ["click"]), now - rng.choice([0, 1000, 30 * M, 4 * H, 7 * H]) * rng.randrange(2),
                     f"v{rng.randrange(6)}") for _ in range(rng.randrange(0, 25))])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_every_tick_equals_the_whole_trend(spark, tmp, seed):
    rng, seen = random.Random(seed), []
    run = RT.RunningTrend(spark, os.path.join(tmp, "trend"), clock="event", compact_every=4, keep=3)
    for n, rows in enumerate(batches(rng, 12)):
        df = spark.createDataFrame(rows, EVENTS)
        for _ in range(1 + (rng.random() < 0.3)):       # a replay changes nothing
            run.update(df, n)
        seen += rows
        views = [t for m, t, _v in seen if m == "pageview"]
        tick, got = run.trend()[0], sums(run)
        assert tick == (max(views) if views else None)
        if tick is not None:
            assert got == brute(seen, tick)
            # cells that come after their hour was removed were never inside the horizon
            assert {r.video: r.n for r in run.rebuilt(n + 1).collect()} == got
    names = os.listdir(os.path.join(tmp, "trend", "sums"))
    assert len(names) <= 3 + 1


def test_by_the_wall_clock(spark, tmp, monkeypatch):
    """Events ahead of the clock count when it reaches them; an idle stream's
    trend runs out."""
    clock = [1_700_000_000_000]
    monkeypatch.setattr(tm, "now_ms", lambda: clock[0])
    run, seen, rng = RT.RunningTrend(spark, os.path.join(tmp, "trend")), [], random.Random(4)
    for n in range(12):
        rows = [] if n > 7 else [("pageview", clock[0] + rng.choice([-H, -M, 0, M, 40 * M, 3 * H]), f"v{rng.randrange(4)}")
                                 for _ in range(12)]
        run.update(spark.createDataFrame(rows, EVENTS), n)
        seen += rows
        assert run.trend()[0] == clock[0] and sums(run) == brute(seen, clock[0]), n
        clock[0] += rng.choice([M, 10 * M, H]) if n < 8 else 4 * H
    assert sums(run) == {}


def test_a_tick_opens_only_what_changed(spark, tmp):
    run = RT.RunningTrend(spark, os.path.join(tmp, "trend"), clock="event", compact_every=5)
    start, opened = 1_700_000_400_000, []
    for n in range(45):         # 10 minutes a batch: 7.5 hours
        run.update(spark.createDataFrame([("pageview", start + n * 10 * M + k, f"v{k}") for k in range(3)], EVENTS), n)
        opened.append(len(run.opened))
    # its own cells, and the folders of the one or two hours at the lower end
    assert max(opened[:25]) == 1 and max(opened) <= 1 + 2 * 3
    assert len(run._hours(0, 1 << 62)) <= 8
    assert sums(run) == {f"v{k}": 31 for k in range(3)}
    tick = run.trend()[0]
    cells = run._cells(0, 1 << 62, 45).withColumn("last_ms", F.col("bucket_ms"))
    assert {r.video: r.n for r in trend_at(cells, tick).collect()} == sums(run)


def test_an_incomplete_merge_is_not_read(spark, tmp):
    root = os.path.join(tmp, "trend")
    run = RT.RunningTrend(spark, root, clock="event", compact_every=100)
    for n in range(3):
        run.update(spark.createDataFrame([("pageview", 1_700_000_000_000 + n, "v")], EVENTS), n)
    [hour] = run._hours(0, 1 << 62)
    os.makedirs(os.path.join(root, "cells", f"hour={hour}", "b0_2"))    # a crash inside the merge
    assert run._cells(0, 1 << 62, 3).agg(F.sum("n")).first()[0] == 3
    run.compact(3)
    assert [p.rsplit("/", 1)[1] for p in run._folders(hour, 3)] == ["b0_2"]
    assert run._cells(0, 1 << 62, 3).agg(F.sum("n")).first()[0] == 3


def test_a_batch_of_many_hours_is_written_by_few_jobs(spark, tmp):
    run = RT.RunningTrend(spark, os.path.join(tmp, "trend"), clock="event")
    start = 1_700_000_000_000 - 1_700_000_000_000 % H
    rows = [("pageview", start + h * H + k * M, f"v{k % 3}") for h in range(60) for k in range(5)]
    spark.sparkContext.setJobGroup("many hours", "")
    try:
        run.update(spark.createDataFrame(rows, EVENTS), 0)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("many hours")) < 30
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # only the horizon's hours are opened, and the next tick finds its cells in them
    tick = rows[-1][1]
    assert len(run.opened) == 6 and sums(run) == brute(rows, tick)
    assert len(run._hours(0, 1 << 62)) == 60 and run._cells(0, 1 << 62, 1).agg(F.sum("n")).first()[0] == 300
    run.update(spark.createDataFrame([("pageview", tick + 2 * H, "v9")], EVENTS), 1)
    assert sums(run) == brute([*rows, ("pageview", tick + 2 * H, "v9")], tick + 2 * H)


def test_an_hour_of_many_cells_is_written_by_several_tasks(spark, tmp, monkeypatch):
    monkeypatch.setattr(RT, "HOUR_ROWS", 20)
    run = RT.RunningTrend(spark, os.path.join(tmp, "trend"), clock="event")
    rows = [("pageview", 1_700_000_000_000, f"v{k}") for k in range(200)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")    # small tasks stay apart
    try:
        for _ in range(2):      # a replay
            run.update(spark.createDataFrame(rows, EVENTS), 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    [folder] = run._folders(run._hours(0, 1 << 62)[0], 1)
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) > 1
    assert run._cells(0, 1 << 62, 1).agg(F.sum("n")).first()[0] == 200 and sums(run) == brute(rows, rows[0][1])


def test_ranks_of_all_members(spark):
    rng = random.Random(9)
    rows = [(t, f"v{i}", rng.randrange(5)) for t in range(4) for i in range(rng.randrange(0, 400))] + [(9, None, 1)]
    got = {(r.tick_ms, r.video): r["rank"] for r in rank_members(spark.createDataFrame(rows, "tick_ms long, video string, n long")).collect()}
    for t in {r[0] for r in rows}:
        members = sorted((r for r in rows if r[0] == t), key=lambda r: (r[2], r[1] or ""), reverse=True)
        assert [got[t, r[1]] for r in members] == list(range(1, len(members) + 1))


def test_no_window_over_the_members_of_a_tick(spark):
    df = rank_members(spark.createDataFrame([(1, "a", 2)], "tick_ms long, video string, n long"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert len(windows) == 1 and "_run" in windows[0] and "video" not in windows[0]
