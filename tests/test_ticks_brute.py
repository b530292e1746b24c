"""Property: counters visible under TTL and active users at ticks equal a
brute-force scan, for irregular grids and random events."""

import random

import pytest

from conftest import ms
from viewtally.operators import audience as A
from viewtally.operators import counters as K
from viewtally.operators.ticks import TickGrid

T0 = ms("2024-02-01 00:00:00")
TTL = {"pageview": 1_800_000, "click": 360_000, "order": 360_000}


def events(seed, n=300, span=3 * 3_600_000):
    rnd = random.Random(seed)
    rows = [(rnd.choice(list(TTL)), T0 + rnd.randrange(span), f"u{rnd.randrange(12)}", "v")
            for _ in range(n)]
    return rows


GRIDS = [(T0 + 17, 7 * 60_000 + 3), (T0, 5 * 60_000), (T0 + 30 * 60_000, 3_600_000), (T0 + 59_999, 61_000)]


@pytest.mark.parametrize("seed,grid_i", [(1, 0), (2, 1), (3, 2), (4, 3)])
def test_visible_counters_brute(spark, seed, grid_i):
    rows = events(seed)
    start, step = GRIDS[grid_i]
    grid = TickGrid(start, T0 + 4 * 3_600_000, step)
    df = spark.createDataFrame(rows, "metric string, ts_ms long, uid string, video string")
    got = {(r.metric, r.tick, r.bucket): r.n for r in
           K.visible_counters(df, grid).selectExpr(
               "metric", "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', tick) tick",
               "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', bucket) bucket", "n").collect()}
    want = {}
    for i in range(grid.count):
        t = start + i * step
        agg = {}
        for m, ts, _u, _v in rows:
            if ts <= t:
                b = ts - ts % 60_000
                n, lw = agg.get((m, b), (0, 0))
                agg[(m, b)] = (n + 1, max(lw, ts))
        for (m, b), (n, lw) in agg.items():
            if lw + TTL[m] > t:
                want[(m, t, b)] = n
    assert got == want


@pytest.mark.parametrize("seed,grid_i", [(5, 0), (6, 1), (7, 3)])
def test_users_at_ticks_brute(spark, seed, grid_i):
    rows = events(seed)
    start, step = GRIDS[grid_i]
    grid = TickGrid(start, T0 + 4 * 3_600_000, step)
    df = spark.createDataFrame([(u, ts) for _m, ts, u, _v in rows], "uid string, ts_ms long")
    got = {(r.tick_ms, r.uid): r.last_ms for r in A.users_at_ticks(df, grid).collect()}
    want = {}
    for i in range(grid.count):
        t = start + i * step
        for _m, ts, u, _v in rows:
            if t - 360_000 < ts <= t:
                want[(t, u)] = max(want.get((t, u), 0), ts)
    assert got == want
