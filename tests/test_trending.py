"""Property: the tiered trend equals a brute-force scan of raw views."""

import random
from collections import Counter

import pytest

from conftest import ms
from viewtally.operators import trending as TR
from viewtally.operators.ticks import TickGrid

H, M = 3_600_000, 60_000
T0 = ms("2024-03-01 00:00:00")
ZONES = {"Asia/Ho_Chi_Minh": 7 * H, "Asia/Kolkata": 5 * H + 30 * M}


def views(seed, n=400, span=14 * H):
    rnd = random.Random(seed)
    return [(T0 + rnd.randrange(span), f"v{rnd.randrange(6)}") for _ in range(n)]


def hour_start(t, off):
    if isinstance(off, str):      # a zone with changing offset: ask zoneinfo
        from datetime import datetime, timezone
        from zoneinfo import ZoneInfo
        o = datetime.fromtimestamp(t / 1000, tz=timezone.utc).astimezone(ZoneInfo(off)).utcoffset()
        off = int(o.total_seconds() * 1000)
    return (t + off) // H * H - off


def brute(rows, grid, off, mode):
    out = {}
    lw_h, lw_m = {}, {}
    for ts, _v in rows:
        lw_h[hour_start(ts, off)] = max(lw_h.get(hour_start(ts, off), 0), ts)
        lw_m[ts // M * M] = max(lw_m.get(ts // M * M, 0), ts)
    for i in range(grid.count):
        t = grid.start_ms + i * grid.step_ms
        hh, mm = hour_start(t, off), t // M * M
        c = Counter()
        for ts, v in rows:
            if mode == "exact":
                ok = mm - 5 * H <= ts <= t
            else:
                hb, mb = hour_start(ts, off), ts // M * M
                ok = ((hh <= ts <= t)
                      or (hh - 4 * H <= hb <= hh - H and lw_h[hb] + 4 * H > t)
                      or (mm - 5 * H <= mb < hh - 4 * H and lw_m[mb] + 5 * H > t))
            if ok:
                c[v] += 1
        for v, n in c.items():
            out[(t, v)] = n
    return out


def test_dst_zone_uses_general_path(spark):
    """Across the March 2024 switch in Berlin the offset changes, so hour keys
    go through the zone conversion; results still equal brute force."""
    t0 = ms("2024-03-30 20:00:00")
    rnd = random.Random(11)
    rows = [(t0 + rnd.randrange(12 * H), f"v{rnd.randrange(4)}") for _ in range(300)]
    grid = TickGrid(t0 + 30 * M, t0 + 14 * H, H)
    df = spark.createDataFrame(rows, "ts_ms long, video string")
    for mode in ("exact", "ttl"):
        got = {(r.tick_ms, r.video): r.n
               for r in TR.trending(df, grid, tz="Europe/Berlin", mode=mode).collect()}
        assert got == brute(rows, grid, "Europe/Berlin", mode)


@pytest.mark.parametrize("seed,step,offset,zone,mode", [
    (1, H, 30 * M, "Asia/Ho_Chi_Minh", "exact"),
    (2, 7 * M + 13_000, 0, "Asia/Ho_Chi_Minh", "exact"),
    (3, 11 * M, 17, "Asia/Kolkata", "exact"),
    (4, H, 30 * M, "Asia/Ho_Chi_Minh", "ttl"),
    (5, 13 * M, 5_000, "Asia/Kolkata", "ttl"),
])
def test_tiers_equal_brute_force(spark, seed, step, offset, zone, mode):
    rows = views(seed)
    # ticks exactly on event times hit the partial-minute path
    rows += [(T0 + offset + k * step, "v0") for k in range(3, 9)]
    grid = TickGrid(T0 + offset, T0 + 16 * H, step)
    df = spark.createDataFrame(rows, "ts_ms long, video string")
    got = {(r.tick_ms, r.video): r.n for r in TR.trending(df, grid, tz=zone, mode=mode).collect()}
    assert got == brute(rows, grid, ZONES[zone], mode)


def test_top_k_ties_by_video_desc(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (1, "c", 3), (2, "a", 1)],
                               "tick_ms long, video string, n long")
    got = [(r.tick_ms, r.video, r.rank) for r in TR.top_k(df, 2).orderBy("tick_ms", "rank").collect()]
    assert got == [(1, "b", 1), (1, "a", 2), (2, "a", 1)]
