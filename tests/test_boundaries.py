"""Edge cases of TTL, purge and tick arithmetic on hand-made rows."""

from pyspark.sql import functions as F

from conftest import ms
from viewtally.operators import audience as A
from viewtally.operators import counters as K
from viewtally.operators.ticks import TickGrid


def events(spark, rows, cols="metric string, ts_ms bigint, uid string, video string"):
    return spark.createDataFrame(rows, cols)


def test_purge_boundary(spark):
    t = ms("2024-01-01 10:06:00")
    grid = TickGrid(t, t + 1, 60_000)
    ev = events(spark, [("pageview", t - 360_000, "gone", "v"), ("pageview", t - 359_999, "kept", "v")])
    out = {r.uid: r.last_ms for r in A.users_at_ticks(ev, grid).collect()}
    assert out == {"kept": t - 359_999}


def test_purge_before_and_scores(spark):
    t = ms("2024-01-01 10:06:00")
    m = spark.createDataFrame([("a", t - 360_000), ("b", t - 359_999)], "uid string, last_ms bigint")
    assert [r.uid for r in A.purge_before(m, t).collect()] == ["b"]
    assert [r.uid for r in A.expire_by_score(m, "0", str(t - 360_000)).collect()] == ["b"]
    assert [r.uid for r in A.expire_by_score(m, "-inf", f"({t - 360_000}").collect()] == ["a", "b"]


def test_out_of_order_policies(spark):
    df = spark.createDataFrame([("u", 1005, 0, 1), ("u", 1001, 0, 2)],
                               "uid string, ts_ms bigint, partition int, offset bigint")
    assert A.last_seen(df).first().last_ms == 1005


def test_expire_by_lex(spark):
    m = spark.createDataFrame([(u,) for u in ["1", "15", "42", "5", "50", "u-1"]], "uid string")
    keep = lambda lo, hi: sorted(r.uid for r in A.expire_by_lex(m, lo, hi).collect())
    assert keep("[1", "(5") == ["5", "50", "u-1"]
    assert keep("(1", "[5") == ["1", "50", "u-1"]
    assert keep("-", "+") == []
    assert keep("[u", "+") == ["1", "15", "42", "5", "50"]


def test_ttl_visibility_boundary(spark):
    # videoviews TTL 1800 s: last write + ttl == t -> gone, == t + 1 ms -> visible
    t = ms("2024-01-01 10:30:00")
    grid = TickGrid(t, t + 1, 3_600_000)
    gone = events(spark, [("pageview", t - 1_800_000, "a", "v")])
    seen = events(spark, [("pageview", t - 1_800_000 + 1, "a", "v")])
    assert K.visible_counters(gone, grid).count() == 0
    r = K.visible_counters(seen, grid).first()
    assert r.n == 1 and r.metric == "pageview"


def test_counter_counts_only_events_up_to_tick(spark):
    t = ms("2024-01-01 10:30:30")
    grid = TickGrid(t, t + 1, 3_600_000)
    ev = events(spark, [("click", t - 10, "a", "v"), ("click", t, "a", "v"), ("click", t + 10, "a", "v")])
    assert K.visible_counters(ev, grid).first().n == 2


def test_tick_grid(spark):
    g = TickGrid(1000, 2000, 300)        # ticks 1000 1300 1600 1900
    assert g.count == 4 and g.last_ms == 1900
    row = spark.range(1).select(
        g.first_at_or_after(F.lit(1001).cast("bigint")).alias("a"),
        g.first_at_or_after(F.lit(1950).cast("bigint")).alias("b"),
        g.ticks_in(F.lit(0).cast("bigint"), F.lit(1600).cast("bigint")).alias("c"),
        g.ticks_in(F.lit(None).cast("bigint"), F.lit(1600).cast("bigint")).alias("d"),
        g.ticks_in(F.lit(1700).cast("bigint"), F.lit(1800).cast("bigint")).alias("e")).first()
    assert row.a == 1300 and row.b is None and row.c == [1000, 1300] and row.d is None and row.e is None
    assert [r.tick_ms for r in g.frame(spark).collect()] == [1000, 1300, 1600, 1900]


def test_grid_for_days_equals_data_derived(spark):
    from viewtally.functions import time as tm
    from viewtally.sources import messages as M
    ev = M.read_table(spark, "/root/testdata/sf0.001", "events").select(tm.ntz_to_ms("ts").alias("ts_ms"))
    assert TickGrid.covering_days(ev, "ts_ms", 3_600_000, 1_800_000) == \
        TickGrid.for_days("2024-01-01", "2024-01-30", 3_600_000, 1_800_000)
