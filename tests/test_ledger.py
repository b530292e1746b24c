import pytest

from viewtally import schemas as S
from viewtally.operators import ledger as L
from viewtally.operators.numbering import dense_numbers


def led(spark, rows):
    return spark.createDataFrame(rows, S.LEDGER)


def latest(spark, rows):
    return spark.createDataFrame(rows, "topic string, part int, until_off bigint")


def test_plan_range(spark):
    plan = L.offset_plan(latest(spark, [("t", 0, 250)]), led(spark, [("t", 0, 100)]))
    r = L.check_plan(plan)[0]
    assert (r.from_off, r.until_off, r.in_ledger) == (100, 250, True)


def test_missing_ledger_row(spark):
    plan = L.offset_plan(latest(spark, [("t", 0, 250), ("t", 1, 9)]), led(spark, [("t", 0, 100)]))
    rows = {r.part: r for r in plan.collect()}
    assert rows[1].from_off == 0 and not rows[1].in_ledger
    with pytest.raises(L.LedgerError):
        L.check_plan(plan)
    assert len(L.check_plan(plan, bootstrap=True)) == 2


def test_unknown_latest_and_backwards(spark):
    with pytest.raises(L.LedgerError, match="unknown"):
        L.check_plan(L.offset_plan(latest(spark, [("t", 0, -1)]), led(spark, [("t", 0, 0)])))
    with pytest.raises(L.LedgerError, match="backwards"):
        L.check_plan(L.offset_plan(latest(spark, [("t", 0, 5)]), led(spark, [("t", 0, 9)])))


def test_select_range_half_open(spark):
    msgs = spark.createDataFrame([("k", "v", "t", 0, o) for o in range(10)], S.MESSAGE)
    plan = L.offset_plan(latest(spark, [("t", 0, 7)]), led(spark, [("t", 0, 3)]))
    assert sorted(r.offset for r in L.select_range(msgs, plan).collect()) == [3, 4, 5, 6]


def test_bootstrap_and_commit(spark):
    old = led(spark, [("t", 0, 5)])
    parts = latest(spark, [("t", 0, 8), ("t", 1, 4)])
    boot = L.bootstrap(old, parts)
    assert sorted(tuple(r) for r in boot.collect()) == [("t", 0, 5), ("t", 1, 0)]
    plan = L.offset_plan(parts, old)
    assert sorted(tuple(r) for r in L.commit(boot, plan).collect()) == [("t", 0, 8), ("t", 1, 4)]
    with pytest.raises(Exception):
        L.commit(old, plan).collect()        # UPDATE without a row
    twice = led(spark, [("t", 0, 5), ("t", 0, 6), ("t", 1, 0)])
    with pytest.raises(Exception, match="duplicate"):
        L.commit(twice, plan).collect()      # UPDATE touching two rows


def test_dense_numbers_small_blocks(spark):
    import random
    rnd = random.Random(7)
    rows = [(rnd.choice("ab"), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, k long")
    got = {(r.g, r.k): r.offset for r in dense_numbers(df, ["g"], "k", block=16).collect()}
    want, seen = {}, {"a": 0, "b": 0}
    for g, k in rows:
        want[(g, k)] = seen[g]
        seen[g] += 1
    assert got == want
