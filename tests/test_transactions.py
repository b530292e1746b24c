"""Rows and ledger in one transaction, and the ledger as a commit log: crashes
before and inside the merge, racing runs, readers beside writers."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from viewtally import schemas as S
from viewtally.operators import ledger as L
from viewtally.plans import ingest as I
from viewtally.sinks import jdbc as JS
from viewtally.sinks.commit_log import CommitLog, Conflict
from viewtally.sources import jdbc as JR
from viewtally.sources import messages as M

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
LEDGER_TYPES = "topic VARCHAR(255)"


class Crash(RuntimeError):
    pass


@pytest.fixture(scope="module")
def msgs(spark):
    return M.messages(spark, SF001).select(*S.MESSAGE.fieldNames()).cache()


@pytest.fixture()
def url(spark, tmp, msgs):
    url = f"jdbc:derby:{os.path.join(tmp, 'db')};create=true"
    zero = L.bootstrap(spark.createDataFrame([], S.LEDGER), L.latest_offsets(msgs))
    JS.append(zero.withColumn("off", F.lit(0).cast("bigint")), url, "topic_offsets", DERBY, column_types=LEDGER_TYPES)
    return url


def store(spark, url, kind=I.StagedJdbc):
    return kind(spark, url, "log_event", "topic_offsets", DERBY)


def stored(spark, url):
    ids = [r.msg_id for r in JR.read_table(spark, url, "log_event", DERBY).select("msg_id").collect()]
    assert len(ids) == len(set(ids))
    return len(ids)


def offsets(spark, url):
    return {(r.topic, r.part): r.off for r in JR.read_ledger(spark, url, "topic_offsets", props=DERBY).collect()}


def test_rows_and_ledger_in_one_transaction(spark, url, msgs):
    s = store(spark, url)
    early = msgs.where(F.col("offset") < 20)
    assert I.run(spark, early, s, s.save).rows_written == early.count() == stored(spark, url)
    assert I.run(spark, msgs, s, s.save).rows_written == msgs.count() - early.count()
    assert stored(spark, url) == msgs.count()
    assert offsets(spark, url) == {(r.topic, r.part): r.until_off for r in L.latest_offsets(msgs).collect()}
    assert I.run(spark, msgs, s, s.save).rows_written == 0 and stored(spark, url) == msgs.count()
    assert JS.stages_of(spark, url, "log_event", DERBY) == {}


@pytest.mark.parametrize("inside", [False, True])
def test_a_crash_leaves_neither_rows_nor_offsets(spark, url, msgs, inside):
    class Crashing(I.StagedJdbc):
        def merge(self, con, stage):
            if inside:      # rows copied and offsets moved, not committed
                assert super().merge(con, stage) == msgs.count()
            raise Crash()

    s = store(spark, url, Crashing)
    with pytest.raises(Crash):
        I.run(spark, msgs, s, s.save)
    assert stored(spark, url) == 0 and set(offsets(spark, url).values()) == {0}
    s = store(spark, url)
    I.run(spark, msgs, s, s.save)
    assert stored(spark, url) == msgs.count()


def test_a_staging_table_left_behind_is_dropped(spark, url, msgs, monkeypatch):
    s = store(spark, url)
    with monkeypatch.context() as m:    # the driver dies: not even the staging table goes
        m.setattr(JS, "merge_staged", lambda *a: (_ for _ in ()).throw(Crash()))
        m.setattr(JS, "drop", lambda *a: None)
        with pytest.raises(Crash):
            I.run(spark, msgs, s, s.save)
    assert len(JS.stages_of(spark, url, "log_event", DERBY)) == 1
    s.keep_hours = -1
    I.run(spark, msgs, s, s.save)
    assert JS.stages_of(spark, url, "log_event", DERBY) == {} and stored(spark, url) == msgs.count()


def test_a_task_that_ran_twice_stores_its_rows_once(spark, url, msgs):
    class Twice(I.StagedJdbc):
        def save(self, rows, plan):
            super().save(rows.union(rows), plan)

    s = store(spark, url, Twice)
    I.run(spark, msgs, s, s.save)
    assert stored(spark, url) == msgs.count()


def test_two_runs_over_the_same_offsets(spark, url, msgs):
    errors, barrier = [], threading.Barrier(2)

    class Meeting(I.StagedJdbc):
        def save(self, rows, plan):
            super().save(rows, plan)
            barrier.wait(120)       # both have staged before either merges

    def job():
        s = store(spark, url, Meeting)
        try:
            I.run(spark, msgs, s, s.save)
        except Exception as e:
            errors.append(e)

    first = store(spark, url)
    I.run(spark, msgs.where("offset < 5"), first, first.save)
    jobs = [threading.Thread(target=job) for _ in range(2)]
    [j.start() for j in jobs]
    [j.join() for j in jobs]
    assert [type(e) for e in errors] == [I.LedgerConflict]
    assert stored(spark, url) == msgs.count()


def test_ledger_is_filtered_in_the_database(spark, url):
    plan = JR.read_ledger(spark, url, "topic_offsets", ["test-click", "test-order"], DERBY) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*In(topic, [test-click,test-order])]" in plan
    assert JR.read_ledger(spark, url, "topic_offsets", "test-click", DERBY).count() == 4


def test_missing_ledger_rows_need_bootstrap(spark, url, msgs):
    JS.execute(spark, url, "DELETE FROM topic_offsets", DERBY)
    s = store(spark, url)
    with pytest.raises(L.LedgerError, match="no ledger row"):
        I.run(spark, msgs, s, s.save)
    I.run(spark, msgs, s, s.save, bootstrap=True)
    assert stored(spark, url) == msgs.count() and len(offsets(spark, url)) == 12


def test_only_one_writer_publishes_a_version(spark, tmp):
    root, won, lost = os.path.join(tmp, "log"), [], []

    def writer(i):
        for version in range(1, 16):
            try:
                CommitLog(spark, root).publish(version, [{"by": i}] * 500)
                won.append(version)
            except Conflict:
                lost.append(version)

    def reader():
        while len(won) < 15:
            version, rows = CommitLog(spark, root).newest()
            assert len(rows) == (500 if version else 0) and len({r["by"] for r in rows}) <= 1
            read.append(version)

    read, errors = [], []

    def guarded(f, *a):
        try:
            f(*a)
        except Exception as e:
            errors.append(e)
            won.extend(range(99))

    threads = [threading.Thread(target=guarded, args=(writer, i)) for i in range(3)] + \
        [threading.Thread(target=guarded, args=(reader,))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and sorted(won) == list(range(1, 16)) and len(lost) == 30 and read == sorted(read)
    assert {n for n in os.listdir(root) if not n.startswith(".")} == {f"v{i}.json" for i in range(1, 16)}


def test_racing_commits_of_the_log_ledger(spark, tmp, msgs):
    root = os.path.join(tmp, "ledger")
    # a half-written draft of a crashed writer is no version
    os.makedirs(os.path.join(root, "log"))
    open(os.path.join(root, "log", "_draft-x"), "w").write('[{"topic":')
    a, b = I.LogLedger(spark, root), I.LogLedger(spark, root)
    rows = lambda *r: spark.createDataFrame(list(r), S.LEDGER)
    plan = lambda t, p, lo, known: [{"topic": t, "part": p, "from_off": lo, "in_ledger": known}]
    assert a.read().count() == 0
    a.write(rows(("x", 0, 5)), plan("x", 0, 0, False))
    with pytest.raises(I.LedgerConflict):      # both started without a row
        b.write(rows(("x", 0, 7)), plan("x", 0, 0, False))
    b.write(rows(("y", 0, 3)), plan("y", 0, 0, False))      # another partition: tries again and wins
    a.write(rows(("x", 0, 9)), plan("x", 0, 5, True))
    assert {tuple(r) for r in b.read().collect()} == {("x", 0, 9), ("y", 0, 3)}
    assert [tuple(r) for r in b.read(["y"]).collect()] == [("y", 0, 3)]


def test_two_ingestion_runs_on_the_log_ledger(spark, tmp, msgs):
    ledger, out = I.LogLedger(spark, os.path.join(tmp, "ledger")), os.path.join(tmp, "out")
    save = I.parquet_sink(out)

    def overtaken(rows, plan):
        save(rows, plan)
        if not ledger.read().count():       # the other run commits in between
            I.run(spark, msgs, ledger, save, bootstrap=True)

    with pytest.raises(I.LedgerConflict):
        I.run(spark, msgs.where("offset < 30"), ledger, overtaken, bootstrap=True)
    assert {(r.topic, r.part): r.off for r in ledger.read().collect()} == \
        {(r.topic, r.part): r.until_off for r in L.latest_offsets(msgs).collect()}


def test_a_folder_of_the_older_ledger_goes_on(spark, tmp, msgs):
    root = os.path.join(tmp, "ledger")
    I.ParquetLedger(spark, root).write(L.latest_offsets(msgs).select("topic", "part", F.col("until_off").alias("off")))
    ledger = I.LogLedger(spark, root)
    assert ledger.read().count() == 12
    assert I.run(spark, msgs, ledger, I.parquet_sink(os.path.join(tmp, "out"))).rows_written == 0
    assert ledger.read(["test-click"]).count() == 4
