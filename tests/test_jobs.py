"""Command-line jobs driven in-process with file sources."""

import os

from conftest import SF001
from viewtally import jobs
from viewtally.sources import messages as M


def test_backfill_and_ingest_jobs(spark, tmp):
    msgs = M.messages(spark, SF001)
    table = os.path.join(tmp, "msgs.parquet")
    msgs.drop("event_id").write.parquet(table)
    paths = jobs.main(["backfill", "--input", table, "--out", os.path.join(tmp, "bf"), "--top-k", "3"], spark)
    assert spark.read.parquet(paths["topvideos_top"]).count() > 0

    args = ["ingest", "--input", table, "--prefix", "test", "--ledger", os.path.join(tmp, "led"),
            "--out", os.path.join(tmp, "logs")]
    r1 = jobs.main(args + ["--bootstrap"], spark)
    assert r1.rows_written == msgs.count()
    r2 = jobs.main(args, spark)
    assert r2.rows_written == 0


def test_store_job_once(spark, tmp):
    msgs = M.messages(spark, SF001)
    src = os.path.join(tmp, "in")
    msgs.drop("event_id").coalesce(2).write.json(src)
    out = os.path.join(tmp, "logs")
    jobs.main(["store", "--input", src, "--max-files-per-trigger", "5", "--once",
               "--checkpoint", os.path.join(tmp, "ck"), "--out", out], spark)
    assert spark.read.parquet(out).count() == msgs.count()


def test_parser_covers_all_jobs():
    p = jobs.parser()
    for job in jobs.JOBS:
        assert p.parse_args([job] + {"metrics": ["--checkpoint", "c", "--out", "o"],
                                     "store": ["--checkpoint", "c"],
                                     "ingest": [],
                                     "backfill": ["--input", "i", "--out", "o"]}[job]).job == job


def test_ingest_reads_the_planned_ranges_of_the_broker(spark, tmp, monkeypatch):
    """Without a broker here: its readers are stand-ins, the job is real."""
    from pyspark.sql import functions as F
    from viewtally import schemas as S
    from viewtally.operators import ledger as L
    from viewtally.sources import kafka as KF
    msgs = M.messages(spark, SF001).select(*S.MESSAGE.fieldNames())
    asked = []

    def ranges(spark_, brokers, plan):
        asked.append(KF.range_options(plan))
        return L.select_range(upto, spark.createDataFrame(plan))

    monkeypatch.setattr(KF, "read_latest", lambda spark_, brokers, topics: L.latest_offsets(upto.where(F.col("topic").isin(*topics))))
    monkeypatch.setattr(KF, "read_ranges", ranges)
    args = ["ingest", "--brokers", "b:1", "--prefix", "test", "--ledger", os.path.join(tmp, "led"), "--out", os.path.join(tmp, "logs")]
    upto = msgs.where("offset < 40")
    assert jobs.main([*args, "--bootstrap"], spark).rows_written == upto.count()
    before, upto = upto.count(), msgs
    assert jobs.main(args, spark).rows_written == msgs.count() - before
    assert '"0": 40' in asked[1]["startingOffsets"] and spark.read.parquet(os.path.join(tmp, "logs")).count() == msgs.count()
