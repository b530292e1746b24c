"""Offsets from file footers, bounded reads of a laid-out log, variants."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from viewtally import jobs
from viewtally import schemas as S
from viewtally.functions import parse as P
from viewtally.operators import ledger as L
from viewtally.sinks import parquet as PS
from viewtally.sources import log as LG
from viewtally.sources import messages as M


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("log") / "log")
    msgs = M.messages(spark, SF001).select(*S.MESSAGE.fieldNames())
    LG.write_log(msgs.where("offset < 30"), root)
    LG.write_log(msgs.where("offset >= 30"), root)
    return root, msgs.cache()


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_latest_offsets_come_from_footers(spark, log):
    root, msgs = log
    with LG.footers(spark):
        plan = LG.offset_scan(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(offset)]" in plan and "PushedGroupBy: [topic, partition]" in plan
    before = {k: spark.conf.get(k, None) for k in (LG.V1_SOURCES, LG.PUSHDOWN)}
    assert rows(LG.latest_offsets(spark, root)) == rows(L.latest_offsets(msgs))
    assert {r.topic for r in LG.latest_offsets(spark, root, ["test-click"]).collect()} == {"test-click"}
    assert before == {k: spark.conf.get(k, None) for k in before}


def test_bounded_read_opens_the_planned_partitions(spark, log):
    root, msgs = log
    plan = [{"topic": "test-click", "part": 1, "from_off": 25, "until_off": 35},
            {"topic": "test-order", "part": 0, "from_off": 3, "until_off": 3}]
    got = LG.read_ranges(spark, root, plan)
    want = msgs.where("topic = 'test-click' and partition = 1 and offset >= 25 and offset < 35")
    assert rows(got) == rows(want) and got.count() == 10
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "GreaterThanOrEqual(offset,25)" in text
    assert {f.split("topic=")[1].split("/part-")[0] for f in got.inputFiles()} >= {"test-click/partition=1"}
    scan = [x for x in text.splitlines() if "FileScan" in x][0]
    assert "PartitionFilters: []" not in scan
    assert LG.read_ranges(spark, root, plan[1:]).count() == 0


def test_ingest_job_over_a_log(spark, log, tmp):
    root, msgs = log
    args = ["ingest", "--input", root, "--format", "log", "--prefix", "test", "--dense",
            "--ledger", os.path.join(tmp, "led"), "--out", os.path.join(tmp, "out")]
    assert jobs.main([*args, "--bootstrap"], spark).rows_written == msgs.count()
    assert jobs.main(args, spark).rows_written == 0


def test_batches_with_other_types_share_a_variant_column(spark, tmp):
    out = os.path.join(tmp, "logs")
    text = [["{}", '{"a": 1, "b": "x"}', '[1, 2]'], ['{"a": "one", "c": {"d": 2.5}}', "null"]]
    for k, batch in enumerate(text):
        df = spark.createDataFrame([("m", "2024-01-01 00:00:00", t, f"{k}{i}") for i, t in enumerate(batch)],
                                   "metric string, log_date string, data string, msg_id string")
        PS.write_logs(P.with_variant(df.withColumn("log_date", F.to_timestamp_ntz("log_date"))), out)
    back = PS.read_logs(spark, out)
    assert dict(back.dtypes)["payload"] == "variant"
    get = lambda path, kind: F.try_variant_get("payload", path, kind)
    got = {r.msg_id: tuple(r)[1:] for r in back.select("msg_id", get("$.a", "string").alias("a"), get("$.a", "int").alias("n"),
                                                       get("$.c.d", "double").alias("d")).collect()}
    assert got == {"00": (None, None, None), "01": ("1", 1, None), "02": (None, None, None),
                   "10": ("one", None, 2.5), "11": (None, None, None)}


def test_variant_store_job(spark, tmp):
    msgs = M.messages(spark, SF001, corrupt_every=10).select(*S.MESSAGE.fieldNames())
    src, out = os.path.join(tmp, "in"), os.path.join(tmp, "logs")
    msgs.coalesce(2).write.json(src)
    jobs.main(["store", "--variant", "--input", src, "--max-files-per-trigger", "5", "--once",
               "--checkpoint", os.path.join(tmp, "ck"), "--out", out], spark)
    back = spark.read.parquet(out)
    assert back.count() + spark.read.parquet(f"{out}_rejects").count() == msgs.count()
    assert back.where(F.variant_get("payload", "$.video", "string").isNull()).count() == 0
