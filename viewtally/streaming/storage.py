"""Raw-log storage streams (SNK-1, SNK-2, SNK-4, STR-1, STR-8, FLT-1).

One query over all three topics (the metric comes from the topic name);
each micro-batch goes to day-partitioned Parquet under its stream's and its own
directory (overwrite: replay-safe) or is appended over JDBC with an anti-join
on the message id.  Messages that can't be stored go to a reject table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from viewtally.functions import parse as P
from viewtally.sinks import jdbc as JS
from viewtally.sinks import parquet as PS
from viewtally.sources.json import EMPTY_SCHEMA, infer_schema, json_object

BATCH_ROWS = "batch_rows"


def log_stream(msgs: DataFrame, strict: bool = False) -> DataFrame:
    """Checked log rows with the per-batch row counts as an observed metric
    (SNK-4), read from ``query.lastProgress['observedMetrics']``: no extra pass."""
    rows = P.checked_log_rows(msgs, strict)
    return rows.observe(BATCH_ROWS, F.count(F.lit(1)).alias("rows"),
                        F.count("reject_reason").alias("rejected"))


def _run_of(batch: DataFrame) -> str:
    """The stream's id, which its checkpoint keeps."""
    run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not run:
        raise RuntimeError("no sql.streaming.queryId: not inside a stream's batch")
    return run


def _split(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = batch.where(F.col("reject_reason").isNull()).drop("reject_reason", "key")
    bad = batch.where(F.col("reject_reason").isNotNull()).select(
        F.col("reject_reason").alias("reason"), "topic", "partition", "offset", "key", F.col("data").alias("value"))
    return good, bad


def start_typed_parquet(msgs: DataFrame, root: str, ckpt: str, trigger: dict | None = None,
                        files: int | None = None, rejects: str | None = None, strict: bool = False,
                        discovered: str | None = None) -> StreamingQuery:
    """SNK-1 with the JSON fields as columns.  Known topics have one fixed
    schema, so every batch's files agree.  Messages of other topics get the
    schema found in their batch (SRC-7) and go to ``discovered`` (default
    ``<root>_discovered``); read that with ``mergeSchema``."""
    rejects = rejects or f"{root.rstrip('/')}_rejects"
    discovered = discovered or f"{root.rstrip('/')}_discovered"

    def sink(batch: DataFrame, batch_id: int) -> None:
        at = f"run={_run_of(batch)}/batch_id={batch_id}"
        batch = batch.persist()
        try:
            reason = F.col("reject_reason")
            good = batch.where(reason.isNull()).drop("reject_reason", "key", "value")
            PS.write_logs(good, f"{root.rstrip('/')}/{at}", files, mode="overwrite")
            # without a schema of its own, but with a metric, a date and valid JSON
            other = (reason == "unknown metric") & (F.col("metric") != "") & json_object("value")
            unknown = batch.where(other)
            schema = infer_schema(unknown)
            if schema != EMPTY_SCHEMA:
                rows = unknown.select("metric", "log_date", "msg_id", "topic", "partition", "offset",
                                      F.from_json("value", schema).alias("payload"))
                PS.write_logs(rows, f"{discovered.rstrip('/')}/{at}", files, mode="overwrite")
            bad = batch.where(reason.isNotNull() & ~other).select(
                reason.alias("reason"), "topic", "partition", "offset", "key", "value")
            PS.write_rejects(bad, f"{rejects}/{at}", "overwrite")
        finally:
            batch.unpersist()

    # strict raises on unknown topics too, as there is no fixed schema for them
    rows = P.typed_log_rows(msgs, strict).observe(
        BATCH_ROWS, F.count(F.lit(1)).alias("rows"), F.count("reject_reason").alias("rejected"))
    return (rows.writeStream.queryName("log_typed_parquet")
            .option("checkpointLocation", ckpt)
            .trigger(**(trigger or {"processingTime": "60 minutes"}))
            .foreachBatch(sink).start())


def start_parquet(msgs: DataFrame, root: str, ckpt: str, trigger: dict | None = None,
                  files: int | None = None, rejects: str | None = None, strict: bool = False,
                  variant: bool = False) -> StreamingQuery:
    """Good rows under ``root``, rejected ones under ``rejects`` (default ``<root>_rejects``).
    ``variant``: the JSON as a ``payload`` column of type variant instead of text;
    one schema for all topics and batches, whatever the fields' types."""
    rejects = rejects or f"{root.rstrip('/')}_rejects"

    def sink(batch: DataFrame, batch_id: int) -> None:
        run = _run_of(batch)
        batch = batch.persist()
        try:
            good, bad = _split(batch)
            good = P.with_variant(good) if variant else good
            PS.write_batch(good, root, batch_id, files, skip_empty=False, run=run)
            PS.write_rejects(bad, f"{rejects}/run={run}/batch_id={batch_id}", "overwrite")
        finally:
            batch.unpersist()

    return (log_stream(msgs, strict).writeStream.queryName("log_parquet")
            .option("checkpointLocation", ckpt)
            .trigger(**(trigger or {"processingTime": "60 minutes"}))
            .foreachBatch(sink).start())


def start_jdbc(msgs: DataFrame, url: str, table: str, ckpt: str, props: dict | None = None,
               trigger: dict | None = None, rejects: str | None = None, strict: bool = False) -> StreamingQuery:
    """Good rows to the table, the same columns as ingestion writes; rejected
    ones as Parquet under ``rejects`` (default ``<ckpt>_rejects``)."""
    rejects = rejects or f"{ckpt.rstrip('/')}_rejects"

    def sink(batch: DataFrame, batch_id: int) -> None:
        # cached: the range lookup and the writes then run the batch once
        batch = batch.persist()
        try:
            good, bad = _split(batch)
            PS.write_rejects(bad, f"{rejects}/run={_run_of(batch)}/batch_id={batch_id}", "overwrite")
            ranges = good.groupBy("topic", "partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).collect()
            if not ranges:      # empty batch (FLT-1)
                return
            # one row per topic partition: only this batch's offsets can collide
            stored = [(F.col("topic") == r["topic"]) & (F.col("partition") == r["partition"])
                      & F.col("offset").between(r["lo"], r["hi"]) for r in ranges]
            JS.append_new(batch.sparkSession, good, url, table, props=props,
                          stored_filter=reduce(lambda a, b: a | b, stored), column_types=JS.LOG_COLUMN_TYPES)
        finally:
            batch.unpersist()

    return (log_stream(msgs, strict).writeStream.queryName("log_jdbc")
            .option("checkpointLocation", ckpt)
            .trigger(**(trigger or {"processingTime": "60 seconds"}))
            .foreachBatch(sink).start())
