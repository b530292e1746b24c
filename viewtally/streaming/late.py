"""Rows behind a stream's watermark, kept and counted after all (STR-7).

Spark drops a row whose window ended at or before the watermark, and only
counts it.  The key store would add it to its bucket.  Here a table's sink
looks the dropped rows up again and adds them:

* which watermark judged a batch is in the query's own write-ahead log (the
  one committed for the batch before), so a replay judges alike;
* which files the batch read is in its source log, so only those are opened
  again, and of them only row groups that reach behind the watermark;
* the rows found are kept as they came (``late_rows``), and the buckets they
  touch are recomputed: stored value and late rows together become the batch's
  version of those keys.  No other bucket is read.

The window of a late row is closed, so the stream never writes its key again
and nothing is counted twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtally import config as C
from viewtally.sinks import snapshot

#: how a late value joins the stored one
MERGE = {"n": F.sum, "last_ms": F.max}


def _lines(spark: SparkSession, path: str) -> list[str]:
    """Lines of a small log file, none if it is not there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode().splitlines()
    finally:
        stream.close()


def judging_watermark(spark: SparkSession, ckpt: str, batch_id: int) -> int:
    """Epoch ms of the watermark that rows of the batch were late against: the
    one of the batch before (0: none was late)."""
    lines = _lines(spark, f"{ckpt.rstrip('/')}/offsets/{batch_id - 1}")
    return json.loads(lines[1]).get("batchWatermarkMs", 0) if len(lines) > 1 else 0


def batch_files(spark: SparkSession, ckpt: str, batch_id: int) -> list[str]:
    """The files that a batch of a one-source file stream read: the entries of
    its source log between the offsets of the batch before and its own."""
    ckpt = ckpt.rstrip("/")

    def log_offset(batch: int) -> int:
        lines = _lines(spark, f"{ckpt}/offsets/{batch}")
        return json.loads(lines[2])["logOffset"] if len(lines) > 2 and lines[2] != "-" else -1

    files = []
    for k in range(log_offset(batch_id - 1) + 1, log_offset(batch_id) + 1):
        # a compacted log file holds the entries of earlier ones, too
        lines = _lines(spark, f"{ckpt}/sources/0/{k}") or _lines(spark, f"{ckpt}/sources/0/{k}.compact")
        files += [e["path"] for e in map(json.loads, lines[1:]) if e["batchId"] == k]
    return files


def bucket_start(width_ms: int, start_ms: int = 0) -> Column:
    ts = F.col("ts_ms")
    return ts - F.pmod(ts - F.lit(start_ms), F.lit(width_ms).cast("bigint"))


@dataclass
class LateRows:
    """What a table needs to take its late rows in.

    ``reread``: events (``metric, ts_ms, video, uid, ts``) of given files.
    ``cells``: the table's rows from events, as in the stream.  ``width_ms`` and
    ``start_ms``: its buckets."""
    reread: Callable[[list[str]], DataFrame]
    cells: Callable[[DataFrame], DataFrame]
    keys: list[str]
    width_ms: int = C.MINUTE_MS
    start_ms: int = 0

    def find(self, spark: SparkSession, ckpt: str, batch_id: int) -> DataFrame | None:
        """The events of the batch that Spark dropped (``cells`` picks those
        of the table)."""
        mark = judging_watermark(spark, ckpt, batch_id)
        files = batch_files(spark, ckpt, batch_id) if mark else []
        if not files:
            return None
        # the plain comparison reaches the scan, the window's end decides
        return self.reread(files).where((F.col("ts_ms") < mark)
                                        & (bucket_start(self.width_ms, self.start_ms) + self.width_ms <= mark))

    def repaired(self, spark: SparkSession, late: DataFrame, root: str, batch_id: int) -> DataFrame:
        """The touched keys with their late rows: the newest value stored by
        earlier batches, and the late cells."""
        cells = self.cells(late)
        span = cells.agg(F.min("bucket_ms").alias("lo"), F.max("bucket_ms").alias("hi"),
                         F.collect_set(snapshot.day_of_ms("bucket_ms")).alias("days")).first()
        if span["lo"] is None:
            return cells
        stored = snapshot.read(spark, root, sorted(span["days"]))
        if stored is None:
            return cells
        stored = stored.where((F.col("batch_id") < batch_id) & F.col("bucket_ms").between(span["lo"], span["hi"]))
        old = snapshot.newest(stored.join(cells.select(*self.keys), self.keys, "left_semi"), self.keys)
        values = [c for c in cells.columns if c not in self.keys]
        return (cells.unionByName(old.select(*cells.columns)).groupBy(*self.keys)
                .agg(*[MERGE[v](v).cast("bigint").alias(v) for v in values]).select(*cells.columns))


def late_root(out_root: str, name: str) -> str:
    return f"{out_root.rstrip('/')}/late/{name}"


def keep(late: DataFrame, out_root: str, name: str, batch_id: int) -> None:
    """The late events of a batch; a replay replaces them."""
    late.drop("ts").write.mode("overwrite").parquet(f"{late_root(out_root, name)}/batch_id={batch_id}")


def late_rows(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """All rows that came too late for the stream of a table: metric, ts_ms,
    video, uid and the batch they came in."""
    schema = "metric string, ts_ms bigint, video string, uid string, batch_id int"
    root = late_root(out_root, name)
    return spark.read.schema(schema).parquet(root) if snapshot.exists(spark, root) else spark.createDataFrame([], schema)
