"""Keyed snapshot tables written per micro-batch (SNK-8, SET-3).

Stand-in for the key store: every batch writes the rows it changed under
``root/day=<d>/batch_id=<n>`` and a reader takes, per key, the row of the
newest batch.  Overwriting a (day, batch) directory makes a replayed batch
idempotent; the day level lets a reader of a bounded horizon open only the
days it needs, so its work does not grow with the stream's history.

Batch numbers order the rows, so a table belongs to one stream (``claim``).
``compact`` merges the folders of finished batches: each row is rewritten once,
and a day holds one folder per ``every`` batches and the newest ones.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtally.functions import time as tm

#: rows of one file that ``compact`` writes
COMPACT_ROWS = 5_000_000


def _day(ms) -> F.Column:
    return F.date_format(tm.ms_to_ntz(ms), "yyyy-MM-dd")


def day_of_ms(col: str) -> F.Column:
    """The day partition of an epoch-ms column."""
    return _day(F.col(col))


def write(df: DataFrame, root: str, batch_id: int, day_of: str | None = None,
          files: int | None = None) -> None:
    """Write one batch; ``day_of`` names the epoch-ms column that picks the
    day partition (all rows go to one ``day=all`` partition without it).
    ``files``: at most so many files a day, written by as many tasks."""
    day = _day(F.col(day_of)) if day_of else F.lit("all")
    df = df.repartition(files) if files else df
    (df.withColumn("day", day).withColumn("batch_id", F.lit(batch_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day", "batch_id").parquet(root))


def days_between(lo_ms: int, hi_ms: int) -> list[str]:
    d = datetime.fromtimestamp(lo_ms / 1000, tz=timezone.utc).date()
    end = datetime.fromtimestamp(hi_ms / 1000, tz=timezone.utc).date()
    out = []
    while d <= end:
        out.append(d.isoformat())
        d += timedelta(days=1)
    return out


def _fs(spark: SparkSession, path: str):
    """Hadoop's FileSystem (local disk or cluster storage) and the path in it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, ascending; none if it is not there."""
    fs, p = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def _make(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, replacing an older one."""
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def claim(spark: SparkSession, root: str, owner: str) -> None:
    """Mark the table as the stream's own.  Another stream (a new checkpoint
    counts its batches from 0 again, so older rows would win) is refused."""
    owners = names(spark, f"{root}/_owner")
    if not owners:
        _make(spark, f"{root}/_owner/{owner}")
        owners = names(spark, f"{root}/_owner")
    if owners != [owner]:
        raise RuntimeError(f"{root} belongs to stream {owners}: keep its checkpoint or write to another folder")


def day_batches(spark: SparkSession, root: str) -> dict[str, list[int]]:
    """Batch numbers of the folders of each day."""
    return {day: sorted(int(n.split("=")[1]) for n in names(spark, f"{root}/{day}") if n.startswith("batch_id="))
            for day in names(spark, root) if day.startswith("day=")}


def compact(spark: SparkSession, root: str, keys: list[str], upto: int, every: int, layout=None,
            options: dict | None = None) -> tuple[list[tuple[str, int]], list[tuple[str, int]]]:
    """Merge the folders of batches ``(upto - every, upto]`` of each day into
    that of the newest.  ``upto`` must be committed: no replay writes its
    folder again.

    Merged rows are added to the newest folder, and the merged folders go one
    compaction later, when no reader can still have them open.  Until then, and
    if a crash repeats a merge, rows are there twice under numbers that read the same.

    ``layout`` places the merged rows (by size without it), ``options`` go to
    their writer.  Returns the (day, batch) folders removed and those merged into.
    """
    removed, into = [], []
    days = day_batches(spark, root)
    for mark in names(spark, f"{root}/_merged"):
        lo, hi = map(int, mark.split("-"))
        if hi >= upto:
            continue
        for day, ids in days.items():
            for i in [i for i in ids if lo <= i <= hi][:-1]:
                remove(spark, f"{root}/{day}/batch_id={i}")
                removed.append((day, i))
        remove(spark, f"{root}/_merged/{mark}")
    lo = upto - every + 1
    for day, ids in days.items():
        paths = [f"{root}/{day}/batch_id={i}" for i in ids if lo <= i <= upto]
        if len(paths) < 2:
            continue
        # computed before the folder it reads grows
        merged = newest(spark.read.option("basePath", root).parquet(*paths), keys).checkpoint()
        merged = layout(merged) if layout else merged.coalesce(1 + merged.count() // COMPACT_ROWS)
        merged.write.mode("append").options(**(options or {})).parquet(paths[-1])
        into.append((day, max(i for i in ids if lo <= i <= upto)))
    _make(spark, f"{root}/_merged/{lo}-{upto}")
    return removed, into


def remember(spark: SparkSession, path: str, batch_id: int, value) -> int | None:
    """``value(previous)`` of a batch, computed once: a replayed batch gets the
    stored one.  ``previous`` is that of the batch before (None: there is none)."""
    seen = {int(n.split(".")[0]): int(n.split(".")[1]) for n in names(spark, path)}
    if batch_id in seen:
        return seen[batch_id]
    earlier = [b for b in seen if b < batch_id]
    got = value(seen[max(earlier)] if earlier else None)
    if got is not None:
        _make(spark, f"{path}/{batch_id}.{got}")
        for b in sorted(earlier)[:-1]:      # the two newest are enough for a replay
            remove(spark, f"{path}/{b}.{seen[b]}")
    return got


def read(spark: SparkSession, root: str, days: list[str] | None = None) -> DataFrame | None:
    """All stored rows (with ``day`` and ``batch_id``), or only those of ``days``."""
    root = root.rstrip("/")
    cands = [root] if days is None else [f"{root}/day={d}" for d in days]
    paths = [p for p in cands if exists(spark, p)]
    if not paths:
        return None
    return spark.read.option("basePath", root).parquet(*paths)


def newest(df: DataFrame, keys: list[str]) -> DataFrame:
    """Newest value per key over all batches (``max_by`` on ``batch_id``)."""
    values = [c for c in df.columns if c not in keys and c not in ("batch_id", "day")]
    agg = F.max_by(F.struct(*values), F.col("batch_id")).alias("__v")
    return df.groupBy(*keys).agg(agg).select(*keys, *[F.col(f"__v.{v}").alias(v) for v in values])


def latest(spark: SparkSession, root: str, keys: list[str],
           days: list[str] | None = None, where=None) -> DataFrame | None:
    """Newest value per key; ``where`` (on key columns, e.g. a bucket range)
    is applied before the aggregation so it reaches the Parquet scan and
    skips the files of batches that only touched older buckets."""
    df = read(spark, root, days)
    if df is None:
        return None
    return newest(df.where(where) if where is not None else df, keys)
