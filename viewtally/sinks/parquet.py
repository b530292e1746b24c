"""Day-partitioned Parquet log store (SNK-1, SNK-5, FLT-1, FLT-5).

One directory level per metric and per day replaces the database's insert
trigger and child tables: a filter on ``log_day`` prunes directories
(``PartitionFilters`` in the scan), like the day check constraints did.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_PATTERN = "yyyy_MM_dd"


def with_log_day(rows: DataFrame, col: str = "log_date") -> DataFrame:
    """SNK-5: the day partition of each row (UTC wall clock of ``log_date``)."""
    return rows.withColumn("log_day", F.date_format(F.col(col), DAY_PATTERN))


def write_logs(rows: DataFrame, path: str, files: int | None = None,
               mode: str = "append", max_records_per_file: int = 5_000_000) -> None:
    """Write log rows under ``path/metric=<m>/log_day=<d>``.

    ``files`` caps the files of a small micro-batch (the original wrote 2 per
    batch).  A backfill leaves it unset: the rows are rebalanced on
    (metric, day) by AQE — a hot day is split over several tasks, thin ones
    are merged — so each day gets a few well-sized files instead of one per
    scan task, and ``maxRecordsPerFile`` bounds file size.
    """
    df = with_log_day(rows) if "log_day" not in rows.columns else rows
    # ``files`` after a shuffle: a coalesce would read the batch in so few tasks
    df = df.repartition(files) if files else df.hint("rebalance", "metric", "log_day")
    (df.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
     .partitionBy("metric", "log_day").parquet(path))


def write_batch(rows: DataFrame, root: str, batch_id: int, files: int | None = None,
                skip_empty: bool = True, run: str = "batch") -> bool:
    """One micro-batch to ``root/run=<run>/batch_id=<n>/…`` in overwrite mode, so a
    replayed batch replaces its own output instead of adding to it.  ``run``
    is the stream's id: batch numbers start at 0 again with a new checkpoint,
    and must not replace what an earlier one stored.  Empty
    batches write nothing (FLT-1).  Returns whether anything was written.

    Streams pass ``skip_empty=False``: Spark does not run a stateless
    micro-batch without data, and a second action on the batch would count
    its rows twice in observed metrics."""
    if skip_empty and rows.isEmpty():
        return False
    write_logs(rows, f"{root.rstrip('/')}/run={run}/batch_id={batch_id}", files=files, mode="overwrite")
    return True


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def write_rejects(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Rejected messages: reason, coordinates, key and raw value (an empty
    folder when there are none)."""
    rows.write.mode(mode).parquet(path)


def outside_day() -> Column:
    """Whether ``log_date`` lies outside its ``log_day``; NULL dates do."""
    return ~F.date_format("log_date", DAY_PATTERN).eqNullSafe(F.col("log_day"))


def day_range_violations(logs: DataFrame) -> DataFrame:
    """FLT-5: rows whose ``log_date`` lies outside ``[day, day + 1)`` of their
    partition (empty when the store is consistent)."""
    return logs.where(outside_day())
