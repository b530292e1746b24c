"""Size-checked broadcasting.

A side is broadcast only when an upper bound of its row count is known
before the query runs (e.g. one row per minute of a known time span, one row
per Kafka partition).  Beyond the bound the plain join stays, and AQE may
still pick a broadcast at run time from the measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtally import config as C


def broadcast_if_bounded(df: DataFrame, max_rows: int, limit: int = C.BROADCAST_ROW_LIMIT) -> DataFrame:
    """``broadcast(df)`` if ``max_rows`` (a proven upper bound) is within ``limit``."""
    return F.broadcast(df) if 0 <= max_rows <= limit else df


def checkpoint_dir(spark) -> str:
    """The shared lineage-cut folder the cluster names in ``spark.checkpoint.dir``.

    Set by the deployment; tests set their own before calling this.
    """
    try:
        d = spark.sparkContext.getCheckpointDir()
    except Exception:
        d = None
    d = d or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set")
    return d


def spread_if_narrow(df: DataFrame) -> DataFrame:
    """Round-robin a scan over the cluster's cores when it has fewer
    partitions than cores (a single unsplittable file), so per-row work such
    as JSON parsing runs in parallel.  A scan of many files already has more
    splits than cores and is returned untouched: no extra shuffle at scale."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        narrow = df.rdd.getNumPartitions() < cores
    except Exception:   # no RDD view of the plan (e.g. a Spark Connect session)
        return df
    return df.repartition(cores) if narrow else df


def share(df: DataFrame) -> DataFrame:
    """Materialise an intermediate that several branches of one plan read.

    Branches that prune different columns defeat exchange reuse and would
    each recompute the input; this computes it once.  With the cluster's
    ``spark.checkpoint.dir`` set it is a reliable checkpoint (written to the
    shared folder, lineage cut: survives executor loss); without it, a
    memory-and-disk cache (recomputed from lineage if an executor is lost).
    """
    from pyspark import StorageLevel
    try:
        has_dir = bool(df.sparkSession.sparkContext.getCheckpointDir())
    except Exception:   # no SparkContext handle (e.g. a Spark Connect session)
        has_dir = False
    if has_dir:
        # cached first: the checkpoint write then reads the cache instead of
        # computing the input a second time; the cache is dropped afterwards
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return df.checkpoint(eager=True)
        finally:
            df.unpersist()
    return df.persist(StorageLevel.MEMORY_AND_DISK)
