"""Reads by key on snapshot tables (SNK-8).

A batch's rows are clustered by key: each file holds one range of keys, sorted,
with a Bloom filter for the key's column.  An index beside the table names the
key range of every file, so a reader of one key opens only the files whose range
holds it, and of those only row groups that Parquet's statistics and Bloom
filters don't rule out.  The index has one folder per table folder; ``compact``
writes that of the merged folder and drops those of the folders it removes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtally.sinks import snapshot

INDEX = "path string, lo string, hi string, n bigint, day string, batch_id int"


def _index_root(root: str) -> str:
    return f"{root.rstrip('/')}/_keys"


def _clustered(df: DataFrame, key: str, files: int) -> DataFrame:
    # one task per key range; a key that is too common for one file spills into more rows, not more keys
    return df.repartitionByRange(files, key).sortWithinPartitions(key)


def write(df: DataFrame, root: str, batch_id: int, key: str, day_of: str, files: int = 4) -> None:
    """Write one batch clustered by ``key`` (text) and index its files.  A replay
    replaces both."""
    spark, root = df.sparkSession, root.rstrip("/")
    rows = _clustered(df.withColumn("day", snapshot.day_of_ms(day_of)).withColumn("batch_id", F.lit(batch_id)), key, files)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option(f"parquet.bloom.filter.enabled#{key}", "true").partitionBy("day", "batch_id").parquet(root))
    days = [d for d, ids in snapshot.day_batches(spark, root).items() if batch_id in ids]
    index(spark, root, key, [(d, batch_id) for d in days])


def index(spark: SparkSession, root: str, key: str, folders: list[tuple[str, int]]) -> None:
    """(Re)write the index of table folders (``day=<d>``, batch)."""
    paths = [f"{root}/{day}/batch_id={b}" for day, b in folders]
    if not paths:
        return
    found = (spark.read.option("basePath", root).parquet(*paths)
             .select("day", "batch_id", F.col(key).cast("string").alias("k"), F.col("_metadata.file_path").alias("path"))
             .groupBy("path", "day", "batch_id").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count(F.lit(1)).alias("n")))
    (found.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day", "batch_id").parquet(_index_root(root)))


def files_of(spark: SparkSession, root: str, value: str, days: list[str] | None = None) -> list[str]:
    """Files whose key range holds ``value``."""
    at = _index_root(root)
    if not snapshot.exists(spark, at):
        return []
    rows = spark.read.schema(INDEX).parquet(at).where((F.col("lo") <= value) & (F.col("hi") >= value))
    rows = rows.where(F.col("day").isin(*days)) if days else rows
    return sorted(r["path"] for r in rows.select("path").collect())     # one path for each file at most


def lookup(spark: SparkSession, root: str, key: str, value: str, keys: list[str], schema: str,
           days: list[str] | None = None) -> DataFrame:
    """The newest rows of one key (``keys``: what tells rows of the table
    apart), from its files alone."""
    paths = files_of(spark, root, value, days)
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, day string, batch_id int").option("basePath", root.rstrip("/")).parquet(*paths)
    return snapshot.newest(rows.where(F.col(key) == value), keys)


def compact(spark: SparkSession, root: str, keys: list[str], key: str, upto: int, every: int, files: int = 4) -> None:
    """``snapshot.compact`` that keeps the clustering and the index."""
    root = root.rstrip("/")

    def layout(merged: DataFrame) -> DataFrame:
        return _clustered(merged, key, files)

    removed, merged = snapshot.compact(spark, root, keys, upto, every, layout, {f"parquet.bloom.filter.enabled#{key}": "true"})
    for day, b in removed:
        snapshot.remove(spark, f"{_index_root(root)}/{day}/batch_id={b}")
    for folder in merged:
        index(spark, root, key, [folder])
