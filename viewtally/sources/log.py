"""A message log laid out by topic and partition (SRC-3, SRC-4, AGG-11).

``<root>/topic=<t>/partition=<p>/`` holds the messages of a topic partition as
Parquet, sorted by offset.  Its newest offsets are in the file footers, so
looking them up reads no row: the DataSource V2 scan answers ``max(offset)`` by
partition from footer statistics.  A bounded read opens only the partitions of
its plan, and of their files only row groups that meet the ranges.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtally import schemas as S

V1_SOURCES = "spark.sql.sources.useV1SourceList"
PUSHDOWN = "spark.sql.parquet.aggregatePushdown"
LAYOUT = "key string, value string, offset bigint, topic string, partition int"


def write_log(msgs: DataFrame, root: str, mode: str = "append") -> None:
    """Append messages; a file holds an ascending range of offsets of one topic
    partition, so footers and row groups tell ranges apart."""
    (msgs.select(*S.MESSAGE.fieldNames()).hint("rebalance", "topic", "partition")
     .sortWithinPartitions("topic", "partition", "offset")
     .write.mode(mode).partitionBy("topic", "partition").parquet(root))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def footers(spark: SparkSession) -> Iterator[None]:
    """Parquet through DataSource V2 with aggregates pushed to the footers, for
    what is read and run inside."""
    v1 = [x for x in spark.conf.get(V1_SOURCES).split(",") if x.strip() and x.strip() != "parquet"]
    with _settings(spark, {V1_SOURCES: ",".join(v1), PUSHDOWN: "true"}):
        yield


def offset_scan(spark: SparkSession, root: str) -> DataFrame:
    """Next offset per topic partition; to be run inside ``footers``."""
    log = spark.read.schema(LAYOUT).parquet(root)
    return (log.groupBy("topic", F.col("partition").alias("part"))
            .agg(F.max("offset").alias("last"))
            .select("topic", "part", (F.col("last") + 1).cast("bigint").alias("until_off")))


def latest_offsets(spark: SparkSession, root: str, topics: list[str] | None = None) -> DataFrame:
    """SRC-4: ``topic, part, until_off`` from the footers alone; one row per
    topic partition."""
    with footers(spark):
        found = [r for r in offset_scan(spark, root).collect() if not topics or r["topic"] in topics]
    return spark.createDataFrame(found, "topic string, part int, until_off bigint")


def read_ranges(spark: SparkSession, root: str, plan: list) -> DataFrame:
    """SRC-3: the messages of the planned ranges (rows topic, part, from_off,
    until_off).  The topic partitions are directory filters, the offsets reach
    the scan."""
    log = spark.read.schema(LAYOUT).parquet(root)
    parts = [(F.col("topic") == r["topic"]) & (F.col("partition") == r["part"])
             & (F.col("offset") >= r["from_off"]) & (F.col("offset") < r["until_off"])
             for r in plan if r["until_off"] > r["from_off"]]
    if not parts:
        return log.limit(0).select(*S.MESSAGE.fieldNames())
    return log.where(reduce(lambda a, b: a | b, parts)).select(*S.MESSAGE.fieldNames())
