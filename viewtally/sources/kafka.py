"""Kafka sources (SRC-1..4).

The Kafka connector is not on this machine's classpath; these builders are
unit-tested for the options they produce and run unchanged where the
connector is installed.  Tests drive the same downstream code with
Kafka-shaped DataFrames (``viewtally.sources.messages``).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtally import config as C
from viewtally.functions.parse import topics_for

def message_columns() -> list:
    return [F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            F.col("topic"), F.col("partition"), F.col("offset")]


def stream_options(brokers: str, prefix: str, metrics=C.METRICS, starting: str = "latest",
                   min_partitions: int | None = None, max_offsets_per_trigger: int | None = None,
                   extra: dict | None = None) -> dict:
    """SRC-1 / SRC-2: one subscription to the three topics of a prefix."""
    opts = {"kafka.bootstrap.servers": brokers,
            "subscribe": ",".join(topics_for(prefix, metrics)),
            "startingOffsets": starting,
            "failOnDataLoss": "true"}
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)   # split skewed partitions
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update(extra or {})
    return opts


def read_stream(spark: SparkSession, brokers: str, prefix: str, **kw) -> DataFrame:
    """Streaming messages ``key, value, topic, partition, offset``."""
    return (spark.readStream.format("kafka").options(**stream_options(brokers, prefix, **kw))
            .load().select(*message_columns()))


def range_options(plan_rows) -> dict:
    """SRC-3: ``startingOffsets`` / ``endingOffsets`` for half-open ranges
    ``[from_off, until_off)`` given as plan rows (topic, part, from_off, until_off)."""
    start: dict = {}
    end: dict = {}
    for r in plan_rows:
        start.setdefault(r["topic"], {})[str(r["part"])] = int(r["from_off"])
        end.setdefault(r["topic"], {})[str(r["part"])] = int(r["until_off"])
    return {"startingOffsets": json.dumps(start, sort_keys=True),
            "endingOffsets": json.dumps(end, sort_keys=True)}


def read_ranges(spark: SparkSession, brokers: str, plan_rows, extra: dict | None = None) -> DataFrame:
    """SRC-3: bounded batch read of the planned ranges."""
    topics = sorted({r["topic"] for r in plan_rows})
    opts = {"kafka.bootstrap.servers": brokers, "subscribe": ",".join(topics),
            **range_options(plan_rows), **(extra or {})}
    return spark.read.format("kafka").options(**opts).load().select(*message_columns())


def read_latest(spark: SparkSession, brokers: str, topics: list[str]) -> DataFrame:
    """SRC-4: next offset per partition, ``topic, part, until_off``.  Reads the
    whole retained topic through the connector; with a real broker prefer the
    admin API (the connector plans the same offsets without reading data)."""
    df = (spark.read.format("kafka")
          .options(**{"kafka.bootstrap.servers": brokers, "subscribe": ",".join(topics),
                      "startingOffsets": "earliest", "endingOffsets": "latest"})
          .load())
    return (df.groupBy("topic", F.col("partition").alias("part"))
            .agg((F.max("offset") + 1).alias("until_off")))
