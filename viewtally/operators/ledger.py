"""Offset ledger and bounded reads (SRC-4, AGG-11, JOIN-1, JOIN-2, PRJ-10,
SNK-6, SNK-7, FLT-2, FLT-3).

The ledger and the plan hold one row per Kafka topic partition: their size is
bounded by the partition count of the subscribed topics, which is why they
are the broadcast side of every join here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class LedgerError(RuntimeError):
    pass


def latest_offsets(msgs: DataFrame) -> DataFrame:
    """SRC-4 / AGG-11 on a Kafka-shaped table: next offset per partition,
    ``topic, part, until_off`` (= newest offset + 1)."""
    return (msgs.groupBy("topic", F.col("partition").alias("part"))
            .agg((F.max("offset") + 1).cast("bigint").alias("until_off")))


def ledger_for(ledger: DataFrame, topic: str) -> DataFrame:
    """SRC-5 / FLT-2: ``part, off`` of one topic (pushed down by JDBC / Parquet)."""
    return ledger.where(F.col("topic") == topic).select("part", "off")


def offset_plan(latest: DataFrame, ledger: DataFrame) -> DataFrame:
    """JOIN-1 + PRJ-10: ``topic, part, from_off, until_off, in_ledger``.

    Half-open ranges ``[from_off, until_off)``; a partition without a ledger
    row (or with 0) starts at 0.
    """
    led = F.broadcast(ledger.select("topic", "part", "off"))
    return (latest.join(led, ["topic", "part"], "left")
            .select("topic", "part",
                    F.coalesce(F.col("off"), F.lit(0)).cast("bigint").alias("from_off"),
                    F.col("until_off").cast("bigint").alias("until_off"),
                    F.col("off").isNotNull().alias("in_ledger")))


def check_plan(plan: DataFrame, bootstrap: bool = False) -> list:
    """Validate a plan before anything is written; returns its rows.

    Fails on a failed latest-offset lookup (negative), on ranges running
    backwards, and on partitions missing from the ledger unless ``bootstrap``.
    The plan has one row per topic partition.
    """
    rows = plan.collect()
    bad = [r for r in rows if r["until_off"] is None or r["until_off"] < 0]
    if bad:
        raise LedgerError(f"latest offset unknown for {[(r['topic'], r['part']) for r in bad]}")
    back = [r for r in rows if r["until_off"] < r["from_off"]]
    if back:
        raise LedgerError(f"ranges run backwards for {[(r['topic'], r['part']) for r in back]}")
    missing = [r for r in rows if not r["in_ledger"]]
    if missing and not bootstrap:
        raise LedgerError(f"no ledger row for {[(r['topic'], r['part']) for r in missing]}")
    return rows


def select_range(msgs: DataFrame, plan: DataFrame) -> DataFrame:
    """JOIN-2: the messages whose offset is in ``[from_off, until_off)`` of
    their partition.  Broadcast hash join on (topic, partition) with the range
    as a join filter — no nested loop."""
    p = F.broadcast(plan.select(F.col("topic").alias("p_topic"), F.col("part").alias("p_part"),
                                "from_off", "until_off"))
    cond = ((msgs["topic"] == p["p_topic"]) & (msgs["partition"] == p["p_part"])
            & (msgs["offset"] >= p["from_off"]) & (msgs["offset"] < p["until_off"]))
    return msgs.join(p, cond, "inner").drop("p_topic", "p_part", "from_off", "until_off")


def bootstrap(ledger: DataFrame, partitions: DataFrame) -> DataFrame:
    """SNK-7: add ``(topic, part, 0)`` for discovered partitions the ledger
    lacks; existing rows stay as they are."""
    new = (partitions.select("topic", "part").distinct()
           .join(F.broadcast(ledger.select("topic", "part")), ["topic", "part"], "left_anti")
           .withColumn("off", F.lit(0).cast("bigint")))
    return ledger.select("topic", "part", F.col("off").cast("bigint")).unionByName(new)


def commit(ledger: DataFrame, plan: DataFrame, require_existing: bool = True) -> DataFrame:
    """SNK-6: set ``off = until_off`` for every planned partition (keyed merge
    as a full outer join).  With ``require_existing`` a planned partition
    without a ledger row raises, like an UPDATE that touched 0 rows."""
    from pyspark.sql import Window
    led = ledger.select("topic", "part", F.col("off").cast("bigint"))
    upd = plan.select("topic", "part", "until_off")
    merged = led.join(upd, ["topic", "part"], "full_outer")
    new_off = F.coalesce(F.col("until_off"), F.col("off"))
    # an update must touch exactly one row: duplicated ledger rows fail too
    # (a window over a table of one row per partition)
    dup = F.count(F.lit(1)).over(Window.partitionBy("topic", "part")) > 1
    new_off = F.when(dup, F.raise_error(F.concat(F.lit("duplicate ledger rows for "), F.col("topic"),
                                                 F.lit("/"), F.col("part").cast("string")))
                     ).otherwise(new_off)
    if require_existing:
        # checked in the output expression itself, so it cannot be pruned
        new_off = F.when(F.col("off").isNull(),
                         F.raise_error(F.concat(F.lit("no ledger row for "), F.col("topic"),
                                                F.lit("/"), F.col("part").cast("string")))
                         ).otherwise(new_off)
    return merged.select("topic", "part", new_off.cast("bigint").alias("off"))
