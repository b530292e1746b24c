"""Full ranking in score order (RNK-1): every member's rank, not just a top-k.

A sorted set answers the rank of any member.  Here the rows are range-partitioned
by (tick, score, member): a row's rank is its place in its partition's
run of the tick and the rows of the tick's earlier runs.  Only the runs (one
for each tick and partition that meet) pass through a window; the members of
a tick are never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtally.plans.sizing import share

#: bits of ``monotonically_increasing_id`` below the partition number
ROW_BITS = 33


def rank_members(trend: DataFrame, tick_col: str = "tick_ms", score: str = "n", member: str = "video") -> DataFrame:
    """Add ``rank`` (from 1) of each member at its tick: highest score first,
    equal scores by member descending, as a sorted set read in reverse.
    ``tick_col`` must not be null."""
    order = [F.col(tick_col), F.desc(score), F.desc(member)]
    # numbered once: the ranges come from a sample, another pass might cut elsewhere
    placed = share(trend.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("_at", F.monotonically_increasing_id()))
    run = F.shiftright("_at", ROW_BITS).alias("_run")
    runs = placed.groupBy(tick_col, run).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(tick_col).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(tick_col, "_run", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (placed.withColumn("_run", run).join(runs, [tick_col, "_run"])
            .withColumn("rank", (F.col("_before") + F.col("_at") - F.col("_first") + 1).cast("bigint"))
            .drop("_run", "_first", "_before", "_at"))
