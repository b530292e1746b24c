"""Mixing sources to target weights by systematic sampling.

Targets: the budget is shared by weight, a source takes at most ``cap`` times
its size, and what it can't take is shared again by weight.  That end state is
``min(cap * size, level * weight)`` for one common level, found with two
window sums over the (source, size) table instead of rounds.

Copies: each document of a source expects ``target / source_size`` copies.
Documents are prefix-summed in (size, doc_id) order, so equal sizes are
neighbours and the words taken follow the target closely; one offset per
source is added, and a document is emitted once per integer boundary that its
stretch of the running sum crosses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtally.llm.common import id_key, positions, stage, whole_row, word_count

WEIGHTS = (3, 1, 2)     # of the sources by code point, repeating
SHARE = 1.5             # all targets together, in sizes of the whole input
CAP = 2                 # a target's most, in sizes of its source
SEED = "mix"


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> the same with ``target``.  One row per source;
    sources are ordered by code point, null last."""
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy(F.col("cap") / F.col("w"), "k")
    earlier = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    later = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("k") % len(weights) + 1).cast("int"))
    # the level if every source that fills earlier is at its cap and no other is
    level = ((F.sum("source_size").over(whole).cast("double") * share
              - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))) / F.sum("w").over(later))
    open_ = F.when(F.col("cap") >= F.col("level") * F.col("w"), F.col("fill"))
    return (sizes.withColumn("k", F.row_number().over(by_source) - 1)
            .withColumn("w", weight)
            .withColumn("cap", F.col("source_size").cast("double") * cap)
            .withColumn("level", level).withColumn("fill", F.row_number().over(by_fill))
            .withColumn("fill", F.min(open_).over(whole) == F.col("fill"))
            .withColumn("level", F.max(F.when(F.col("fill"), F.col("level"))).over(whole))
            .withColumn("target", F.coalesce(F.least("cap", F.col("level") * F.col("w")), "cap"))
            .select("source", "source_size", "target"))


def _mixed(rows: DataFrame, weights, share: float, cap: int, seed: str) -> DataFrame:
    """``rows``: _id, source, size.  Adds source_size, target, copies."""
    sized = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    # a fixed offset in [0, 1) for each source
    offset = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(seed), F.lit("source"), "source")), 1, 8),
                    16, 10).cast("double") / float(1 << 32)
    sized = sized.select(F.col("source").alias("_s"), "source_size", "target", offset.alias("_u"),
                         F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                         .otherwise(F.lit(0.0)).alias("_rate"))
    ranked = positions(rows.withColumns({"_null": F.col("source").isNull(),
                                         "_name": F.coalesce("source", F.lit(""))}),
                       ["_null", "_name"], ["size", "_id"])
    up_to = lambda n: F.floor(n * F.col("_rate") + F.col("_u"))
    # at most `cap` by arithmetic; least() keeps rounding from adding one
    copies = F.least(up_to(F.col("pos")) - up_to(F.col("pos") - 1), F.lit(cap).cast("bigint"))
    return (ranked.join(sized, F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("copies", copies))


def mix_plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP,
             seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, size (words), source_size, target
    (of its source), copies, taken (copies * size).

    Null and empty texts have size 0 and follow their source's rate; a null
    source is a source of its own, last in order; a source of size 0 has target
    0 and no copies.  Repeated rows are rows like any other.  The offset comes
    from a hash of ``seed`` and the source's name: reruns agree.  An empty table gives no
    rows.  No other column is looked at.
    """
    # written once: texts are read and counted a single time
    rows = stage(docs.select("doc_id", id_key("doc_id").alias("_id"), "source", word_count("text").alias("size")), "sizes")
    return _mixed(rows, weights, share, cap, seed).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, all columns.
    Whole rows are written once with a number of their own, ranked without
    their texts, and joined back by that number."""
    rows = stage(docs.select(whole_row(docs), F.monotonically_increasing_id().alias("_rid"), id_key("doc_id").alias("_id"),
                             "source", word_count("text").alias("size")), "rows")
    taken = (_mixed(rows.drop("_row"), weights, share, cap, seed).filter("copies > 0").select("_rid", "copies"))
    return (rows.select("_rid", "_row").join(taken, "_rid")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("_row.*"))
