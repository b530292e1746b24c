"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewtally.session import ensure_checkpoint_dir

#: a word: a run of bytes that are no ASCII white space (the same set that
#: ``bytes.split()`` cuts at)
WORD = r"[^\x20\x09-\x0D]+"

#: stands for a null id inside keys and orderings (before every real id)
NULL_ID = -(1 << 63)

#: text rows per Arrow batch inside the operators' own materialised steps
TEXT_BATCH_ROWS = 1000


def stage(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder that
    ``spark.checkpoint.dir`` names, and read it back: lineage is cut, later
    steps survive the loss of any executor, and columns prune.  ``codec``: how
    its pages are packed, the session's way without it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def text_batches(spark: SparkSession, rows: int = TEXT_BATCH_ROWS) -> Iterator[None]:
    """Smaller Arrow batches while whole texts pass through Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def word_count(text: str | Column) -> Column:
    """Number of words of a text, null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def id_key(col: str) -> Column:
    return F.coalesce(F.col(col).cast("bigint"), F.lit(NULL_ID))


def text_key(col: str = "text") -> Column:
    """Tells rows apart that share a doc_id; null and empty texts are alike."""
    return F.xxhash64(F.coalesce(F.col(col), F.lit("")))


def whole_row(docs: DataFrame) -> Column:
    """All columns as one, so that helper columns clash with none of them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def keep_rows(docs: DataFrame, keepers: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (``_id``, ``_tk``) is in ``keepers``, one row
    for each pair, all columns of ``docs``: of rows with equal id and text the
    one whose columns have the least hash.  Texts move once, to the join."""
    keyed = docs.select(whole_row(docs), id_key("doc_id").alias("_id"), text_key().alias("_tk"))
    return (keyed.join(keepers.select("_id", "_tk"), ["_id", "_tk"], "left_semi")
            .groupBy("_id", "_tk").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row")).select("_row.*"))


def ordered(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` range-partitioned and sorted by ``keys`` (nulls first), written
    once, with ``_at``: a number that grows in that order over the whole table.

    The ranges come from a sample of the rows themselves, so they are even
    whatever the values look like; rows equal in every key are told apart by
    where they were read, so not even those meet in one task.
    """
    kept = df.columns
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    return stage(tied.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie")
                 .select(*kept, F.monotonically_increasing_id().alias("_at")), name)


def ranks(placed: DataFrame, group: list[str], out: str, runs_of: DataFrame | None = None) -> DataFrame:
    """Add the 1-based position of each row in its group to rows that
    ``ordered`` numbered, ``group`` being its first keys and never null.

    In a range partition the rows of a group follow each other without a gap,
    so a position is the row's place in its (group, partition) run and the rows
    of the group's earlier runs.  Only the run table (partitions and groups
    together bound it) passes through a window.  ``runs_of``: the same rows,
    where ``placed`` is costly to read twice."""
    cell = F.shiftright("_at", 33).alias("_cell")
    runs = (placed if runs_of is None else runs_of).groupBy(*group, cell) \
        .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*group, "_cell", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    return (placed.withColumn("_cell", F.shiftright("_at", 33)).join(runs, [*group, "_cell"])
            .withColumn(out, (F.col("_start") + F.col("_at") - F.col("_first") + 1).cast("bigint"))
            .drop("_cell", "_first", "_start"))


def positions(df: DataFrame, group: list[str], order: list[str], out: str = "pos") -> DataFrame:
    """Add the 1-based position of each row in its group by ``order``; ties in
    any order.  No group goes to one task."""
    return ranks(ordered(df, [*group, *order], "placed"), group, out).drop("_at")


def bounded_sample(rows: DataFrame, group: str, key: str, most: int, cell_bits: int = 16) -> DataFrame:
    """The ``most`` rows of each group with the least hash of ``key`` (a
    repeatable random sample), columns unchanged.

    No group goes to one task: rows are counted in cells of the hash's first
    ``cell_bits`` bits, only cells that start below ``most`` are read again, and
    only they are sorted, about ``most`` rows and one cell (a 65,536th of
    the group) for each group.  ``rows`` is read twice; pass narrow rows.
    """
    cell = F.shiftright(F.xxhash64(key), 64 - cell_bits).cast("int")
    sizes = rows.groupBy(F.col(group).alias("_g"), cell.alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_g").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    # a cell holds a row or more: at most ``most`` cells of a group are kept
    kept = (sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
            .filter(F.col("_start") < most).select("_g", "_c"))
    near = rows.withColumn("_cell", cell).join(
        F.broadcast(kept), F.col(group).eqNullSafe(F.col("_g")) & (F.col("_cell") == F.col("_c")), "left_semi")
    pick = Window.partitionBy(group).orderBy(F.xxhash64(key), key)
    return near.withColumn("_k", F.row_number().over(pick)).filter(F.col("_k") <= most).select(*rows.columns)


def _signature(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))).alias("s")).first()
    return r["n"], r["s"] or 0


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected components of links (u, v): rows (node, root), root the least
    node of the component; nodes without a link do not appear.

    Alternates large-star and small-star until the links no longer change.
    Minima are aggregated before the shuffle and joined back, so a node with
    very many links is no list in any task; each round is checkpointed.
    """
    def star(e: DataFrame) -> DataFrame:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")) \
            .select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        return (small.select("u", F.col("m").alias("v"))
                .union(small.filter("v != m").select(F.greatest("v", "m").alias("u"),
                                                     F.least("v", "m").alias("v")))
                .distinct())

    ensure_checkpoint_dir(edges.sparkSession)
    now = (edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
           .filter("u != v").distinct().checkpoint())
    seen = _signature(now)
    for _ in range(max_rounds):
        now = star(now).checkpoint()
        sign = _signature(now)
        if sign == seen:
            break
        seen = sign
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(now.select("v", "v")).distinct())


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(s, s + n)`` for each start and size."""
    total = int(sizes.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - sizes), sizes)
