"""Exact dedup: 128-bit content hash, then bytes compared inside the groups.

DataFrame functions only.  Hashes travel first; then every text moves once, to a
merge join with the groups that hold two rows or more (the same plan at every
size), which is where bytes are compared.
A row whose bytes differ from its group's representative (a hash collision)
is regrouped by hash and full text, so it never merges with the others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtally.llm.common import NULL_ID, id_key, keep_rows, stage, text_key


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _decide(docs: DataFrame, content_hash: Callable[[Column], Column]) -> DataFrame:
    base = docs.select(id_key("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_t")) \
        .withColumn("_h", content_hash(F.col("_t")))
    groups = stage(base.groupBy("_h").agg(F.max("_id").alias("_rep"), F.count(F.lit(1)).alias("_n"))
                   .filter("_n > 1").select("_h", "_rep"), "groups")
    # texts of the rows that share their hash with another row
    # (a merge join at every size, so that cost grows with the input alone)
    members = stage(base.join(groups.hint("merge"), "_h"), "members")
    reps = stage(members.filter("_id = _rep").groupBy("_h").agg(F.min("_t").alias("_rep_t")), "representatives")
    # a class is a hash, and the text as well where its bytes differ from the representative's
    # written before it is counted, so that the join may split a large group
    classed = stage(members.join(reps, "_h").select(
        "_id", "_h", F.when(F.col("_t") != F.col("_rep_t"), F.col("_t")).alias("_other"),
        text_key("_t").alias("_tk"), F.sha2("_t", 256).alias("text_sha256")), "compared")
    counted = classed.groupBy("_h", "_other", "_id", "_tk", "text_sha256").agg(F.count(F.lit(1)).alias("_m"))
    sizes = (counted.groupBy("_h", "_other").agg(F.max("_id").alias("_keep"), F.sum("_m").alias("group_size"))
             .withColumnsRenamed({"_h": "_gh", "_other": "_go"}))
    copies = (counted.join(sizes, (F.col("_h") == F.col("_gh")) & F.col("_other").eqNullSafe(F.col("_go")))
              .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_m").cast("int"))))
              .withColumn("kept", (F.col("_id") == F.col("_keep")) & (F.col("_i") == 1)))
    single = (base.withColumns({"text_sha256": F.sha2("_t", 256), "_tk": text_key("_t")}).drop("_t")
              .join(groups.select("_h"), "_h", "left_anti")
              .withColumns({"_keep": F.col("_id"), "group_size": F.lit(1).cast("bigint"), "kept": F.lit(True)}))
    out = ["_id", "_tk", "_keep", "group_size", "kept", "text_sha256"]
    return single.select(*out).unionByName(copies.select(*out))


def dedup_decisions(docs: DataFrame, content_hash: Callable[[Column], Column] = md5_128) -> DataFrame:
    """One row per row of ``docs`` (needs doc_id and text; no other column is
    looked at): doc_id, keep_id, group_size, kept, text_sha256.

    Of rows with equal text the one with the largest doc_id stays.  Null text
    counts as empty, and empty texts are equal to each other.  Rows that repeat
    both doc_id and text stay once; a null doc_id is before every other.
    An empty table gives no rows.
    """
    shown = lambda c: F.when(F.col(c) != F.lit(NULL_ID), F.col(c))
    return _decide(docs, content_hash).select(
        shown("_id").alias("doc_id"), shown("_keep").alias("keep_id"), "group_size", "kept", "text_sha256")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without all but one row of each exact text, columns unchanged."""
    return keep_rows(docs, _decide(docs, md5_128).filter("kept"))
