"""Corpus pipeline: language ID, exact dedup, SimHash near-dedup, mixing, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame.  ``run`` writes
each result as Parquet in the shared folder and reads it back as the next
stage's ``docs``.  All stages but the last return the columns of documents.

* language_id drops documents without a letter and those written in none of the
  languages learnt (known share of the letters below ``langid.MIN_KNOWN``).  It
  learns from the rows with a language of its own input, and drops no document
  with a letter if there are none; the column ``lang`` itself is not changed.
* exact_dedup keeps the row with the largest doc_id of equal texts.
* near_dedup keeps the row with the smallest doc_id of each group.
* source_mix repeats or drops documents so that each source nears its target.
* packing returns the places of all pieces (see ``packing.pack``).

A table without rows goes through as one; null texts are rejected by the
first stage.  ``lang``, ``source``, ``n_chars`` and any further columns pass
unchanged.  SQL can express neither the language model nor the fingerprints,
so there is no SQL for the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewtally.llm import exact_dedup as exact
from viewtally.llm import langid, mixing, packing, simhash
from viewtally.llm.common import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.fit(docs.filter(langid.learns_from())))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("source_mix", source_mix), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
