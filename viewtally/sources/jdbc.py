"""JDBC sources (SRC-5, SRC-6): Spark's JDBC reader owns the connections;
filters and projections are pushed to the database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, url: str, table: str, props: dict | None = None,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """SRC-6: table scan by options; optional parallel read over a numeric column."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (props or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def read_ledger(spark: SparkSession, url: str, table: str, topics: str | list[str] | None = None,
                props: dict | None = None) -> DataFrame:
    """SRC-5: the ledger (``topic, part, off``), filtered by topic in the
    database: the filter is on the column as it is stored, blanks of a padded
    column are cut behind it."""
    df = read_table(spark, url, table, props)
    if topics:
        df = df.where(F.col("topic").isin([topics] if isinstance(topics, str) else list(topics)))
    return df.select(F.trim(F.col("topic")).alias("topic"), F.col("part").cast("int").alias("part"),
                     F.col("off").cast("bigint").alias("off"))
