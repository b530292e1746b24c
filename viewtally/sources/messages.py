"""Kafka-shaped messages from the driver's ``events`` table (test adapter) and
the file twin of the Kafka stream (SRC-1 test twin).

Mapping: view -> pageview, click -> click, purchase -> order, other types
dropped; topic ``<prefix>-<metric>``; key = event time in epoch ms as text;
partition = ``event_id % partitions``; offset dense from 0 per
(topic, partition) in ``event_id`` order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtally import schemas as S
from viewtally.functions import time as tm
from viewtally.operators.numbering import dense_numbers
from viewtally.plans.sizing import spread_if_narrow

EVENT_TYPE_TO_METRIC = {"view": "pageview", "click": "click", "purchase": "order"}

# Constant payload fields of the adapter (our fixture values).
FIXTURE_REFERRER = "home"
FIXTURE_PRODUCT = "web"
FIXTURE_LOCATION = "hn"
FIXTURE_URL = "site/watch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _metric_of_type(c: Column) -> Column:
    out = None
    for et, m in EVENT_TYPE_TO_METRIC.items():
        out = F.when(c == et, F.lit(m)) if out is None else out.when(c == et, F.lit(m))
    return out


def _viewer(metric: Column, user_id: Column) -> Column:
    """user_id as text; for views and clicks empty when user_id % 7 = 0 and
    absent (NULL -> field left out of the JSON) when user_id % 7 = 1."""
    txt = user_id.cast("string")
    pv_or_click = metric.isin("pageview", "click")
    return (F.when(pv_or_click & (F.pmod(user_id, F.lit(7)) == 0), F.lit(""))
            .when(pv_or_click & (F.pmod(user_id, F.lit(7)) == 1), F.lit(None).cast("string"))
            .otherwise(txt))


def event_payload(metric: Column, key: Column, user_id: Column, event_id: Column,
                  props: Column) -> Column:
    """JSON value of one message; ``to_json`` leaves NULL fields out."""
    video = F.concat(F.lit("v"), F.get_json_object(props, "$.k"))
    return F.to_json(F.struct(
        F.lit(FIXTURE_REFERRER).alias("referrer"),
        _viewer(metric, user_id).alias("viewer"),
        F.lit(FIXTURE_PRODUCT).alias("product"),
        metric.alias("metric"),
        F.lit(FIXTURE_LOCATION).alias("location"),
        video.alias("video"),
        F.concat(F.lit("u-"), user_id.cast("string")).alias("uuid"),
        F.lit(FIXTURE_URL).alias("url"),
        F.when(metric == "order", F.concat(F.lit("o-"), event_id.cast("string"))).alias("order"),
        key.alias("timestamp"),
    ))


def events_as_messages(events: DataFrame, prefix: str = "test", partitions: int = 4,
                       corrupt_every: int | None = None, with_offsets: bool = True) -> DataFrame:
    """``events`` -> ``key, value, topic, partition, offset`` (+ ``event_id``).

    Offsets cost a numbering pass; metric jobs, which never read them, pass
    ``with_offsets=False`` (a real Kafka source hands them over for free).

    ``corrupt_every=n`` cuts the JSON of every n-th event in half, to exercise
    the reject path (FLT-4) without dropping any row.
    """
    metric = _metric_of_type(F.col("event_type"))
    base = spread_if_narrow(
        events.where(F.col("event_type").isin(*EVENT_TYPE_TO_METRIC))
        .select("event_id", "ts", "user_id", "props", metric.alias("metric")))
    key = tm.ntz_to_ms("ts").cast("string")
    value = event_payload(F.col("metric"), key, F.col("user_id"), F.col("event_id"), F.col("props"))
    if corrupt_every:
        base = base.withColumn("__v", value)
        value = F.when(F.pmod(F.col("event_id"), F.lit(corrupt_every)) == 0,
                       F.expr("substring(__v, 1, cast(length(__v) / 2 as int))")
                       ).otherwise(F.col("__v"))
    msgs = base.select(
        "event_id",
        key.alias("key"),
        value.alias("value"),
        F.concat(F.lit(prefix + "-"), F.col("metric")).alias("topic"),
        F.pmod(F.col("event_id"), F.lit(partitions)).cast("int").alias("partition"),
    )
    if not with_offsets:
        return msgs.withColumn("offset", F.lit(None).cast("bigint"))
    return dense_numbers(msgs, ["topic", "partition"], "event_id", "offset")


def messages(spark: SparkSession, sf_dir: str, prefix: str = "test", **kw) -> DataFrame:
    return events_as_messages(read_table(spark, sf_dir, "events"), prefix, **kw)


def message_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Streaming twin of the Kafka source: JSON-lines files with the message
    schema, read in file modification order (SRC-1 test twin)."""
    return (spark.readStream.schema(S.MESSAGE)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .json(path))
