"""Schemas of messages, events, log rows and the offset ledger."""

from pyspark.sql import types as T

# Kafka-shaped message (key = event time in epoch ms as text, value = JSON).
MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

_COMMON = ["referrer", "viewer", "product", "metric", "location", "video", "uuid", "url"]

# JSON payloads; every field is text.  `viewer` is optional for page views and
# clicks, required for orders; orders also carry `order`.
PAGE_VIEW_FIELDS = _COMMON + ["timestamp"]
CLICK_FIELDS = _COMMON + ["timestamp"]
ORDER_FIELDS = _COMMON + ["order", "timestamp"]
ALL_FIELDS = _COMMON + ["order", "timestamp"]

REQUIRED = {
    "pageview": [f for f in PAGE_VIEW_FIELDS if f != "viewer"],
    "click": [f for f in CLICK_FIELDS if f != "viewer"],
    "order": list(ORDER_FIELDS),
}

CORRUPT_COLUMN = "_corrupt_record"

EVENT_JSON = T.StructType(
    [T.StructField(f, T.StringType()) for f in ALL_FIELDS]
    + [T.StructField(CORRUPT_COLUMN, T.StringType())]
)

# Log row stored by the storage jobs.
LOG_ROW = T.StructType([
    T.StructField("metric", T.StringType()),
    T.StructField("log_date", T.TimestampNTZType()),
    T.StructField("data", T.StringType()),
])

# Offset ledger: one row per (topic, part); `off` is the next offset to read.
LEDGER = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("off", T.LongType()),
])
