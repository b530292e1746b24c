"""Message -> typed event / log row (PRJ-1..5, 9, 14; SRC-2; FLT-4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtally import config as C
from viewtally import schemas as S
from viewtally.functions import time as tm


def metric_of_topic(topic="topic") -> Column:
    """``<prefix>-<metric>`` -> metric (SRC-2)."""
    t = F.col(topic) if isinstance(topic, str) else topic
    return F.regexp_extract(t, r"-([^-]+)$", 1)


def topics_for(prefix: str, metrics=("pageview", "click", "order")) -> list[str]:
    """The topic names one prefix stands for (SRC-2)."""
    return [f"{prefix}-{m}" for m in metrics]


def message_id() -> Column:
    """Deterministic surrogate row id from the message coordinates (PRJ-14)."""
    return F.concat_ws("-", F.col("topic"), F.col("partition").cast("string"),
                       F.col("offset").cast("string"))


def uid_of(metric: Column, viewer: Column, uuid: Column) -> Column:
    """User id: page views fall back to ``uuid`` when ``viewer`` is absent or
    empty (PRJ-4); clicks and orders take ``viewer`` as is (PRJ-5)."""
    return F.when(metric == "pageview", F.coalesce(F.nullif(viewer, F.lit("")), uuid)) \
        .otherwise(viewer)


def _missing_required(metric: Column, j: str) -> Column:
    """Name of the first required field that is missing, else NULL."""
    out = None
    for m, fields in S.REQUIRED.items():
        first = F.coalesce(*[F.when(F.col(f"{j}.{f}").isNull(), F.lit(f)) for f in fields])
        out = (F.when(metric == m, first) if out is None else out.when(metric == m, first))
    return out


def bad_key(ms: Column) -> Column:
    """Why a key can't be an event time in epoch ms, else NULL.  Seconds or
    microseconds parse as numbers too: what lies outside ``KEY_RANGE_MS`` is rejected."""
    return (F.when(ms.isNull(), F.lit("bad key"))
            .when(~ms.between(*C.KEY_RANGE_MS), F.lit("key out of range")))


def parse_messages(msgs: DataFrame, strict: bool = False, metric: str | None = None,
                   raw: bool = False) -> DataFrame:
    """Parse Kafka-shaped messages into typed events (PRJ-3).

    Output columns: ``metric, ts_ms, referrer, viewer, product, location, video,
    uuid, url, order, timestamp, uid, topic, partition, offset, reject_reason``.
    ``reject_reason`` is NULL for valid rows; lenient mode keeps rejected rows
    for a reject table, ``strict=True`` raises on the first bad row like the
    original job does.  One JSON parse per row, all JVM-side.  ``raw`` adds the
    key and value of rejected messages (NULL for valid ones).
    """
    opts = {"mode": "FAILFAST" if strict else "PERMISSIVE",
            "columnNameOfCorruptRecord": S.CORRUPT_COLUMN}
    met = F.lit(metric) if metric else metric_of_topic("topic")
    cols = [c for c in ("topic", "partition", "offset") if c in msgs.columns]
    # The parsed struct comes out of a generator (one element, so one row per
    # message): predicates on it cannot be pushed below the generator, which
    # would otherwise inline ``from_json`` once per referenced field.
    df = msgs.select(
        met.alias("metric"),
        tm.key_to_ms("key").alias("ts_ms"),
        F.explode(F.array(F.from_json("value", S.EVENT_JSON, opts))).alias("j"),
        *cols, *(["key", "value"] if raw else []),
    )
    missing = _missing_required(F.col("metric"), "j")
    key = bad_key(F.col("ts_ms"))
    reason = (F.when(key.isNotNull(), key)
              .when(F.col("j").isNull() | F.col(f"j.{S.CORRUPT_COLUMN}").isNotNull(),
                    F.lit("bad json"))
              .when(~F.col("metric").isin(*S.REQUIRED), F.lit("unknown metric"))
              .when(missing.isNotNull(), F.concat(F.lit("missing "), missing)))
    if strict:
        reason = F.when(reason.isNotNull(),
                        F.raise_error(F.concat(F.lit("rejected message: "), reason)))
    out = df.select(
        "metric", "ts_ms",
        *[F.col(f"j.{f}").alias(f) for f in S.ALL_FIELDS if f != "metric"],
        uid_of(F.col("metric"), F.col("j.viewer"), F.col("j.uuid")).alias("uid"),
        *cols,
        reason.alias("reject_reason"),
        *([F.when(reason.isNotNull(), F.col(c)).alias(c) for c in ("key", "value")] if raw else []),
    )
    return out


def valid_events(msgs: DataFrame, strict: bool = False) -> DataFrame:
    return parse_messages(msgs, strict).where(F.col("reject_reason").isNull()).drop("reject_reason")


def log_rows(msgs: DataFrame, metric: str | None = None, with_id: bool = False) -> DataFrame:
    """Log row ``(metric, log_date, data)``: metric tag, key -> timestamp, raw
    JSON kept (PRJ-1, PRJ-2)."""
    met = F.lit(metric) if metric else metric_of_topic("topic")
    extra = [message_id().alias("msg_id")] if with_id else []
    return msgs.select(met.alias("metric"),
                       tm.ms_to_ntz(tm.key_to_ms("key")).alias("log_date"),
                       F.col("value").alias("data"), *extra)


def checked_log_rows(msgs: DataFrame, strict: bool = False) -> DataFrame:
    """Log rows to store, with coordinates, ``msg_id`` and ``reject_reason``
    (NULL: store it).  A bad key, a topic without a metric and invalid JSON
    never reach the store; ``strict`` raises on the first of them."""
    ms = tm.key_to_ms("key")
    met = metric_of_topic("topic")
    key = bad_key(ms)
    reason = (F.when(key.isNotNull(), key).when(met == "", F.lit("unknown metric"))
              .when(~json_valid("value"), F.lit("bad json")))
    if strict:
        reason = F.when(reason.isNotNull(), F.raise_error(F.concat(F.lit("rejected message: "), reason)))
    return msgs.select(met.alias("metric"), F.when(key.isNull(), tm.ms_to_ntz(ms)).alias("log_date"),
                       F.col("value").alias("data"), message_id().alias("msg_id"),
                       "topic", "partition", "offset", "key", reason.alias("reject_reason"))


def typed_log_rows(msgs: DataFrame, strict: bool = False) -> DataFrame:
    """Log rows with the JSON fields as columns instead of the raw text:
    ``metric, log_date``, the event fields, ``msg_id`` and coordinates;
    ``reject_reason`` (NULL: store it) and, for rejected messages, the raw
    ``key`` and ``value``.  One JSON parse per message."""
    parsed = parse_messages(msgs, strict, raw=True)
    in_range = bad_key(F.col("ts_ms")).isNull()
    fields = [f for f in S.ALL_FIELDS if f != "metric"]
    return parsed.select("metric", F.when(in_range, tm.ms_to_ntz("ts_ms")).alias("log_date"), *fields,
                         message_id().alias("msg_id"), "topic", "partition", "offset", "reject_reason", "key", "value")


def with_variant(rows: DataFrame, col: str = "data") -> DataFrame:
    """Valid JSON text as a variant column ``payload`` (FLT-4: the database's
    ``json`` type): parsed once at write, fields are read by path and type with
    ``variant_get``, and rows with other fields or types share the schema."""
    return rows.withColumn("payload", F.try_parse_json(col)).drop(col)


def json_valid(col="data") -> Column:
    """JSON validity check of a text column (FLT-4)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.try_parse_json(c).isNotNull(), F.lit(False))
