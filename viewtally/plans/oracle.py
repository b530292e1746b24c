"""DuckDB SQL with the same results as the catalogue (the correctness oracle).

Written directly against the ``events`` view, with plain range joins where
the Spark side uses tiers and grid arithmetic, so the two are independent.
The label zone (UTC+7, no DST since 1975) is a fixed 7-hour shift here.
"""

from __future__ import annotations

from viewtally.plans.catalog import (CORRUPT_EVERY, LATE_EVERY, LEX_RANGE, MINUTES_BACK, PREVIOUS_RUN_CUTOFF_MS, PURGE_AT_MS,
                                     TOP_K, UNLEDGERED)

ALT_SHIFT_MS = 5 * 3_600_000 + 30 * 60_000   # the alternative zone, UTC+5:30 (no DST)

TZ_SHIFT_MS = 7 * 3_600_000

EV = """ev AS (
  SELECT CASE event_type WHEN 'view' THEN 'pageview' WHEN 'click' THEN 'click' ELSE 'order' END AS metric,
         epoch_us(ts) // 1000 AS ts_ms,
         'v' || json_extract_string(props, '$.k') AS video,
         CASE WHEN event_type = 'view' AND user_id % 7 IN (0, 1) THEN 'u-' || CAST(user_id AS VARCHAR)
              ELSE CAST(user_id AS VARCHAR) END AS uid,
         CASE WHEN event_type IN ('view', 'click') AND user_id % 7 = 1 THEN NULL
              WHEN event_type IN ('view', 'click') AND user_id % 7 = 0 THEN ''
              ELSE CAST(user_id AS VARCHAR) END AS viewer,
         event_id, user_id
  FROM events WHERE event_type IN ('view', 'click', 'purchase'))"""

BOUNDS = """bounds AS (
  SELECT (min(epoch_us(ts) // 1000) // 86400000) * 86400000 AS d0,
         (max(epoch_us(ts) // 1000) // 86400000) * 86400000 + 86400000 AS d1
  FROM events)"""

TICKS30 = """ticks AS (SELECT unnest(generate_series(d0 + 1800000, d1 - 1, 3600000)) AS tick_ms FROM bounds)"""
TICKS5M = """ticks AS (SELECT unnest(generate_series(d0, d1 - 1, 300000)) AS tick_ms FROM bounds)"""

MSGS = EV + f""",
msgs AS (
  SELECT event_id, metric, ts_ms,
         CAST(ts_ms AS VARCHAR) AS key,
         '{{"referrer":"home",'
           || CASE WHEN viewer IS NULL THEN '' ELSE '"viewer":"' || viewer || '",' END
           || '"product":"web","metric":"' || metric || '","location":"hn","video":"' || video
           || '","uuid":"u-' || CAST(user_id AS VARCHAR) || '","url":"site/watch",'
           || CASE WHEN metric = 'order' THEN '"order":"o-' || CAST(event_id AS VARCHAR) || '",' ELSE '' END
           || '"timestamp":"' || CAST(ts_ms AS VARCHAR) || '"}}' AS value,
         'test-' || metric AS topic,
         CAST(event_id % 4 AS INTEGER) AS partition,
         row_number() OVER (PARTITION BY metric, event_id % 4 ORDER BY event_id) - 1 AS "offset"
  FROM ev),
latest AS (SELECT topic, partition AS part, max("offset") + 1 AS until_off FROM msgs GROUP BY 1, 2),
prev AS (
  SELECT topic, partition AS part, max("offset") + 1 AS off FROM msgs
  WHERE ts_ms < {PREVIOUS_RUN_CUTOFF_MS} AND NOT (topic = '{UNLEDGERED[0]}' AND partition = {UNLEDGERED[1]})
  GROUP BY 1, 2),
plan AS (
  SELECT l.topic, l.part, CAST(coalesce(p.off, 0) AS BIGINT) AS from_off,
         CAST(l.until_off AS BIGINT) AS until_off, p.off IS NOT NULL AS in_ledger
  FROM latest l LEFT JOIN prev p ON l.topic = p.topic AND l.part = p.part)"""


def _ts(ms_expr: str) -> str:
    return f"make_timestamp(({ms_expr}) * 1000)"


def _label(ms_expr: str, fmt: str) -> str:
    return f"strftime(make_timestamp((({ms_expr}) + {TZ_SHIFT_MS}) * 1000), '{fmt}')"


MIN = "%Y%m%d%H%M"
HOUR = "%Y%m%d%H"


def _per_minute(metric: str, key: str) -> str:
    b = "(ts_ms // 60000) * 60000"
    return f"""WITH {EV}
SELECT {_ts(b)} AS bucket, '{key}:' || {_label(b, MIN)} AS bucket_key, count(*) AS n
FROM ev WHERE metric = '{metric}' GROUP BY {b}"""


def _video(grain_ms: int, key: str, fmt: str) -> str:
    b = f"(ts_ms // {grain_ms}) * {grain_ms}"
    return f"""WITH {EV}
SELECT {_ts(b)} AS bucket, '{key}:' || {_label(b, fmt)} AS bucket_key, video, count(*) AS n
FROM ev WHERE metric = 'pageview' GROUP BY {b}, video"""


TREND_EXACT_BODY = """SELECT t.tick_ms, v.video, CAST(count(*) AS BIGINT) AS n
FROM ticks t JOIN ev v ON v.metric = 'pageview'
  AND v.ts_ms >= (t.tick_ms // 60000) * 60000 - 18000000 AND v.ts_ms <= t.tick_ms
GROUP BY 1, 2"""

_H = "(t.tick_ms // 3600000) * 3600000"
_M = "(t.tick_ms // 60000) * 60000"

TREND_TTL = f"""WITH {EV}, {BOUNDS}, {TICKS30},
v AS (SELECT ts_ms, video FROM ev WHERE metric = 'pageview'),
hb AS (SELECT (ts_ms // 3600000) * 3600000 AS b, max(ts_ms) AS lw FROM v GROUP BY 1),
hv AS (SELECT (ts_ms // 3600000) * 3600000 AS b, video, count(*) AS c FROM v GROUP BY 1, 2),
mb AS (SELECT (ts_ms // 60000) * 60000 AS b, max(ts_ms) AS lw FROM v GROUP BY 1),
mv AS (SELECT (ts_ms // 60000) * 60000 AS b, video, count(*) AS c FROM v GROUP BY 1, 2)
SELECT {_ts('tick_ms')} AS tick, video, CAST(sum(c) AS BIGINT) AS n FROM (
  SELECT t.tick_ms, hv.video, hv.c FROM ticks t
    JOIN hb ON hb.b BETWEEN {_H} - 4 * 3600000 AND {_H} - 3600000 AND hb.lw + 14400000 > t.tick_ms
    JOIN hv ON hv.b = hb.b
  UNION ALL
  SELECT t.tick_ms, v.video, 1 FROM ticks t JOIN v ON v.ts_ms >= {_H} AND v.ts_ms <= t.tick_ms
  UNION ALL
  SELECT t.tick_ms, mv.video, mv.c FROM ticks t
    JOIN mb ON mb.b >= {_M} - 18000000 AND mb.b < {_H} - 4 * 3600000 AND mb.lw + 18000000 > t.tick_ms
    JOIN mv ON mv.b = mb.b
) u GROUP BY tick_ms, video"""


def _users(metric: str) -> str:
    return f"""WITH {EV}, {BOUNDS}, {TICKS5M}
SELECT {_ts('t.tick_ms')} AS tick, v.uid, {_ts('max(v.ts_ms)')} AS last_seen
FROM ticks t JOIN ev v ON v.metric = '{metric}'
  AND v.ts_ms > t.tick_ms - 360000 AND v.ts_ms <= t.tick_ms
GROUP BY t.tick_ms, v.uid"""


_TTL = "CASE v.metric WHEN 'pageview' THEN 1800000 ELSE 360000 END"

VISIBLE = f"""WITH {EV}, {BOUNDS}, {TICKS30}
SELECT v.metric, {_ts('t.tick_ms')} AS tick, {_ts('(v.ts_ms // 60000) * 60000')} AS bucket, count(*) AS n
FROM ticks t JOIN ev v ON v.ts_ms <= t.tick_ms
  AND (v.ts_ms // 60000) * 60000 > t.tick_ms - 1800000 - 60000
GROUP BY v.metric, t.tick_ms, (v.ts_ms // 60000) * 60000
HAVING max(v.ts_ms) + max({_TTL}) > t.tick_ms"""

_LO = LEX_RANGE[0][1:]
_HI = LEX_RANGE[1][1:]
assert LEX_RANGE[0][0] == "[" and LEX_RANGE[1][0] == "("

_KEY_START = "((t.tick_ms - 18000000) // 60000) * 60000"
TREND_KEYS = f"""WITH {BOUNDS}, {TICKS30}
SELECT {_ts('t.tick_ms')} AS tick, CAST(r.i AS BIGINT) AS pos,
       'topvideos_h:' || {_label('t.tick_ms - (4 - r.i) * 3600000', HOUR)} AS bucket_key
FROM ticks t CROSS JOIN range(0, 5) r(i)
UNION ALL
SELECT {_ts('t.tick_ms')} AS tick, CAST(5 + r.j AS BIGINT) AS pos,
       'topvideos_m:' || {_label(f'({_KEY_START} // 3600000) * 3600000 + 3540000 - r.j * 60000', MIN)} AS bucket_key
FROM ticks t CROSS JOIN range(0, 60) r(j)
WHERE ({_KEY_START} // 3600000) * 3600000 + 3540000 - r.j * 60000 >= {_KEY_START}"""


ORACLE: dict[str, str] = {
    "views_per_minute": _per_minute("pageview", "videoviews"),
    "clicks_per_minute": _per_minute("click", "pageclicks"),
    "orders_per_minute": _per_minute("order", "orders"),
    "video_views_per_minute": _video(60000, "topvideos_m", MIN),
    "video_views_per_hour": _video(3600000, "topvideos_h", HOUR),
    "visible_minute_counters": VISIBLE,
    "batch_counts": f"""WITH {EV}
SELECT metric, {_ts('(ts_ms // 3600000) * 3600000')} AS batch, count(*) AS n
FROM ev GROUP BY metric, (ts_ms // 3600000) * 3600000""",
    "trending_exact": f"""WITH {EV}, {BOUNDS}, {TICKS30}, tr AS ({TREND_EXACT_BODY})
SELECT {_ts('tick_ms')} AS tick, video, n FROM tr""",
    "trending_ttl": TREND_TTL,
    "trending_top_k": f"""WITH {EV}, {BOUNDS}, {TICKS30}, tr AS ({TREND_EXACT_BODY}),
rk AS (SELECT tick_ms, video, n,
              row_number() OVER (PARTITION BY tick_ms ORDER BY n DESC, video DESC) AS rank FROM tr)
SELECT {_ts('tick_ms')} AS tick, video, n, CAST(rank AS BIGINT) AS rank FROM rk WHERE rank <= {TOP_K}""",
    "trend_bucket_keys": TREND_KEYS,
    "active_users": _users("pageview"),
    "order_users": _users("order"),
    "uid_fallback": f"""WITH {EV}
SELECT CASE WHEN viewer IS NULL THEN 'absent' WHEN viewer = '' THEN 'empty' ELSE 'viewer' END AS uid_source,
       count(*) AS n, count(DISTINCT uid) AS n_uids
FROM ev WHERE metric = 'pageview' GROUP BY 1""",
    "expire_by_lex": f"""WITH {EV}
SELECT uid, {_ts('max(ts_ms)')} AS last_seen FROM ev WHERE metric = 'pageview'
GROUP BY uid HAVING NOT (uid >= '{_LO}' AND uid < '{_HI}')""",
    "expire_by_score": f"""WITH {EV}
SELECT uid, {_ts('max(ts_ms)')} AS last_seen FROM ev WHERE metric = 'order'
GROUP BY uid HAVING max(ts_ms) > {PURGE_AT_MS - 360_000}""",
    "video_views_per_hour_alt_zone": f"""WITH {EV}
SELECT {_ts(f'((ts_ms + {ALT_SHIFT_MS}) // 3600000) * 3600000 - {ALT_SHIFT_MS}')} AS bucket,
       'topvideos_h:' || strftime({_ts(f'((ts_ms + {ALT_SHIFT_MS}) // 3600000) * 3600000')}, '%Y%m%d%H') AS bucket_key,
       video, count(*) AS n
FROM ev WHERE metric = 'pageview'
GROUP BY (ts_ms + {ALT_SHIFT_MS}) // 3600000, video""",
    "approx_users_accuracy": f"""WITH {EV}
SELECT {_ts('(ts_ms // 86400000) * 86400000')} AS period, count(DISTINCT uid) AS users, true AS close
FROM ev WHERE metric = 'pageview' GROUP BY (ts_ms // 86400000) * 86400000""",
    "minute_list": f"""WITH {BOUNDS}, {TICKS30}
SELECT {_ts('t.tick_ms')} AS tick, CAST(r.i AS BIGINT) AS pos,
       {_label(f't.tick_ms - ({MINUTES_BACK - 1} - r.i) * 60000', MIN)} AS label
FROM ticks t CROSS JOIN range(0, {MINUTES_BACK}) r(i)""",
    "offset_plan": f"""WITH {MSGS}
SELECT topic, part, from_off, until_off, in_ledger FROM plan""",
    "bounded_read": f"""WITH {MSGS}
SELECT m.topic, m.partition, m."offset", m.metric, {_ts('m.ts_ms')} AS log_date,
       m.topic || '-' || CAST(m.partition AS VARCHAR) || '-' || CAST(m."offset" AS VARCHAR) AS msg_id
FROM msgs m JOIN plan p ON m.topic = p.topic AND m.partition = p.part
  AND m."offset" >= p.from_off AND m."offset" < p.until_off""",
    "ledger_bootstrap": f"""WITH {MSGS}
SELECT topic, part, CAST(off AS BIGINT) AS off FROM prev
UNION ALL
SELECT l.topic, l.part, CAST(0 AS BIGINT) AS off FROM latest l
WHERE NOT EXISTS (SELECT 1 FROM prev p WHERE p.topic = l.topic AND p.part = l.part)""",
    "ledger_commit": f"""WITH {MSGS}
SELECT topic, part, CAST(until_off AS BIGINT) AS off FROM latest""",
    "log_rows": f"""WITH {MSGS}
SELECT metric, {_ts('ts_ms')} AS log_date, value AS data,
       topic || '-' || CAST(partition AS VARCHAR) || '-' || CAST("offset" AS VARCHAR) AS msg_id
FROM msgs""",
    "log_rows_per_day": f"""WITH {EV}
SELECT strftime({_ts('ts_ms')}, '%Y_%m_%d') AS log_day, count(*) AS n,
       min({_ts('ts_ms')}) AS first_log, max({_ts('ts_ms')}) AS last_log
FROM ev GROUP BY 1""",
    "json_reject_split": f"""WITH {EV}
SELECT CASE WHEN event_id % {CORRUPT_EVERY} = 0 THEN 'rejected' ELSE 'valid' END AS status, count(*) AS n
FROM ev GROUP BY 1""",
    "reject_reasons": f"""WITH {EV}
SELECT CASE WHEN event_id % {CORRUPT_EVERY} = 0 THEN 'bad json' ELSE 'valid' END AS reason, count(*) AS n
FROM ev GROUP BY 1""",
    "day_range_check": f"""WITH {EV}
SELECT strftime({_ts('ts_ms')}, '%Y_%m_%d') AS log_day, count(*) AS n, CAST(0 AS BIGINT) AS outside
FROM ev GROUP BY 1""",
    "ingest_replay": f"""WITH {MSGS}
SELECT topic, partition, count(*) AS n, count(*) AS n_ids FROM msgs GROUP BY ALL""",
    "json_schema_columns": f"""WITH {MSGS}, keyed AS (SELECT topic, unnest(json_keys(value)) AS "column" FROM msgs)
SELECT topic, "column", count(*) AS n FROM keyed GROUP BY ALL""",
    "parquet_round_trip": f"""WITH {MSGS}
SELECT strftime({_ts('ts_ms')}, '%Y_%m_%d') AS log_day, metric, {_ts('ts_ms')} AS log_date,
       json_extract_string(value, '$.viewer') AS viewer, json_extract_string(value, '$.video') AS video, json_extract_string(value, '$.order') AS "order",
       topic || '-' || CAST(partition AS VARCHAR) || '-' || CAST("offset" AS VARCHAR) AS msg_id
FROM msgs""",
    "stream_minute_counters": f"""WITH {EV}
SELECT metric, {_ts('(ts_ms // 60000) * 60000')} AS bucket, count(*) AS n
FROM ev GROUP BY metric, (ts_ms // 60000) * 60000""",
    "late_rows": f"""WITH {EV},
mark AS (SELECT max(ts_ms) - 1800000 AS ms FROM ev WHERE event_id % {LATE_EVERY} <> 0)
SELECT metric, {_ts('(ts_ms // 60000) * 60000')} AS bucket, count(*) AS n,
       count(*) FILTER (event_id % {LATE_EVERY} = 0 AND (ts_ms // 60000) * 60000 + 60000 <= mark.ms) AS n_late
FROM ev, mark GROUP BY metric, (ts_ms // 60000) * 60000""",
    "active_periods": f"""WITH {EV},
seen AS (SELECT metric, uid, ts_ms FROM ev WHERE metric IN ('pageview', 'order') AND uid IS NOT NULL),
starts AS (
  SELECT *, CASE WHEN ts_ms - lag(ts_ms) OVER w < 360000 THEN 0 ELSE 1 END AS fresh
  FROM seen WINDOW w AS (PARTITION BY metric, uid ORDER BY ts_ms)),
periods AS (SELECT *, sum(fresh) OVER (PARTITION BY metric, uid ORDER BY ts_ms ROWS UNBOUNDED PRECEDING) AS k FROM starts)
SELECT metric, uid, {_ts('min(ts_ms)')} AS since, {_ts('max(ts_ms)')} AS last, count(*) AS n
FROM periods GROUP BY metric, uid, k""",
    "trend_rank": f"""WITH {EV}, {BOUNDS}, {TICKS30}, tr AS ({TREND_EXACT_BODY})
SELECT {_ts('tick_ms')} AS tick, video, n,
       row_number() OVER (PARTITION BY tick_ms ORDER BY n DESC, video DESC) AS rank FROM tr""",
    "live_trend": f"""WITH {EV},
views AS (SELECT video, ts_ms, max(ts_ms) OVER () AS tick_ms FROM ev WHERE metric = 'pageview'),
tr AS (SELECT tick_ms, video, count(*) AS n FROM views
       WHERE ts_ms >= (tick_ms // 60000) * 60000 - 5 * 3600000 GROUP BY tick_ms, video)
SELECT {_ts('tick_ms')} AS tick, video, n, row_number() OVER (ORDER BY n DESC, video DESC) AS rank FROM tr""",
    "footer_offsets": f"""WITH {MSGS}
SELECT topic, part, CAST(until_off AS BIGINT) AS until_off FROM latest""",
    "planned_read": f"""WITH {MSGS}
SELECT m.topic, m.partition, m."offset", m.metric, {_ts('m.ts_ms')} AS log_date,
       m.topic || '-' || CAST(m.partition AS VARCHAR) || '-' || CAST(m."offset" AS VARCHAR) AS msg_id
FROM msgs m JOIN plan p ON m.topic = p.topic AND m.partition = p.part
  AND m."offset" >= p.from_off AND m."offset" < p.until_off""",
    "sketch_users": f"""WITH {EV}, grains AS (SELECT unnest(['6 minutes', 'hour', 'day']) AS grain, unnest([360000, 3600000, 86400000]) AS ms)
SELECT grain, {_ts('(ts_ms // ms) * ms')} AS period, count(DISTINCT uid) AS users, true AS close
FROM ev, grains WHERE metric = 'pageview' GROUP BY grain, ms, ts_ms // ms""",
    "key_lookup": f"""WITH {EV}
SELECT {_ts('(ts_ms // 60000) * 60000')} AS bucket, video, count(*) AS n
FROM ev WHERE metric = 'pageview' AND video = (SELECT min(video) FROM ev WHERE metric = 'pageview')
GROUP BY ts_ms // 60000, video""",
    "variant_fields": f"""WITH {MSGS}
SELECT metric, topic || '-' || CAST(partition AS VARCHAR) || '-' || CAST("offset" AS VARCHAR) AS msg_id,
       json_extract_string(value, '$.video') AS video, json_extract_string(value, '$.viewer') AS viewer, ts_ms AS sent_ms
FROM msgs""",
    "progress_rows": f"""WITH {EV}
SELECT 'log_parquet' AS "query", count(*) AS input_rows, count(*) AS "rows",
       count(*) FILTER (event_id % {CORRUPT_EVERY} = 0) AS rejected, CAST(0 AS BIGINT) AS dropped_late FROM ev""",
}
