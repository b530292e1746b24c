"""Fixed values the metrics must share with the original job.

These are behavioural constants (key names, TTLs, horizons, label formats);
every function takes them as overridable parameters.
"""

# --- fixed values -----------------------------------------------------------
# Zone the bucket labels are written and looked up in.
LABEL_TZ = "Asia/Ho_Chi_Minh"
# Bucket label patterns (Spark datetime patterns).
MINUTE_PATTERN = "yyyyMMddHHmm"
HOUR_PATTERN = "yyyyMMddHH"
DATETIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
# Metric names carried by topics `<prefix>-<metric>` and log rows.
METRICS = ("pageview", "click", "order")
# Counter / rank key names and their TTL in seconds.
VIDEO_VIEWS_KEY, VIDEO_VIEWS_TTL = "videoviews", 1800
PAGE_CLICKS_KEY, PAGE_CLICKS_TTL = "pageclicks", 360
ORDERS_KEY, ORDERS_TTL = "orders", 360
TOP_VIDEOS_MINUTE_KEY, TOP_VIDEOS_MINUTE_TTL = "topvideos_m", 18000
TOP_VIDEOS_HOUR_KEY, TOP_VIDEOS_HOUR_TTL = "topvideos_h", 14400
TOP_VIDEOS_KEY = "topvideos"
ACTIVE_USERS_KEY = "activeusers"
ORDER_USERS_KEY = "orderusers"
# Trend: union of the newest TREND_HOURS hour buckets (current included) and
# the minute buckets of the hour TREND_HOURS hours back.
TREND_HOURS = 5
# Active / ordering users: members seen within the last 360000 ms.
LAST_SEEN_HORIZON_MS = 360_000
# Bulk JDBC insert batch size.
JDBC_BATCH_SIZE = 10000
# Log table and offset ledger names.
LOG_TABLE = "log_event"
LEDGER_TABLE = "topic_offsets"
# --- end of fixed values ----------------------------------------------------

# Which counter key each metric increments, with its TTL (seconds).
COUNTER_OF_METRIC = {
    "pageview": (VIDEO_VIEWS_KEY, VIDEO_VIEWS_TTL),
    "click": (PAGE_CLICKS_KEY, PAGE_CLICKS_TTL),
    "order": (ORDERS_KEY, ORDERS_TTL),
}

MINUTE_MS = 60_000
HOUR_MS = 3_600_000
DAY_MS = 86_400_000

# Largest table (rows) this library broadcasts after checking its size bound.
BROADCAST_ROW_LIMIT = 2_000_000

# Keys outside are no event times in epoch ms (1970 to 2100): rejected.
KEY_RANGE_MS = (0, 4_102_444_799_999)
