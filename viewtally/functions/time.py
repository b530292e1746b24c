"""Time helpers as JVM column expressions (PRJ-6, 7, 8, 9, 11, 12, 13).

Event time is an epoch-millisecond ``bigint``.  Conversions go through
``TIMESTAMP_NTZ`` holding the UTC wall clock, which keeps every expression
independent of ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

import time

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewtally import config as C

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit_ms(x) -> Column:
    return F.lit(x).cast("bigint") if isinstance(x, int) else _c(x)


def ms_to_ntz(ms) -> Column:
    """Epoch ms -> UTC wall clock as TIMESTAMP_NTZ (millisecond precision)."""
    return F.timestamp_add("MILLISECOND", _lit_ms(ms), F.expr(_EPOCH_NTZ))


def ntz_to_ms(ts) -> Column:
    """UTC wall clock TIMESTAMP_NTZ -> epoch ms (floor for times after 1970)."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), _c(ts))


def ms_to_instant(ms) -> Column:
    """Epoch ms -> TIMESTAMP (an instant); needed by watermarks and windows."""
    return F.timestamp_millis(_lit_ms(ms))


def key_to_ms(key) -> Column:
    """Message key (epoch ms as text) -> bigint (PRJ-9)."""
    return _c(key).try_cast("bigint")


def local_wall(ms, tz: str = C.LABEL_TZ) -> Column:
    """Wall clock of the instant in zone ``tz`` as TIMESTAMP_NTZ."""
    utc = ms_to_ntz(ms)
    return utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def local_offset_ms(ms, tz: str = C.LABEL_TZ) -> Column:
    """Zone offset (ms) at the instant."""
    if tz == "UTC":
        return F.lit(0).cast("bigint")
    return ntz_to_ms(local_wall(ms, tz)) - _lit_ms(ms)


def floor_ms(ms, unit_ms: int) -> Column:
    m = _lit_ms(ms)
    return m - F.pmod(m, F.lit(unit_ms).cast("bigint"))


def minute_start(ms) -> Column:
    """Start of the minute (zones have whole-minute offsets)."""
    return floor_ms(ms, C.MINUTE_MS)


def fixed_offset_ms(tz: str, lo_ms: int, hi_ms: int) -> int | None:
    """The zone's UTC offset if it is the same all through ``[lo_ms, hi_ms]``
    (sampled daily: offset changes are months apart), else None."""
    from datetime import datetime, timezone
    from zoneinfo import ZoneInfo
    zone = ZoneInfo(tz)
    seen = set()
    for t in range(lo_ms, hi_ms + C.DAY_MS, C.DAY_MS):
        t = min(t, hi_ms)
        off = datetime.fromtimestamp(t / 1000, tz=timezone.utc).astimezone(zone).utcoffset()
        seen.add(int(off.total_seconds() * 1000))
        if len(seen) > 1:
            return None
    return seen.pop() if seen else None


def hour_start(ms, tz: str = C.LABEL_TZ, fixed_offset: int | None = None) -> Column:
    """Start (epoch ms) of the hour in zone ``tz`` that holds the instant.

    ``fixed_offset`` (from ``fixed_offset_ms`` over the data's span) turns the
    per-row zone lookup into integer arithmetic."""
    m = _lit_ms(ms)
    if tz == "UTC":
        return floor_ms(m, C.HOUR_MS)
    off = F.lit(fixed_offset).cast("bigint") if fixed_offset is not None else local_offset_ms(m, tz)
    return m - F.pmod(m + off, F.lit(C.HOUR_MS).cast("bigint"))


def day_start(ms, tz: str = "UTC") -> Column:
    m = _lit_ms(ms)
    if tz == "UTC":
        return floor_ms(m, C.DAY_MS)
    return m - F.pmod(m + local_offset_ms(m, tz), F.lit(C.DAY_MS).cast("bigint"))


def format_ms(ms, pattern: str = C.DATETIME_PATTERN, tz: str = C.LABEL_TZ) -> Column:
    """Epoch ms -> text in zone ``tz`` (PRJ-6)."""
    return F.date_format(local_wall(ms, tz), pattern)


def minute_label(ms, tz: str = C.LABEL_TZ) -> Column:
    """``yyyyMMddHHmm`` label of the minute bucket (PRJ-7)."""
    return format_ms(ms, C.MINUTE_PATTERN, tz)


def hour_label(ms, tz: str = C.LABEL_TZ) -> Column:
    """``yyyyMMddHH`` label of the hour bucket (PRJ-7)."""
    return format_ms(ms, C.HOUR_PATTERN, tz)


def bucket_key(name: str, label) -> Column:
    """``<name>:<label>`` (PRJ-8)."""
    return F.concat_ws(":", F.lit(name), _c(label))


def safe_sequence(lo, hi, step_ms: int) -> Column:
    """``sequence(lo, hi, step)`` that is NULL (explodes to nothing) when lo > hi."""
    lo, hi = _lit_ms(lo), _lit_ms(hi)
    return F.when(lo <= hi, F.sequence(lo, hi, F.lit(step_ms).cast("bigint")))


def hour_list_before(ms, num: int, tz: str = C.LABEL_TZ) -> Column:
    """Labels of the last ``num`` hours up to and including now, oldest first (PRJ-11)."""
    m = _lit_ms(ms)
    arr = F.sequence(m - F.lit((num - 1) * C.HOUR_MS).cast("bigint"), m,
                     F.lit(C.HOUR_MS).cast("bigint"))
    return F.transform(arr, lambda x: hour_label(x, tz))


def minute_list_before(ms, num: int, tz: str = C.LABEL_TZ) -> Column:
    """Labels of the last ``num`` minutes up to and including now, oldest first (PRJ-12)."""
    m = _lit_ms(ms)
    arr = F.sequence(m - F.lit((num - 1) * C.MINUTE_MS).cast("bigint"), m,
                     F.lit(C.MINUTE_MS).cast("bigint"))
    return F.transform(arr, lambda x: minute_label(x, tz))


def minute_list_of_hour_ago(ms, hour_ago: int, tz: str = C.LABEL_TZ) -> Column:
    """Minute labels from ``now - hour_ago h`` to minute 59 of that hour, newest first (PRJ-13)."""
    start = minute_start(_lit_ms(ms) - F.lit(hour_ago * C.HOUR_MS).cast("bigint"))
    last = hour_start(start, tz) + F.lit(C.HOUR_MS - C.MINUTE_MS).cast("bigint")
    arr = F.sequence(last, start, F.lit(-C.MINUTE_MS).cast("bigint"))
    return F.transform(arr, lambda x: minute_label(x, tz))


def now_ms() -> int:
    """The driver's wall clock."""
    return int(time.time() * 1000)
