"""Active and ordering users (AGG-7, AGG-8, AGG-10, STR-5, STR-6).

The key store keeps ``uid -> last seen`` and drops members whose score is at
or before ``now - 6 min``.  As tables: the last-seen set at tick ``t`` holds
the users with an event in ``(t - horizon, t]``, score = their newest event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtally import config as C
from viewtally.functions import time as tm
from viewtally.operators.ticks import TickGrid


def last_seen(events: DataFrame) -> DataFrame:
    """AGG-7 / AGG-8 as a table: ``uid, last_ms`` over all given events.

    The newest event time wins.  (An overwriting ``zadd`` keeps the last
    arrival instead; offsets of different partitions have no such order.)
    """
    return events.where(F.col("uid").isNotNull()).groupBy("uid").agg(F.max("ts_ms").alias("last_ms"))


def users_at_ticks(events: DataFrame, grid: TickGrid,
                   horizon_ms: int = C.LAST_SEEN_HORIZON_MS) -> DataFrame:
    """AGG-7 + STR-5 backfill: ``tick_ms, uid, last_ms`` for every tick.

    Events combine first per (uid, first tick they reach); each combined row
    then reaches the ticks ``[first tick, newest + horizon)`` — at most
    ``horizon / step + 1`` of them — and the max per (tick, uid) is taken.  A
    user holding a third of all events costs one partial row per map task.
    """
    ev = events.where(F.col("uid").isNotNull())
    firsts = (ev.groupBy("uid", grid.first_at_or_after("ts_ms").alias("ft"))
              .agg(F.max("ts_ms").alias("lw")))
    spread = firsts.select(
        "uid", "lw",
        F.explode(grid.ticks_in(F.col("ft"), F.col("lw") + F.lit(horizon_ms).cast("bigint")))
        .alias("tick_ms"))
    return spread.groupBy("tick_ms", "uid").agg(F.max("lw").alias("last_ms"))


def present_users(df: DataFrame) -> DataFrame:
    return df.select(tm.ms_to_ntz("tick_ms").alias("tick"), "uid",
                     tm.ms_to_ntz("last_ms").alias("last_seen"))


def _score_bound(spec: str, is_lo: bool) -> tuple[Column | None, bool]:
    """Redis score bound: ``-inf``/``+inf``, ``(x`` exclusive, ``x`` inclusive."""
    if spec in ("-inf", "+inf", "inf"):
        return None, True
    if spec.startswith("("):
        return F.lit(float(spec[1:])), False
    return F.lit(float(spec)), True


def expire_by_score(members: DataFrame, lo: str, hi: str, score: str = "last_ms") -> DataFrame:
    """STR-5: drop members with ``lo <= score <= hi`` (Redis range syntax)."""
    cond = F.lit(True)
    s = F.col(score).cast("double")
    lo_v, lo_inc = _score_bound(lo, True)
    hi_v, hi_inc = _score_bound(hi, False)
    if lo_v is not None:
        cond = cond & ((s >= lo_v) if lo_inc else (s > lo_v))
    if hi_v is not None:
        cond = cond & ((s <= hi_v) if hi_inc else (s < hi_v))
    return members.where(~cond | s.isNull())


def purge_before(members: DataFrame, now_ms: int | Column,
                 horizon_ms: int = C.LAST_SEEN_HORIZON_MS, score: str = "last_ms") -> DataFrame:
    """STR-5 as the live job calls it: drop scores in ``[0, now - horizon]``."""
    now = F.lit(now_ms).cast("bigint") if isinstance(now_ms, int) else now_ms
    return members.where(~((F.col(score) >= 0) & (F.col(score) <= now - horizon_ms)))


def _lex_bound(spec: str) -> tuple[str | None, bool]:
    """Redis lex bound: ``-`` / ``+`` open, ``[x`` inclusive, ``(x`` exclusive."""
    if spec in ("-", "+"):
        return None, True
    if spec[:1] == "[":
        return spec[1:], True
    if spec[:1] == "(":
        return spec[1:], False
    raise ValueError(f"invalid lex bound {spec!r}")


def expire_by_lex(members: DataFrame, lo: str, hi: str, member: str = "uid") -> DataFrame:
    """STR-6: drop members whose text lies in the lex range (binary order)."""
    m = F.col(member)
    cond = F.lit(True)
    lo_v, lo_inc = _lex_bound(lo)
    hi_v, hi_inc = _lex_bound(hi)
    if lo == "+" or hi == "-":
        cond = F.lit(False)
    if lo_v is not None:
        cond = cond & ((m >= F.lit(lo_v)) if lo_inc else (m > F.lit(lo_v)))
    if hi_v is not None:
        cond = cond & ((m <= F.lit(hi_v)) if hi_inc else (m < F.lit(hi_v)))
    return members.where(~cond)


def approx_users(events: DataFrame, grain_ms: int = C.DAY_MS) -> DataFrame:
    """AGG-10: approximate distinct users per period through mergeable HLL
    sketches (hourly sketches unioned per period)."""
    hourly = (events.where(F.col("uid").isNotNull())
              .groupBy(tm.floor_ms("ts_ms", C.HOUR_MS).alias("h"))
              .agg(F.hll_sketch_agg("uid").alias("sk")))
    return (hourly.groupBy(tm.floor_ms("h", grain_ms).alias("p"))
            .agg(F.hll_sketch_estimate(F.hll_union_agg("sk")).alias("approx_users"))
            .select(tm.ms_to_ntz("p").alias("period"), "approx_users"))
