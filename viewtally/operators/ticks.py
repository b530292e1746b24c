"""Evaluation ticks: a regular grid of instants at which the live job would
have published its metrics (batch ends).

A grid is three integers, so "which ticks can this row reach" is arithmetic
on the row itself: no tick table has to be joined or broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtally import config as C
from viewtally.functions import time as tm


def _b(x: int) -> Column:
    return F.lit(int(x)).cast("bigint")


@dataclass(frozen=True)
class TickGrid:
    """Ticks ``start_ms + i * step_ms`` for ``start_ms <= tick < end_ms``."""

    start_ms: int
    end_ms: int
    step_ms: int

    @property
    def count(self) -> int:
        if self.end_ms <= self.start_ms:
            return 0
        return (self.end_ms - self.start_ms + self.step_ms - 1) // self.step_ms

    @property
    def last_ms(self) -> int:
        return self.start_ms + (self.count - 1) * self.step_ms

    def ceil(self, ms) -> Column:
        """First grid point at or after ``ms`` (unbounded grid)."""
        m = tm._lit_ms(ms)
        return m + F.pmod(_b(self.start_ms) - m, _b(self.step_ms))

    def floor(self, ms) -> Column:
        m = tm._lit_ms(ms)
        return m - F.pmod(m - _b(self.start_ms), _b(self.step_ms))

    def first_at_or_after(self, ms) -> Column:
        """First tick of the grid at or after ``ms``; NULL past the last tick."""
        m = tm._lit_ms(ms)
        c = self.ceil(F.greatest(m, _b(self.start_ms)))
        return F.when(m.isNotNull() & (c < _b(self.end_ms)), c)

    def ticks_in(self, lo, hi_excl) -> Column:
        """Array of the ticks in ``[lo, hi_excl)``, NULL when there is none."""
        lo, hi_excl = tm._lit_ms(lo), tm._lit_ms(hi_excl)
        # greatest/least skip NULLs: a NULL bound must give no ticks
        first = F.when(lo.isNotNull(), self.ceil(F.greatest(lo, _b(self.start_ms))))
        last = F.when(hi_excl.isNotNull(), self.floor(F.least(hi_excl - 1, _b(self.end_ms - 1))))
        return tm.safe_sequence(first, last, self.step_ms)

    def frame(self, spark: SparkSession, col: str = "tick_ms") -> DataFrame:
        """The ticks as a distributed DataFrame (``spark.range``)."""
        return spark.range(self.count).select(
            (_b(self.start_ms) + F.col("id") * _b(self.step_ms)).alias(col))

    @staticmethod
    def for_days(first_day: str, last_day: str, step_ms: int, offset_ms: int = 0) -> "TickGrid":
        """Grid over the UTC days ``first_day .. last_day`` (ISO dates,
        inclusive); no data is read — what a scheduled backfill passes."""
        from datetime import date, datetime, timezone
        lo = int(datetime.combine(date.fromisoformat(first_day), datetime.min.time(),
                                  tzinfo=timezone.utc).timestamp() * 1000)
        hi = int(datetime.combine(date.fromisoformat(last_day), datetime.min.time(),
                                  tzinfo=timezone.utc).timestamp() * 1000) + C.DAY_MS
        return TickGrid(lo + offset_ms, hi, step_ms)

    @staticmethod
    def covering_days(df: DataFrame, ms_col: str, step_ms: int, offset_ms: int = 0) -> "TickGrid":
        """Grid over the whole UTC days the data spans: ticks at
        ``day + offset_ms + i * step_ms``.  One small aggregate job (min/max)."""
        row = df.agg(F.min(ms_col).alias("lo"), F.max(ms_col).alias("hi")).first()
        if row is None or row["lo"] is None:
            return TickGrid(0, 0, step_ms)
        lo = row["lo"] - row["lo"] % C.DAY_MS
        hi = row["hi"] - row["hi"] % C.DAY_MS + C.DAY_MS
        return TickGrid(lo + offset_ms, hi, step_ms)


def hourly_at(minute: int) -> tuple[int, int]:
    """(step, offset) of hourly ticks at ``:minute``."""
    return C.HOUR_MS, minute * C.MINUTE_MS


def every_minutes(n: int) -> tuple[int, int]:
    return n * C.MINUTE_MS, 0
