"""The sliding trend kept by running sums (STR-3, AGG-6, SET-3).

One stateless query over the events.  Each batch writes its views per (minute,
video) as *cells* and derives the sums of its tick from those of the tick
before:

    sums = previous sums + cells of this batch inside the horizon
                         - cells of the minutes that left it

so a tick opens the previous sums, its own cells and the one or two hours that
the horizon's lower end moved through, not five hours of them.  A batch stores
its tick and bounds in a commit log before anything else depends on them; a replay
repeats them and overwrites its own folders, nothing is added twice.

Cells add up, so merging them must never show a row in two folders: a folder is
named by the batches it holds (``b<first>_<last>``, ``b=<n>_<n>`` as a batch writes
it), counts once it is complete, and hides the folders of the batches inside it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from viewtally import config as C
from viewtally.functions import time as tm
from viewtally.operators.ranking import rank_members
from viewtally.operators.trending import trend_at
from viewtally.sinks import snapshot
from viewtally.sinks.commit_log import CommitLog, Conflict

CELLS = "bucket_ms bigint, video string, n bigint"
SUMS = "video string, n bigint"
FOLDER = re.compile(r"b=?(\d+)_(\d+)")

#: batches whose sums stay readable, and batches between two merges of cells
KEEP, COMPACT_EVERY = 60, 60
#: cells of a batch and hour that one task writes, about
HOUR_ROWS = 2_000_000


@dataclass
class RunningTrend:
    spark: SparkSession
    root: str
    clock: str = "processing"
    compact_every: int = COMPACT_EVERY
    keep: int = KEEP
    horizon_ms: int = C.TREND_HOURS * C.HOUR_MS
    #: folders of cells that the last tick read
    opened: list[str] = field(default_factory=list)

    # ---- the state of a batch: its tick and what it has seen

    def _log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/_batches")

    def states(self) -> dict[int, dict]:
        """The newest batches' states, by batch."""
        log = self._log()
        return {s["batch"]: s for s in (log.load(v)[0] for v in log.versions()[-2:])}

    def _state(self, batch_id: int, seen: int | None) -> tuple[dict, dict | None]:
        """This batch's state, stored on its first attempt, and the one before."""
        states = self.states()
        before = states.get(max((b for b in states if b < batch_id), default=-1))
        if batch_id not in states:
            was = before or {"tick": None, "newest": None}
            newest = max((x for x in (seen, was["newest"]) if x is not None), default=None)
            now = newest if self.clock == "event" else tm.now_ms()
            # a tick never goes back
            tick = max((x for x in (now, was["tick"]) if x is not None), default=None)
            state = {"batch": batch_id, "tick": tick, "newest": newest, "before": before and before["batch"]}
            try:
                self._log().publish((self._log().versions() or [0])[-1] + 1, [state])
            except Conflict:
                raise RuntimeError(f"{self.root} is written by another stream") from None
            return state, before
        return states[batch_id], before

    def _low(self, tick: int) -> int:
        return tick - tick % C.MINUTE_MS - self.horizon_ms

    # ---- cells

    def _folders(self, hour: int, below: int) -> list[str]:
        """Complete folders of an hour's cells, of batches below ``below``,
        without those that a merged one holds."""
        root = f"{self.root}/cells/hour={hour}"
        found = [(int(m[1]), -int(m[2]), n) for n in snapshot.names(self.spark, root) if (m := FOLDER.fullmatch(n))]
        out, end = [], -1
        for lo, hi, name in sorted(found):
            if -hi > end and -hi < below and snapshot.exists(self.spark, f"{root}/{name}/_SUCCESS"):
                out.append(f"{root}/{name}")
                end = -hi
        return out

    def _hours(self, lo: int, hi: int) -> list[int]:
        """Hours on disk that meet [lo, hi)."""
        found = [int(n[5:]) for n in snapshot.names(self.spark, f"{self.root}/cells") if n.startswith("hour=")]
        return [h for h in found if lo < h + C.HOUR_MS and h < hi]

    @staticmethod
    def _of_hours(paths: list[str], lo: int, hi: int) -> list[str]:
        """Folders of the hours that meet [lo, hi)."""
        hour = lambda p: int(p.rsplit("/", 2)[1][5:])
        return [p for p in paths if lo < hour(p) + C.HOUR_MS and hour(p) < hi]

    def _cells(self, lo: int, hi: int, below: int) -> DataFrame:
        """Cells of the minutes [lo, hi) that batches below ``below`` wrote."""
        paths = [p for h in self._hours(lo, hi) for p in self._folders(h, below)]
        self.opened += paths
        if not paths:
            return self.spark.createDataFrame([], CELLS)
        return self.spark.read.schema(CELLS).parquet(*paths).where((F.col("bucket_ms") >= lo) & (F.col("bucket_ms") < hi))

    def _write_cells(self, cells: DataFrame, batch_id: int) -> list[str]:
        """A folder for each hour of the batch, as paths.  One job writes them
        all; each is marked complete when every one of them is in its place."""
        cells = cells.withColumn("hour", F.col("bucket_ms") - F.pmod("bucket_ms", F.lit(C.HOUR_MS)))
        sizes = {r["hour"]: r["count"] for r in cells.groupBy("hour").count().collect()}     # hours a batch reaches
        if not sizes:
            return []
        # an hour of many cells is written by several tasks
        files = F.pmod(F.xxhash64("bucket_ms", "video"), F.lit(1 + max(sizes.values()) // HOUR_ROWS))
        (cells.repartition("hour", files).withColumn("b", F.lit(f"{batch_id}_{batch_id}"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("hour", "b").parquet(f"{self.root}/cells"))
        paths = [f"{self.root}/cells/hour={h}/b={batch_id}_{batch_id}" for h in sorted(sizes)]
        for path in paths:
            snapshot.put_text(self.spark, f"{path}/_SUCCESS", "")
        return paths

    # ---- a batch

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """Take a batch of events (``metric, ts_ms, video``) in."""
        self.opened = []
        views = batch.where(F.col("metric") == "pageview")
        cells = views.groupBy((F.col("ts_ms") - F.pmod("ts_ms", F.lit(C.MINUTE_MS))).alias("bucket_ms"), "video") \
            .agg(F.count(F.lit(1)).alias("n"), F.max("ts_ms").alias("_last")).persist()
        try:
            seen = cells.agg(F.max("_last")).first()[0]
            state, before = self._state(batch_id, seen)
            if state["tick"] is None:       # nothing has arrived yet
                return
            own = self._write_cells(cells.drop("_last"), batch_id)
        finally:
            cells.unpersist()
        low, tick = self._low(state["tick"]), state["tick"]
        own = self._of_hours(own, low, tick + 1)
        self.opened += own
        new = self.spark.read.schema(CELLS).parquet(*own) if own else self.spark.createDataFrame([], CELLS)
        parts = [new.where((F.col("bucket_ms") >= low) & (F.col("bucket_ms") <= tick)).select("video", "n")]
        if before and before["tick"] is not None:
            parts.append(self._sums(before["batch"]))
            was_low, was_tick = self._low(before["tick"]), before["tick"]
            if low > was_low:       # minutes that left; those beyond the old tick were never in
                left = self._cells(was_low, min(low, was_tick + 1), batch_id)
                parts.append(left.select("video", (-F.col("n")).alias("n")))
            if (before["newest"] or 0) > was_tick and tick > was_tick:     # minutes that were ahead of the clock
                parts.append(self._cells(max(low, was_tick + 1), tick + 1, batch_id).select("video", "n"))
        total = parts[0]
        for p in parts[1:]:
            total = total.unionByName(p)
        (total.groupBy("video").agg(F.sum("n").cast("bigint").alias("n")).where("n <> 0")
         .hint("rebalance").write.mode("overwrite").parquet(f"{self.root}/sums/batch_id={batch_id}"))
        self._tidy(batch_id, before)

    def _sums(self, batch_id: int) -> DataFrame:
        return self.spark.read.schema(SUMS).parquet(f"{self.root}/sums/batch_id={batch_id}")

    def _tidy(self, batch_id: int, before: dict | None) -> None:
        """Old sums, hours that no replay can need, and the merge of cells; all
        of batches that are committed."""
        for name in snapshot.names(self.spark, f"{self.root}/sums"):
            if int(name.split("=")[1]) < batch_id - self.keep:
                snapshot.remove(self.spark, f"{self.root}/sums/{name}")
        if not before or before["tick"] is None:
            return
        done = self._low(before["tick"]) - C.HOUR_MS
        for h in self._hours(0, done):
            if h + C.HOUR_MS <= done:
                snapshot.remove(self.spark, f"{self.root}/cells/hour={h}")
        if batch_id and batch_id % self.compact_every == 0:
            self.compact(batch_id)

    def compact(self, below: int) -> None:
        """One folder for each hour's cells of batches below ``below``."""
        for h in self._hours(0, 1 << 62):
            paths = self._folders(h, below)
            if len(paths) > 1:
                ends = [FOLDER.fullmatch(p.rsplit("/", 1)[1]) for p in paths]
                merged = self.spark.read.schema(CELLS).parquet(*paths).groupBy("bucket_ms", "video").agg(F.sum("n").alias("n"))
                (merged.hint("rebalance").write.mode("overwrite")
                 .parquet(f"{self.root}/cells/hour={h}/b{ends[0][1]}_{ends[-1][2]}"))
            # folders that a complete one holds go a merge later, when no reader has them open
            keep = {p.rsplit("/", 1)[1] for p in self._folders(h, below)}
            for name in snapshot.names(self.spark, f"{self.root}/cells/hour={h}"):
                m = FOLDER.fullmatch(name)
                if m and name not in keep and int(m[2]) < below - self.compact_every:
                    snapshot.remove(self.spark, f"{self.root}/cells/hour={h}/{name}")

    # ---- readers

    def trend(self) -> tuple[int | None, DataFrame]:
        """The newest tick and its sums (``video, n``)."""
        done = [s for s in self.states().values() if s["tick"] is not None
                and snapshot.exists(self.spark, f"{self.root}/sums/batch_id={s['batch']}/_SUCCESS")]
        if not done:
            return None, self.spark.createDataFrame([], SUMS)
        newest = max(done, key=lambda s: s["batch"])
        return newest["tick"], self._sums(newest["batch"])

    def ranked(self) -> DataFrame:
        """``tick_ms, video, n, rank`` of the newest tick, every member ranked."""
        tick, sums = self.trend()
        return rank_members(sums.withColumn("tick_ms", F.lit(tick).cast("bigint")).select("tick_ms", "video", "n"))

    def rebuilt(self, below: int) -> DataFrame:
        """The sums of the newest tick from the cells alone (``video, n``)."""
        tick = max(self.states().values(), key=lambda s: s["batch"])["tick"]
        return trend_at(self._cells(self._low(tick), tick + 1, below).withColumn("last_ms", F.col("bucket_ms")), tick)


def start(events: DataFrame, out_root: str, ckpt_root: str, trigger: dict, clock: str = "processing",
          compact_every: int = COMPACT_EVERY, keep: int = KEEP) -> StreamingQuery:
    """Keep the trend (``RunningTrend`` at ``<out_root>/trend``) over a stream of
    events.  By the wall clock a heartbeat gives every trigger a batch, so the
    trend moves on while nothing arrives."""
    spark = events.sparkSession
    rows = events.select("metric", "ts_ms", "video")
    if clock == "processing":
        beat = spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
        rows = rows.unionByName(beat.select(F.lit("heartbeat").alias("metric"), F.unix_millis("timestamp").alias("ts_ms"),
                                            F.lit(None).cast("string").alias("video")))
    root = f"{out_root.rstrip('/')}/trend"

    def sink(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        snapshot.claim(own, root, own.sparkContext.getLocalProperty("sql.streaming.queryId"))
        RunningTrend(own, root, clock, compact_every, keep).update(batch, batch_id)

    return (rows.writeStream.queryName("trend").option("checkpointLocation", f"{ckpt_root.rstrip('/')}/trend")
            .trigger(**trigger).foreachBatch(sink).start())
