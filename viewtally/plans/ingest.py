"""Offset-resumed bounded ingestion (STR-9): plan -> check -> read -> save -> commit.

Restartable by construction: the plan starts at the committed offsets, what is
saved is keyed by that start, and the ledger is committed last.  A crash
before the commit re-runs from the same offsets; the re-run may reach further
(messages keep arriving) and then replaces (Parquet) or completes (JDBC) what
the crashed run stored.  ``StagedJdbc`` stores rows and ledger in one
transaction instead.  A commit touches only the rows of its own plan, so
jobs on different topics do not undo each other; ``LogLedger`` and ``StagedJdbc``
also refuse a commit whose plan another run has overtaken.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable, Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from viewtally import schemas as S
from viewtally.functions import parse as P
from viewtally.operators import ledger as L
from viewtally.sinks import jdbc as JS
from viewtally.sinks import parquet as PS
from viewtally.sinks.commit_log import CommitLog, Conflict
from viewtally.sources import jdbc as JR


class LedgerStore(Protocol):
    def read(self, topics: list[str] | None = None) -> DataFrame: ...
    def write(self, ledger: DataFrame) -> None: ...


class LedgerConflict(L.LedgerError):
    """Another run committed the same topic partition first."""


def expected_offsets(plan: list) -> dict[tuple[str, int], int | None]:
    """What the ledger must still hold when a plan is committed (None: no row)."""
    return {(r["topic"], r["part"]): r["from_off"] if r["in_ledger"] else None for r in plan}


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


@dataclass
class ParquetLedger:
    """Ledger as Parquet folders ``topic=<t>/version=<n>``; a topic's newest
    version wins.  A read error is an error, only a missing folder is empty."""
    spark: SparkSession
    root: str

    def _versions(self) -> DataFrame | None:
        if not path_exists(self.spark, self.root):
            return None
        schema = "part int, off bigint, topic string, version int"
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(self.root)

    def read(self, topics: list[str] | None = None) -> DataFrame:
        df = self._versions()
        if df is None:
            return self.spark.createDataFrame([], S.LEDGER)
        df = df.where(F.col("topic").isin(*topics)) if topics else df
        newest = df.groupBy("topic").agg(F.max("version").alias("version"))
        return df.join(F.broadcast(newest), ["topic", "version"]).select("topic", "part", "off")

    def write(self, ledger: DataFrame) -> None:
        """Set the rows of ``ledger``; other rows of its topics stay, other
        topics are not touched.  Two jobs that commit one topic at once ask
        for the same version: the second fails instead of undoing the first."""
        rows = ledger.collect()     # one row per topic partition
        old = self.read().collect()
        df = self._versions()
        last = {} if df is None else {r["topic"]: r["v"] for r in
                                      df.groupBy("topic").agg(F.max("version").alias("v")).collect()}
        for topic in sorted({r["topic"] for r in rows}):
            offs = {r["part"]: r["off"] for r in old if r["topic"] == topic}
            offs |= {r["part"]: r["off"] for r in rows if r["topic"] == topic}
            (self.spark.createDataFrame(sorted(offs.items()), "part int, off bigint").coalesce(1)
             .write.mode("errorifexists").parquet(f"{self.root}/topic={topic}/version={last.get(topic, 0) + 1}"))


@dataclass
class LogLedger:
    """Ledger as a commit log: every commit publishes a whole new version, and
    of two commits that build on the same version one fails.  The loser tries
    again on the winner's version unless that moved one of its own partitions.
    A folder that ``ParquetLedger`` wrote is read as version 0."""
    spark: SparkSession
    root: str

    def _now(self) -> tuple[int, dict[tuple[str, int], int]]:
        version, rows = CommitLog(self.spark, f"{self.root.rstrip('/')}/log").newest()
        if not version and path_exists(self.spark, self.root):
            old = ParquetLedger(self.spark, self.root)
            if any(n.startswith("topic=") for n in _names(self.spark, self.root)):
                rows = [r.asDict() for r in old.read().collect()]
        return version, {(r["topic"], r["part"]): r["off"] for r in rows}

    def read(self, topics: list[str] | None = None) -> DataFrame:
        rows = [(t, p, o) for (t, p), o in sorted(self._now()[1].items()) if not topics or t in topics]
        return self.spark.createDataFrame(rows, S.LEDGER)

    def write(self, ledger: DataFrame, plan: list | None = None) -> None:
        """Set the rows of ``ledger``, all others stay.  With ``plan`` each of its
        partitions must still be where the plan started."""
        new = {(r["topic"], r["part"]): r["off"] for r in ledger.collect()}   # one row per topic partition
        log = CommitLog(self.spark, f"{self.root.rstrip('/')}/log")
        started = expected_offsets(plan or [])
        while True:
            version, now = self._now()
            moved = {k: now.get(k) for k, off in started.items() if now.get(k) != off}
            if moved:
                raise LedgerConflict(f"committed by another run: {moved}, the plan started at "
                                     f"{ {k: started[k] for k in moved} }")
            merged = sorted((now | new).items())
            try:
                log.publish(version + 1, [{"topic": t, "part": p, "off": o} for (t, p), o in merged])
                return
            except Conflict:
                continue    # on the version that won


def _names(spark: SparkSession, path: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [f.getPath().getName() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]


@dataclass
class JdbcLedger:
    spark: SparkSession
    url: str
    table: str
    props: dict | None = None

    def read(self, topics: list[str] | None = None) -> DataFrame:
        return JR.read_ledger(self.spark, self.url, self.table, topics, self.props)

    def write(self, ledger: DataFrame) -> None:
        """Set the rows of ``ledger`` in one transaction; no other row changes."""
        JS.upsert_offsets(self.spark, ledger.collect(), self.url, self.table, self.props)


@dataclass
class IngestResult:
    plan: list
    rows_written: int       # measured while saving
    rows_rejected: int
    rows_expected: int      # widths of the planned ranges


def parquet_sink(root: str) -> Callable[[DataFrame, list], None]:
    """One folder per (topic, part, first offset): a re-run from the same
    offset replaces it, also when it reaches further."""
    def save(rows: DataFrame, plan: list) -> None:
        keys = ["topic", "partition", "from_off", "metric", "log_day"]
        (PS.with_log_day(rows).hint("rebalance", *keys).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(root))
    return save


def jdbc_sink(spark: SparkSession, url: str, table: str, props: dict | None = None,
              num_partitions: int | None = None) -> Callable[[DataFrame, list], None]:
    def save(rows: DataFrame, plan: list) -> None:
        # only rows of this run's ranges can collide: read back just those
        # (one predicate per topic partition, pushed to the database)
        ranges = [(F.col("topic") == r["topic"]) & (F.col("partition") == r["part"])
                  & (F.col("offset") >= r["from_off"]) & (F.col("offset") < r["until_off"])
                  for r in plan if r["until_off"] > r["from_off"]]
        if not ranges:
            return
        JS.append_new(spark, rows.drop("from_off"), url, table, props=props, num_partitions=num_partitions,
                      stored_filter=reduce(lambda a, b: a | b, ranges),
                      column_types=JS.LOG_COLUMN_TYPES)
    return save


class StagedJdbc:
    """STR-9 / SNK-3 / SNK-6 over JDBC with rows and ledger in one transaction.

    Executors fill a staging table of the run's own, each task over its own
    connection.  ``write`` then, over one connection of the driver, moves the
    ledger rows from where the plan started to where it ends, copies the staged
    rows by one ``INSERT ... SELECT`` and commits both.  A crash before the commit
    leaves neither; of two runs over the same offsets the second finds the ledger
    moved and gets ``LedgerConflict``.  A task that ran twice staged its rows
    twice: the copy takes one of each message id.

    Use it as ledger and sink of a run: ``run(spark, msgs, store, store.save)``.
    """

    def __init__(self, spark: SparkSession, url: str, table: str, ledger_table: str, props: dict | None = None,
                 num_partitions: int | None = None, keep_hours: float = 24):
        self.spark, self.url, self.table, self.ledger_table = spark, url, table, ledger_table
        self.props, self.num_partitions, self.keep_hours = props, num_partitions, keep_hours
        self.stage: str | None = None

    def read(self, topics: list[str] | None = None) -> DataFrame:
        return JR.read_ledger(self.spark, self.url, self.ledger_table, topics, self.props)

    def save(self, rows: DataFrame, plan: list) -> None:
        JS.drop_stale(self.spark, self.url, self.table, self.keep_hours, self.props)
        rows = rows.drop("from_off")
        JS.ensure_log_table(self.spark, rows, self.url, self.table, self.props)
        self.stage = JS.stage_name(self.table)
        JS.append(JS.with_copy(rows), self.url, self.stage, self.props, num_partitions=self.num_partitions,
                  column_types=f"{JS.LOG_COLUMN_TYPES}, copy VARCHAR(36)")

    def write(self, ledger: DataFrame, plan: list) -> None:
        new = {(r["topic"], r["part"]): r["off"] for r in ledger.collect()}   # one row per topic partition
        started = expected_offsets(plan)
        stage, self.stage = self.stage, None
        try:
            with JS.transaction(self.spark, self.url, self.props) as con:
                for key, off in sorted(new.items()):    # one order: two runs can't wait for each other
                    if not JS.move_offset(con, self.ledger_table, *key, started.get(key), off):
                        raise LedgerConflict(f"{key} is not at {started.get(key)} any more")
                if stage:
                    self.merge(con, stage)
        finally:
            if stage:
                JS.drop(self.spark, self.url, stage, self.props)

    def merge(self, con, stage: str) -> int:
        """Copy the staged rows inside the open transaction."""
        return JS.merge_staged(con, stage, self.table)


def run(spark: SparkSession, messages: DataFrame | None, ledger: LedgerStore,
        save: Callable[[DataFrame, list], None], topics: list[str] | None = None,
        bootstrap: bool = False, latest: DataFrame | None = None,
        save_rejects: Callable[[DataFrame, list], None] | None = None, strict: bool = False,
        dense: bool = False, read: Callable[[list], DataFrame] | None = None) -> IngestResult:
    """One ingestion run over a Kafka-shaped ``messages`` table, or over what
    ``read`` gives for the plan's ranges (then ``latest`` is needed).

    ``latest`` defaults to the newest offsets found in ``messages``; pass the
    broker's view (``sources.kafka.read_latest``) in production.  The plan is
    checked before anything is written (negative or backwards ranges, missing
    ledger rows without ``bootstrap``).

    Messages that can't be stored go to ``save_rejects``; without it, or with
    ``strict``, the first of them fails the run before the commit.  Rows are
    counted while they are saved; ``dense`` (a topic without compaction or
    expired offsets) fails the run if they are fewer than the ranges hold.
    """
    msgs = messages.where(F.col("topic").isin(*topics)) if topics and messages is not None else messages
    latest = latest if latest is not None else L.latest_offsets(msgs)
    old = ledger.read(topics)
    plan_df = L.offset_plan(latest, old)
    plan = L.check_plan(plan_df, bootstrap)
    if not plan:
        return IngestResult(plan, 0, 0, 0)
    plan_small = spark.createDataFrame(plan, plan_df.schema)   # one row per partition
    sel = read(plan) if read else L.select_range(msgs, plan_small)
    starts = F.broadcast(plan_small.select("topic", F.col("part").alias("partition"), "from_off"))
    rows = P.checked_log_rows(sel, strict or save_rejects is None).join(starts, ["topic", "partition"])
    stored, rejected = Observation(), Observation()
    # (coalesce keeps the strict reason's error in the plan)
    good = rows.where(F.coalesce("reject_reason", F.lit("")) == "").drop("reject_reason", "key")
    expected = sum(r["until_off"] - r["from_off"] for r in plan)
    written = n_rejected = 0
    if expected:
        save(good.observe(stored, F.count(F.lit(1)).alias("n")), plan)
        written = stored.get["n"]
    if expected and save_rejects is not None and not strict:
        bad = rows.where(F.col("reject_reason").isNotNull()).select(
            F.col("reject_reason").alias("reason"), "topic", "partition", "offset", "from_off", "key",
            F.col("data").alias("value"))
        save_rejects(bad.observe(rejected, F.count(F.lit(1)).alias("n")), plan)
        n_rejected = rejected.get["n"]
    if dense and written + n_rejected != expected:
        raise L.LedgerError(f"{written + n_rejected} messages read, the ranges hold {expected}")
    base = L.bootstrap(old, plan_small) if bootstrap else old
    planned = plan_small.select("topic", "part")
    committed = L.commit(base, plan_small, require_existing=True).join(planned, ["topic", "part"], "left_semi")
    if isinstance(ledger, (LogLedger, StagedJdbc)):     # these compare before they set
        ledger.write(committed, plan)
    else:
        ledger.write(committed)
    return IngestResult(plan, written, n_rejected, expected)


def parquet_rejects(root: str) -> Callable[[DataFrame, list], None]:
    """Rejected messages as Parquet, replaced like the rows themselves."""
    def save(rows: DataFrame, plan: list) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("topic", "partition", "from_off").parquet(root))
    return save
