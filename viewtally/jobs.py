"""Command-line jobs (``python -m viewtally.jobs <job> ...``), the Spark
counterparts of the original applications:

- ``metrics``  live counters, tiers, trend and active users (streaming)
- ``store``    raw-log storage stream to day-partitioned Parquet or JDBC
- ``ingest``   bounded, ledger-resumed ingestion of message ranges
- ``backfill`` every metric table from a message table in one batch job

Messages come from Kafka (``--brokers``/``--prefix``; needs the Kafka
connector on the classpath) or from JSON-lines / Parquet files with the
message schema (``--input``), which is how the tests drive them.  The
session is the caller's (``spark-submit`` sets master, resources and
``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtally import config as C
from viewtally import schemas as S
from viewtally.functions.parse import topics_for
from viewtally.sources import kafka as KF
from viewtally.sources import log as LG
from viewtally.sources import messages as M


def _trigger(args) -> dict:
    if args.once:
        return {"availableNow": True}
    return {"processingTime": f"{args.batch_seconds} seconds"}


def _stream(spark: SparkSession, args) -> DataFrame:
    if args.input:
        return M.message_file_stream(spark, args.input, args.max_files_per_trigger)
    return KF.read_stream(spark, args.brokers, args.prefix)


def _table(spark: SparkSession, args) -> DataFrame:
    kind = args.format or ("parquet" if args.input.rstrip("/").endswith(".parquet") else "json")
    if kind == "parquet":
        return spark.read.parquet(args.input)
    return spark.read.schema(S.MESSAGE).json(args.input)


def job_metrics(spark: SparkSession, args) -> list:
    from viewtally.streaming import keyed as KD
    from viewtally.streaming import metrics as SM
    from viewtally.streaming import running as RT
    from viewtally.streaming import sketches as SK
    from viewtally.streaming.progress import ProgressTable, pool
    kw = dict(clock=args.clock, trend_mode=args.trend_mode, tz=args.tz, files=args.table_files,
              compact_every=args.compact_every)
    # by the wall clock a timer publishes, so an idle stream still moves on
    timer = args.clock == "processing" and not args.once
    if args.progress:
        spark.streams.addListener(ProgressTable(spark, args.progress))
    if args.direct:
        queries = SM.start(_stream(spark, args), args.out, args.checkpoint, _trigger(args), publish=not timer,
                           strict=args.strict, **kw).all()
    else:
        # parse once into compact Parquet; the four aggregations read that
        stage_dir = args.stage or f"{args.out.rstrip('/')}/_staged"
        stage = SM.start_staging(_stream(spark, args), stage_dir, args.checkpoint, _trigger(args), args.strict)
        if args.once:
            stage.processAllAvailable()
        queries = [stage] + SM.start(None, args.out, args.checkpoint, _trigger(args), publish=not timer,
                                     events=SM.staged_events(spark, stage_dir), stage_dir=stage_dir, **kw).all()
        events = SM.staged_events(spark, stage_dir)
        more = {"trend": lambda: RT.start(events, args.out, args.checkpoint, _trigger(args), args.clock, args.compact_every),
                "sketches": lambda: SK.start(events, args.out, args.checkpoint, _trigger(args), files=args.table_files),
                "active": lambda: KD.start_active_users(events, args.out, args.checkpoint, _trigger(args),
                                                        event_time=args.clock == "event")}
        for name in args.also:
            with pool(spark, name):
                queries.append(more[name]())
    if timer:
        queries.append(SM.start_ticker(spark, args.out, args.checkpoint, args.batch_seconds, args.trend_mode, args.tz))
    return queries


def job_store(spark: SparkSession, args) -> list:
    from viewtally.streaming import storage as SS
    msgs = _stream(spark, args)
    if args.jdbc_url:
        props = dict(p.split("=", 1) for p in args.jdbc_prop)
        return [SS.start_jdbc(msgs, args.jdbc_url, args.table, args.checkpoint, props, _trigger(args),
                              args.rejects, args.strict)]
    if args.typed:
        return [SS.start_typed_parquet(msgs, args.out, args.checkpoint, _trigger(args), args.files, args.rejects,
                                       args.strict)]
    return [SS.start_parquet(msgs, args.out, args.checkpoint, _trigger(args), args.files, args.rejects, args.strict,
                             args.variant)]


def job_ingest(spark: SparkSession, args):
    from viewtally.plans import ingest as I
    props = dict(p.split("=", 1) for p in args.jdbc_prop)
    if args.jdbc_url:
        ledger = I.StagedJdbc(spark, args.jdbc_url, args.table, args.ledger_table, props, args.num_partitions)
        sink = ledger.save
    else:
        ledger = I.LogLedger(spark, args.ledger)
        sink = I.parquet_sink(args.out)
    topics = topics_for(args.prefix, [args.metric] if args.metric else C.METRICS)
    msgs = latest = read = None
    if args.input and args.format == "log":
        latest = LG.latest_offsets(spark, args.input, topics)
        read = lambda plan: LG.read_ranges(spark, args.input, plan)
    elif args.input:
        msgs = _table(spark, args)
    else:
        # one plan from the broker's offsets and the ledger, then just its ranges
        latest = KF.read_latest(spark, args.brokers, topics)
        read = lambda plan: KF.read_ranges(spark, args.brokers, plan)
    rejects = args.rejects or (f"{args.out.rstrip('/')}_rejects" if args.out else None)
    return I.run(spark, msgs, ledger, sink, topics=topics, bootstrap=args.bootstrap, strict=args.strict,
                 dense=args.dense, save_rejects=I.parquet_rejects(rejects) if rejects else None, latest=latest, read=read)


def job_backfill(spark: SparkSession, args):
    from viewtally.plans import backfill as B
    days = (args.from_day, args.to_day) if args.from_day and args.to_day else None
    spec = B.BackfillSpec(trend_mode=args.trend_mode, top_k=args.top_k, days=days)
    return B.run(spark, _table(spark, args), args.out, spec, strict=args.strict)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="viewtally.jobs")
    sub = p.add_subparsers(dest="job", required=True)

    def source(sp):
        sp.add_argument("--brokers")
        sp.add_argument("--prefix", default="prod")
        sp.add_argument("--input", help="message files instead of Kafka")
        sp.add_argument("--max-files-per-trigger", type=int, default=1)
        sp.add_argument("--batch-seconds", type=int, default=60)
        sp.add_argument("--once", action="store_true", help="process what is there, then stop")
        sp.add_argument("--checkpoint", required=True)

    m = sub.add_parser("metrics")
    source(m)
    m.add_argument("--out", required=True)
    m.add_argument("--clock", choices=["processing", "event"], default="processing")
    m.add_argument("--trend-mode", choices=["exact", "ttl"], default="exact")
    m.add_argument("--stage", help="folder for parsed compact events and rejects (default: <out>/_staged)")
    m.add_argument("--direct", action="store_true", help="no staging: each query parses the messages, rejects are dropped")
    m.add_argument("--also", action="append", default=[], choices=["trend", "sketches", "active"],
                   help="further tables from the staged stream: running trend, user sketches, active set by timers")
    m.add_argument("--progress", help="folder for one row per query and batch")
    m.add_argument("--strict", action="store_true", help="fail on the first bad message")
    m.add_argument("--tz", default=C.LABEL_TZ, help="zone of the hour buckets")
    m.add_argument("--table-files", type=int, default=4, help="files of a table's day in one batch")
    m.add_argument("--compact-every", type=int, default=60, help="batches between two compactions")

    s = sub.add_parser("store")
    source(s)
    s.add_argument("--out")
    s.add_argument("--files", type=int, help="files of a batch (default: by size)")
    s.add_argument("--typed", action="store_true", help="JSON fields as columns (Parquet only)")
    s.add_argument("--variant", action="store_true", help="JSON as a variant column (Parquet only)")
    s.add_argument("--rejects", help="Parquet folder of rejected messages")
    s.add_argument("--strict", action="store_true", help="fail on the first bad message")
    s.add_argument("--jdbc-url")
    s.add_argument("--jdbc-prop", action="append", default=[], help="key=value")
    s.add_argument("--table", default=C.LOG_TABLE)

    i = sub.add_parser("ingest")
    i.add_argument("--brokers")
    i.add_argument("--prefix", default="prod")
    i.add_argument("--metric", choices=list(C.METRICS))
    i.add_argument("--input", help="message table instead of Kafka")
    i.add_argument("--format", choices=["parquet", "json", "log"],
                   help="of --input (default: by its ending); log: Parquet laid out by topic and partition")
    i.add_argument("--rejects", help="Parquet folder of rejected messages (default: beside --out)")
    i.add_argument("--strict", action="store_true", help="fail on the first bad message")
    i.add_argument("--dense", action="store_true", help="fail if fewer messages are read than planned")
    i.add_argument("--ledger", help="Parquet ledger folder")
    i.add_argument("--out", help="Parquet log folder")
    i.add_argument("--jdbc-url")
    i.add_argument("--jdbc-prop", action="append", default=[], help="key=value")
    i.add_argument("--table", default=C.LOG_TABLE)
    i.add_argument("--ledger-table", default=C.LEDGER_TABLE)
    i.add_argument("--num-partitions", type=int)
    i.add_argument("--bootstrap", action="store_true")

    b = sub.add_parser("backfill")
    b.add_argument("--input", required=True, help="message table (Parquet or JSON lines)")
    b.add_argument("--out", required=True)
    b.add_argument("--format", choices=["parquet", "json"], help="of --input (default: by its ending)")
    b.add_argument("--strict", action="store_true", help="fail on the first bad message")
    b.add_argument("--trend-mode", choices=["exact", "ttl"], default="exact")
    b.add_argument("--top-k", type=int, default=10)
    b.add_argument("--from-day", help="first UTC day (ISO date); with --to-day only those days are read and written")
    b.add_argument("--to-day", help="last UTC day (ISO date), inclusive")
    return p


JOBS = {"metrics": job_metrics, "store": job_store, "ingest": job_ingest, "backfill": job_backfill}


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = parser().parse_args(argv)
    spark = spark or (SparkSession.builder.appName(f"viewtally-{args.job}")
                      .config("spark.scheduler.mode", "FAIR").getOrCreate())
    result = JOBS[args.job](spark, args)
    if args.job in ("metrics", "store") and not args.once:
        spark.streams.awaitAnyTermination()
    elif args.job in ("metrics", "store"):
        for q in result:
            q.processAllAvailable()
            q.stop()
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
