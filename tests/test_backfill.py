"""The one-pass backfill writes tables equal to the catalogue queries."""

import os

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001
from viewtally.functions import time as tm
from viewtally.plans import backfill as B
from viewtally.sources import messages as M


def test_backfill_tables_equal_catalogue(spark, tmp):
    msgs = M.messages(spark, SF001, with_offsets=False)
    events = M.read_table(spark, SF001, "events").select(tm.ntz_to_ms("ts").alias("ts_ms"))
    paths = B.run(spark, msgs, os.path.join(tmp, "out"), B.BackfillSpec(top_k=3), grid_from=events)
    q = E.queries()

    trend = spark.read.parquet(paths["topvideos"]).select(
        tm.ms_to_ntz("tick_ms").alias("tick"), "video", "n")
    assert sorted(map(tuple, trend.collect())) == sorted(map(tuple, q["trending_exact"](spark, SF001).collect()))

    top = spark.read.parquet(paths["topvideos_top"]).select(
        tm.ms_to_ntz("tick_ms").alias("tick"), "video", "n", "rank")
    assert sorted(map(tuple, top.collect())) == sorted(map(tuple, q["trending_top_k"](spark, SF001).collect()))

    users = spark.read.parquet(paths["activeusers"]).select(
        tm.ms_to_ntz("tick_ms").alias("tick"), "uid", tm.ms_to_ntz("last_ms").alias("last_seen"))
    assert sorted(map(tuple, users.collect())) == sorted(map(tuple, q["active_users"](spark, SF001).collect()))

    vis = spark.read.parquet(paths["visible_counters"])
    assert vis.count() == q["visible_minute_counters"](spark, SF001).count()
    c = spark.read.parquet(paths["counters"]).where(F.col("metric") == "pageview")
    assert c.count() == q["views_per_minute"](spark, SF001).count()
