"""Every catalogue query against its DuckDB oracle on the smallest scale."""

import decimal
import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from viewtally.plans.catalog import QUERIES
from viewtally.plans.oracle import ORACLE

TABLES = "events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: float(v) if isinstance(v, decimal.Decimal) else v
    lines = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    drows = res.fetchall()
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert canon(rows, df.columns) == canon(drows, dcols)


def test_every_query_has_oracle_or_is_approximate():
    assert set(QUERIES) - set(ORACLE) == {"approx_active_users"}
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["tick", "video", "n", "rank"]
    assert df.count() > 0


def test_approx_users_close_to_exact(spark):
    from pyspark.sql import functions as F
    from viewtally.plans import catalog as CT
    approx = {r.period: r.approx_users for r in CT.approx_active_users(spark, SF001).collect()}
    v = CT._parsed(spark, SF001).where(F.col("metric") == "pageview")
    from viewtally.functions import time as tm
    exact = {r.p: r.n for r in v.groupBy(tm.ms_to_ntz(tm.floor_ms("ts_ms", 86_400_000)).alias("p"))
             .agg(F.countDistinct("uid").alias("n")).collect()}
    assert approx.keys() == exact.keys()
    for k in exact:
        assert abs(approx[k] - exact[k]) <= max(2, 0.05 * exact[k])


@pytest.mark.parametrize("name", ["views_per_minute", "video_views_per_hour", "trending_ttl",
                                  "active_users", "log_rows_per_day", "bounded_read",
                                  "trend_bucket_keys", "batch_counts"])
def test_results_do_not_depend_on_session_zone(spark, con, name):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = QUERIES[name](spark, SF001)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    res = con.execute(ORACLE[name])
    drows = res.fetchall()
    assert canon(rows, df.columns) == canon(drows, [d[0] for d in res.description])
