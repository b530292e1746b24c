"""JDBC sinks (SNK-2, SNK-3): Spark's writer, batched inserts, one connection
per task; an anti-join on the message id makes a retried write idempotent."""

from __future__ import annotations

import re
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtally import config as C
from viewtally.sources.jdbc import read_table

# Text columns of pushed-down filters must not be CLOBs (a topic name has 249
# characters at most); ``data`` is in no filter and has no limit.
LOG_COLUMN_TYPES = "metric VARCHAR(255), msg_id VARCHAR(300), topic VARCHAR(255)"


def append(df: DataFrame, url: str, table: str, props: dict | None = None,
           batchsize: int = C.JDBC_BATCH_SIZE, num_partitions: int | None = None,
           column_types: str | None = None) -> None:
    """SNK-2 / SNK-3: append rows; ``numPartitions`` caps concurrent connections."""
    w = df.write.mode("append").format("jdbc").option("url", url).option("dbtable", table) \
        .option("batchsize", batchsize)
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    for k, v in (props or {}).items():
        w = w.option(k, v)
    w.save()


def append_new(spark: SparkSession, df: DataFrame, url: str, table: str, key: str = "msg_id",
               props: dict | None = None, stored_filter=None, **kw) -> None:
    """Append only rows whose ``key`` is not stored yet (exactly-once on retry).

    ``stored_filter`` (a Column over the stored table, e.g. the topic and
    offset range being written) is pushed to the database so only the keys a
    retry could collide with are read back.
    """
    if not table_exists(spark, url, table, props):
        append(df, url, table, props, **kw)
        return
    stored = read_table(spark, url, table, props)
    if stored_filter is not None:
        stored = stored.where(stored_filter)
    stored = stored.select(F.col(key).alias("__k"))
    new = df.join(stored, df[key] == stored["__k"], "left_anti")
    append(new, url, table, props, **kw)


def _connect(spark: SparkSession, url: str, props: dict | None):
    """A driver-side connection for metadata and the ledger's few rows."""
    jvm = spark._jvm
    conf = jvm.java.util.Properties()
    for k, v in (props or {}).items():
        conf.setProperty(k, str(v))
    if props and "driver" in props:
        jvm.java.lang.Class.forName(props["driver"])
    return jvm.java.sql.DriverManager.getConnection(url, conf)


def table_exists(spark: SparkSession, url: str, table: str, props: dict | None = None) -> bool:
    """Asked of the database; a failing connection or login raises."""
    schema, _, name = table.rpartition(".")
    con = _connect(spark, url, props)
    try:
        meta = con.getMetaData()
        return any(meta.getTables(None, s or None, n, None).next()
                   for n in (name, name.upper(), name.lower()) for s in {schema, schema.upper()})
    finally:
        con.close()


def upsert_offsets(spark: SparkSession, rows: list, url: str, table: str, props: dict | None = None) -> None:
    """Set ``off`` of each (topic, part), inserting what is missing; one
    transaction, no other row is touched.  One row per topic partition."""
    con = _connect(spark, url, props)
    try:
        con.setAutoCommit(False)
        q = con.getMetaData().getIdentifierQuoteString().strip()
        col = {c: f"{q}{c}{q}" for c in ("topic", "part", "off")}
        update = con.prepareStatement(f"UPDATE {table} SET {col['off']} = ? WHERE {col['topic']} = ? AND {col['part']} = ?")
        insert = con.prepareStatement(f"INSERT INTO {table} ({col['off']}, {col['topic']}, {col['part']}) VALUES (?, ?, ?)")
        for r in rows:
            for statement in (update, insert):
                statement.setLong(1, r["off"])
                statement.setString(2, r["topic"])
                statement.setInt(3, r["part"])
                if statement.executeUpdate():
                    break
        con.commit()
    finally:
        con.close()


def _quoted(con, name: str) -> str:
    """A column name as Spark's writer creates it (quoted, case kept)."""
    q = con.getMetaData().getIdentifierQuoteString().strip()
    return f"{q}{name}{q}"


@contextmanager
def transaction(spark: SparkSession, url: str, props: dict | None = None):
    """A driver-side connection whose statements are kept all or none."""
    con = _connect(spark, url, props)
    try:
        con.setAutoCommit(False)
        yield con
        con.commit()
    except BaseException:
        con.rollback()
        raise
    finally:
        con.close()


def execute(spark: SparkSession, url: str, sql: str, props: dict | None = None) -> None:
    with transaction(spark, url, props) as con:
        con.createStatement().execute(sql)


def _count(con, sql: str, *values) -> int:
    """Rows that a statement changes; integers and strings as parameters."""
    statement = con.prepareStatement(sql)
    for i, v in enumerate(values, 1):
        (statement.setString if isinstance(v, str) else statement.setLong)(i, v)
    return statement.executeUpdate()


def ensure_log_table(spark: SparkSession, rows: DataFrame, url: str, table: str, props: dict | None = None) -> None:
    """Create the log table with a unique message id, unless it is there."""
    if table_exists(spark, url, table, props):
        return
    try:
        # (an empty table of that schema: ``rows`` may be observed, and is read once)
        append(spark.createDataFrame([], rows.schema), url, table, props, column_types=LOG_COLUMN_TYPES)
        with transaction(spark, url, props) as con:
            name = table.replace(".", "_")
            con.createStatement().execute(f"CREATE UNIQUE INDEX {name}_msg_id ON {table} ({_quoted(con, 'msg_id')})")
    except Exception:
        if not table_exists(spark, url, table, props):      # else another job made it meanwhile
            raise


def stage_name(table: str) -> str:
    """A staging table of its own for a run: ``<table>_stage_<seconds>_<random>``."""
    return f"{table}_stage_{int(time.time())}_{uuid.uuid4().hex[:8]}"


def with_copy(rows: DataFrame) -> DataFrame:
    """Add ``copy``, another for each time a row is computed, so that the rows
    of a task that ran twice can be told apart."""
    return rows.withColumn("copy", F.reflect(F.lit("java.util.UUID"), F.lit("randomUUID")))


def move_offset(con, table: str, topic: str, part: int, before: int | None, after: int) -> bool:
    """Compare-and-set of one ledger row; ``before`` None: there must be none.
    The row stays locked until the transaction ends."""
    c = {x: _quoted(con, x) for x in ("topic", "part", "off")}
    if before is not None:
        return _count(con, f"UPDATE {table} SET {c['off']} = ? WHERE {c['topic']} = ? AND {c['part']} = ? AND {c['off']} = ?",
                      after, topic, part, before) == 1
    found = con.prepareStatement(f"SELECT 1 FROM {table} WHERE {c['topic']} = ? AND {c['part']} = ?")
    found.setString(1, topic)
    found.setLong(2, part)
    if found.executeQuery().next():
        return False
    return _count(con, f"INSERT INTO {table} ({c['off']}, {c['topic']}, {c['part']}) VALUES (?, ?, ?)",
                  after, topic, part) == 1


def merge_staged(con, stage: str, table: str, key: str = "msg_id") -> int:
    """Copy the rows of ``stage`` that ``table`` lacks, one of each key; all
    inside the database.  Returns their number."""
    info = con.createStatement().executeQuery(f"SELECT * FROM {stage} WHERE 1 = 0").getMetaData()
    names = [info.getColumnName(i) for i in range(1, info.getColumnCount() + 1)]
    cols = ", ".join(_quoted(con, n) for n in names if n.lower() != "copy")
    key, copy = _quoted(con, key), _quoted(con, "copy")
    return _count(con, f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {stage} s "
                       f"WHERE s.{copy} IN (SELECT MIN({copy}) FROM {stage} GROUP BY {key}) "
                       f"AND NOT EXISTS (SELECT 1 FROM {table} t WHERE t.{key} = s.{key})")


def drop(spark: SparkSession, url: str, table: str, props: dict | None = None) -> None:
    if table_exists(spark, url, table, props):
        execute(spark, url, f"DROP TABLE {table}", props)


def stages_of(spark: SparkSession, url: str, table: str, props: dict | None = None) -> dict[str, int]:
    """Staging tables of ``table`` that exist, with the second they were named."""
    schema, _, name = table.rpartition(".")
    pattern = re.compile(re.escape(name) + r"_stage_(\d+)_[0-9a-f]{8}", re.IGNORECASE)
    con = _connect(spark, url, props)
    try:
        found, rows = {}, con.getMetaData().getTables(None, None, "%", None)
        while rows.next():
            m = pattern.fullmatch(rows.getString("TABLE_NAME"))
            if m and (not schema or (rows.getString("TABLE_SCHEM") or "").lower() == schema.lower()):
                found[(f"{schema}." if schema else "") + rows.getString("TABLE_NAME")] = int(m[1])
        return found
    finally:
        con.close()


def drop_stale(spark: SparkSession, url: str, table: str, keep_hours: float, props: dict | None = None) -> None:
    """Drop what crashed runs left behind."""
    for stage, made in stages_of(spark, url, table, props).items():
        if made < time.time() - keep_hours * 3600:
            drop(spark, url, stage, props)


def overwrite(df: DataFrame, url: str, table: str, props: dict | None = None) -> None:
    """Replace a small table (the ledger) keeping its definition (truncate)."""
    w = df.write.mode("overwrite").format("jdbc").option("url", url).option("dbtable", table) \
        .option("truncate", "true")
    for k, v in (props or {}).items():
        w = w.option(k, v)
    w.save()
