"""Approximate nearest neighbours on shifted Hilbert orderings.

Each ordering projects the unit vectors on ``DIMS`` random directions of its
own, shifts the grid at random, and sorts by Hilbert key; range partitioning
gives every vector its rank.  A query looks at the window of ranks around its
own in each ordering: the windows' blocks are cells, a cell multiplies its
queries with its vectors, and the results of all orderings merge by exact
cosine.

The window is fitted, not fixed: for a bounded sample of queries the true
neighbours are found by brute force, and the window takes in ``TARGET`` of
them over all orderings.  On clustered vectors it stays small; on vectors without
structure it has to grow with the table, which no index avoids.

Equal vectors are indexed once, with their ``k + 1`` smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtally.llm.common import ranges, stage

K = 5
ORDERINGS = 8
DIMS = 6
BITS = 10           # per dimension
BLOCK = 2048        # ranks of a cell
SAMPLE = 200        # queries that fit the window
TARGET = 0.97       # share of true neighbours inside the windows
CHUNK = 512         # queries multiplied at once
SEED = 7


def hilbert_key(x: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer points ``x`` (n, d), ``bits`` per coordinate
    (the transpose form of Skilling, 2004), as int64; d * bits <= 62."""
    x = [c.astype(np.uint64) for c in x.T]
    d, one = len(x), np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(d):
            on = (x[i] & q) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0]) ^ swap
            x[i] = x[i] ^ swap
    for i in range(1, d):
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        t = np.where((x[-1] & np.uint64(1 << b)) != 0, t ^ np.uint64((1 << b) - 1), t)
    key = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = (key << one) | (((c ^ t) >> np.uint64(b)) & one)
    return key.astype(np.int64)


def curves(dim: int, orderings: int = ORDERINGS, dims: int = DIMS, seed: int = SEED):
    """(directions (dim, d), shift (d,)) of each ordering; a unit vector's
    coordinates are spread by sqrt(dim)."""
    rng = np.random.default_rng(seed)
    d = min(dims, dim)
    return [(np.linalg.qr(rng.normal(size=(dim, d)))[0] * np.sqrt(dim), rng.uniform(-0.5, 0.5, d))
            for _ in range(orderings)]


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vectors: DataFrame) -> DataFrame:
    """_id, v of the vectors that take part: no null or non-finite component,
    not all zero, id not null."""
    return vectors.select(F.col("vec_id").cast("bigint").alias("_id"), F.col("embedding").alias("v")).filter(
        F.col("_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))


def _ranked(reps: DataFrame, dim: int, partitions: int) -> DataFrame:
    """t (ordering), rank (from 0), rep, v: every vector in every ordering."""
    planes = curves(dim)

    def keys(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            unit = _unit(_matrix(b.column(1), dim)) if len(b) else np.empty((0, dim))
            for t, (plane, shift) in enumerate(planes):
                cell = (unit @ plane + shift + 4) * ((1 << BITS) / 8)
                key = hilbert_key(np.clip(cell, 0, (1 << BITS) - 1), BITS)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), t, np.int32)), pa.array(key), b.column(0)],
                                                 names=["t", "key", "rep"])

    def number(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in it:
            n = len(b)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(np.full(n, part, np.int32)),
                 pa.array(np.arange(at, at + n, dtype=np.int64))], names=["t", "rep", "part", "i"])
            at += n

    keyed = reps.select("rep", "v").mapInArrow(keys, "t int, key long, rep long")
    local = stage(keyed.repartitionByRange(partitions, "t", "key", "rep").sortWithinPartitions("t", "key", "rep")
                  .mapInArrow(number, "t int, rep long, part int, i long"), "order")
    # one row per partition and ordering
    sizes = local.groupBy("t", "part").agg(F.min("i").alias("lo"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("t").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("t", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("lo")).alias("start"))
    return (local.join(starts, ["t", "part"]).select("t", (F.col("start") + F.col("i")).alias("rank"), "rep"))


def _cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row in double precision, always summed in the same order."""
    return np.sum(q * x, axis=1) / (np.sqrt(np.sum(q * q, axis=1)) * np.sqrt(np.sum(x * x, axis=1)))


def _nearest(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int):
    """For every row of ``q`` its ``k`` nearest rows of ``x`` by (cosine
    descending, id): query row, vector row, exact cosine."""
    qn, xn = _unit(q), _unit(x)
    qi, xi, sc = [], [], []
    for a in range(0, len(q), CHUNK):
        s = qn[a:a + CHUNK] @ xn.T
        least = np.partition(s, max(s.shape[1] - k, 0), axis=1)[:, max(s.shape[1] - k, 0)]
        i, j = np.nonzero(s >= least[:, None] - 1e-12)
        exact = _cosine(q[i + a], x[j])
        order = np.lexsort((ids[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        first = np.searchsorted(i, i)
        top = np.arange(len(i)) - first < k
        qi.append(i[top] + a)
        xi.append(j[top])
        sc.append(exact[top])
    return np.concatenate(qi), np.concatenate(xi), np.concatenate(sc)


def _window(reps: DataFrame, ranked: DataFrame, queries: DataFrame, dim: int, k: int,
            sample: int, target: float) -> int:
    """Ranks on each side that hold ``target`` of the true ``k`` nearest
    vectors of at most ``sample`` queries, in the best of the orderings."""
    drawn = (queries.select("rep", "v").distinct().orderBy(F.xxhash64("rep"), "rep").limit(sample)).collect()
    if not drawn:
        return 0
    q_id = np.array([r["rep"] for r in drawn], dtype=np.int64)
    q = np.array([r["v"] for r in drawn], dtype=np.float64)

    def brute(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if not len(b):
                continue
            ids = b.column(0).to_numpy(zero_copy_only=False)
            i, j, s = _nearest(q, _matrix(b.column(1), dim), ids, k + 1)
            own = q_id[i] == ids[j]
            yield pa.RecordBatch.from_arrays([pa.array(q_id[i][~own]), pa.array(ids[j][~own]), pa.array(s[~own])],
                                             names=["rep", "near", "s"])

    best = Window.partitionBy("rep").orderBy(F.col("s").desc(), "near")
    true = (reps.select("rep", "v").mapInArrow(brute, "rep long, near long, s double")
            .withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k).select("rep", "near"))
    # at most sample * k pairs, and so many ids at most on either side
    true = F.broadcast(stage(true, "true"))
    ours = ranked.join(true.select("rep").distinct(), "rep").select("t", "rep", F.col("rank").alias("r1"))
    theirs = ranked.select("t", F.col("rep").alias("near"), F.col("rank").alias("r2")).join(true, "near")
    far = (theirs.join(ours, ["t", "rep"]).groupBy("rep", "near")
           .agg(F.min(F.abs(F.col("r1") - F.col("r2"))).alias("d")).select("d").collect())
    return int(np.quantile([r["d"] for r in far], target, method="higher")) if far else 0


def nearest(vectors: DataFrame, k: int = K, every: int = 50, block: int = BLOCK, sample: int = SAMPLE,
            target: float = TARGET) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each vec_id divisible by
    ``every`` the ``k`` nearest other rows found, by cosine in double
    precision, ties to the smaller vec_id.

    ``vectors`` has vec_id and embedding; other columns are not looked at.
    Rows that take no part, as query or candidate: null ids, vectors that are null, empty, zero, or
    hold null or non-finite components.  Vectors are compared with those of
    their own length, by an index for each length.  A repeated vec_id is one row, with the least vector.  Fewer
    candidates than ``k`` are all returned; an empty table gives no rows.
    """
    rows = stage(usable(vectors).groupBy("_id").agg(F.min("v").alias("v")), "vectors")
    lengths = sorted(r["n"] for r in rows.select(F.size("v").alias("n")).distinct().collect())
    found = [_nearest_of(rows.filter(F.size("v") == n) if len(lengths) > 1 else rows, n, k, every, block, sample, target)
             for n in lengths]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.union, found)


def _nearest_of(rows: DataFrame, dim: int, k: int, every: int, block: int, sample: int, target: float) -> DataFrame:
    """``nearest`` among vectors (_id, v) of one length."""
    spark = rows.sparkSession
    # equal vectors once, with as many of their ids as a result can show
    least = Window.partitionBy("v").orderBy("_id")
    reps = (rows.withColumn("n", F.row_number().over(least)).filter(F.col("n") <= k + 1)
            .groupBy("v").agg(F.sort_array(F.collect_list("_id")).alias("ids"))
            .select(F.element_at("ids", 1).alias("rep"), "ids", "v"))
    reps = stage(reps, "distinct")
    queries = stage(rows.filter(F.col("_id") % every == 0).join(reps, "v").select("_id", "rep", "v"), "queries")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = stage(_ranked(reps, dim, partitions), "ranked")
    window = _window(reps, ranked, queries, dim, k, sample, target)

    cells = (ranked.join(reps, "rep")
             .select("t", F.floor(F.col("rank") / block).cast("long").alias("block"), "rep", "ids", "v"))
    asked = queries.select("rep", "v").distinct().join(ranked, "rep").select(
        F.col("t").alias("qt"), F.explode(F.sequence(F.floor(F.greatest(F.col("rank") - window, F.lit(0)) / block),
                                                     F.floor((F.col("rank") + window) / block))).alias("qb"),
        "rep", "v")

    def search(asked: pa.Table, cell: pa.Table) -> pa.Table:
        out = pa.schema([("rep", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not len(asked) or not len(cell):
            return out.empty_table()
        asked, cell = asked.combine_chunks(), cell.combine_chunks()
        col = lambda x, name: x.column(name).combine_chunks()
        q_id = col(asked, "rep").to_numpy()
        rep = col(cell, "rep").to_numpy()
        i, j, s = _nearest(_matrix(col(asked, "v"), dim), _matrix(col(cell, "v"), dim), rep, k + 1)
        ids = col(cell, "ids")
        offsets = ids.offsets.to_numpy()
        flat = ids.flatten().to_numpy()
        offsets = offsets - offsets[0]
        sizes = np.diff(offsets)
        at = ranges(offsets[:-1][j], sizes[j])
        return pa.table([pa.array(np.repeat(q_id[i], sizes[j])), pa.array(flat[at]),
                         pa.array(np.repeat(s, sizes[j]))], schema=out)

    found = (asked.groupBy("qt", "qb").cogroup(cells.groupBy("t", "block"))
             .applyInArrow(search, "rep long, vec_id long, score double").distinct())
    best = Window.partitionBy("rep").orderBy(F.col("score").desc(), "vec_id")
    merged = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (queries.select(F.col("_id").alias("query_id"), "rep").join(merged, "rep")
            .filter("vec_id != query_id").withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
