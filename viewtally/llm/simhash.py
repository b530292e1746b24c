"""SimHash near-dedup by segment popcounts.

Fingerprint: 64 bits, each set if it is set in over half of the document's
shingle hashes.  Embedding: the fingerprint in 32 segments of two bits, each
replaced by its number of set bits.  Popcounts differ by no more than the
bits do, so the Manhattan distance of two embeddings is a lower bound of the
Hamming distance.  Grid: the 32 coordinates form 7 groups; two embeddings at
distance 4 or less agree on at least 3 whole groups, so joining on every
choice of 3 groups (35 keys) meets each pair in some cell and loses none.
Inside a cell the Manhattan bound is tested first, then the exact distance.

Counts are kept in unary (0 = 00, 1 = 01, 2 = 11): the Manhattan distance is
then the popcount of an xor, and a group of coordinates a bit mask.

Only distinct fingerprints are joined.  A cell gives links that span its
components, never all its pairs; a cell over ``CELL`` members is split into
blocks, and pairs of blocks are compared in tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtally.llm.common import NULL_ID, components, id_key, keep_rows, stage, text_batches, text_key

SHINGLE = 4         # words
MAX_BITS = 4        # differing bits of a link
SEED = 42
CELL = 32768        # members of a cell that are compared in one task
LOW = 0x5555555555555555


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one text; 0 without a word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return 0
    if n <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, n)
    begin = np.cumsum(size + 1) - size - 1
    starts = begin[:n - shingle + 1].tolist()
    ends = (begin + size)[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(starts))
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(h), 1 << 14):
        part = h[k:k + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h)).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """_id, _tk, fp (the fingerprint as a signed long) for every row."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            fp = np.fromiter((fingerprint(t, shingle) for t in b.column(2).to_pylist()), np.uint64, len(b))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             names=["_id", "_tk", "fp"])

    rows = docs.select(id_key("doc_id").alias("_id"), text_key().alias("_tk"), F.col("text").cast("string"))
    with text_batches(docs.sparkSession):
        return stage(rows.mapInArrow(run, "_id long, _tk long, fp long"), "fingerprints")


def unary(fp: Column) -> Column:
    """The 32 popcounts of two-bit segments, in unary."""
    low, high = F.lit(LOW), F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(high).bitwiseAND(low)
    both = fp.bitwiseAND(high).bitwiseAND(low)
    return some.bitwiseOR(F.shiftleft(both, 1))


def grid_masks(max_bits: int = MAX_BITS, fixed: int = 3) -> list[int]:
    """Bit masks of ``fixed`` of ``max_bits + fixed`` groups of segments."""
    n = max_bits + fixed
    groups = [sum(3 << (2 * s) for s in range(32) if s * n // 32 == g) for g in range(n)]
    return [sum(c) for c in combinations(groups, fixed)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _unary_np(fp: np.ndarray) -> np.ndarray:
    one, low = np.uint64(1), np.uint64(LOW)
    return ((fp | (fp >> one)) & low) | ((fp & (fp >> one) & low) << one)


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Manhattan bound of the popcounts first, then the exact distance."""
    ok = np.bitwise_count(_unary_np(a) ^ _unary_np(b)) <= max_bits
    ok[ok] = np.bitwise_count(a[ok] ^ b[ok]) <= max_bits if b.shape == a.shape else \
        np.bitwise_count(a ^ b[ok]) <= max_bits
    return ok


def _span(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected in one cell, each to a seed."""
    left, us, vs = np.unique(fp), [], []
    while len(left) > 1:
        seed, left = left[0], left[1:]
        front = [seed]
        while front and len(left):
            ok = _near(front.pop(), left, max_bits)
            if ok.any():
                got, left = left[ok], left[~ok]
                us.append(np.full(len(got), seed))
                vs.append(got)
                front += list(got)
    none = np.empty(0, np.uint64)
    return (np.concatenate(us), np.concatenate(vs)) if us else (none, none)


def _cell_links(key: np.ndarray, fp: np.ndarray, max_bits: int, small: int = 16):
    """Links of rows sorted by key: short runs pair by pair, all at once."""
    cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    size = np.diff(cut)
    run = np.repeat(size, size)
    us, vs = [], []
    keep = run <= small
    k, f = key[keep], fp[keep]
    for s in range(1, small):
        i = np.flatnonzero(k[s:] == k[:-s])
        if not len(i):
            break
        ok = _near(f[i], f[i + s], max_bits)
        us.append(f[i][ok])
        vs.append(f[i + s][ok])
    for a, n in zip(cut[:-1][size > small], size[size > small]):
        u, v = _span(fp[a:a + n], max_bits)
        us.append(u)
        vs.append(v)
    return (np.concatenate(us), np.concatenate(vs)) if us else (fp[:0], fp[:0])


def links(prints: DataFrame, max_bits: int = MAX_BITS, cell: int = CELL) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp) such that the
    components are those of all pairs within ``max_bits``."""
    u = unary(F.col("fp"))
    keys = F.array(*[F.xxhash64(F.lit(i), u.bitwiseAND(F.lit(_signed(m))))
                     for i, m in enumerate(grid_masks(max_bits))])
    rows = prints.select("fp", F.explode(keys).alias("key"))
    heavy = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell)
             .select("key", F.ceil(F.col("n") / cell).cast("int").alias("blocks")))
    heavy = stage(heavy, "heavy")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
    rows = rows.join(heavy, "key", "left")
    # a member of block b goes to the cells of (b, other) for every other block
    part = F.when(F.col("blocks").isNull(), F.array(F.col("key"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                    lambda j: F.xxhash64("key", F.least(j, own), F.greatest(j, own))))
    rows = rows.select(F.explode(part).alias("key"), "fp")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_k, rest_f = [], []

        def out(k, f):
            a, b = _cell_links(k, f, max_bits)
            a, b = a.view(np.int64), b.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))],
                                              names=["u", "v"])
        for batch in it:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            f = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(k):
                continue
            rest_k.append(k)
            rest_f.append(f)
            if k[0] == k[-1] and rest_k[0][0] == k[-1]:
                continue    # one cell goes on
            k, f = np.concatenate(rest_k), np.concatenate(rest_f)
            last = int(np.searchsorted(k, k[-1]))
            rest_k, rest_f = [k[last:]], [f[last:]]
            yield out(k[:last], f[:last])
        if rest_k:
            yield out(np.concatenate(rest_k), np.concatenate(rest_f))

    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(n, "key").sortWithinPartitions("key")
            .mapInArrow(run, "u long, v long").distinct())


def _near_groups(docs: DataFrame, shingle: int, max_bits: int, cell: int) -> DataFrame:
    """_id, _tk, fp, _group, _root_id for every row."""
    prints = fingerprints(docs, shingle)
    least = prints.groupBy("fp").agg(F.min("_id").alias("_low"))
    found = stage(components(links(prints.select("fp").distinct(), max_bits, cell)), "components")
    found = found.withColumnsRenamed({"node": "fp"})
    lowest = (found.join(least, "fp").groupBy("root").agg(F.min("_low").alias("_root_id")))
    linked = found.join(lowest, "root").select("fp", "root", "_root_id")
    own = least.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("_group"),
                                                  F.coalesce("_root_id", "_low").alias("_root_id"))
    # written first, so that the join may split a fingerprint that very many rows share
    return prints.join(stage(own, "groups"), "fp")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, cell: int = CELL) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits),
    component_id (the smallest doc_id that links reach, itself included).

    A text of fewer words than a shingle is one shingle; null, empty and blank
    texts have fingerprint zero and link like any other.  Repeated rows get
    equal results.  A null doc_id is before every other, so its component's id is null.  An
    empty table gives no rows; columns but doc_id and text are not looked at.
    """
    shown = lambda c: F.when(F.col(c) != F.lit(NULL_ID), F.col(c))
    return _near_groups(docs, shingle, max_bits, cell).select(
        shown("_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        shown("_root_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                     cell: int = CELL) -> DataFrame:
    """``docs`` with one row of each group, the one with the smallest doc_id
    (of several with that id, one text by its key); columns unchanged."""
    groups = _near_groups(docs, shingle, max_bits, cell).filter("_id = _root_id")
    keepers = groups.groupBy("_group", "_id").agg(F.min("_tk").alias("_tk"))
    return keep_rows(docs, keepers)
