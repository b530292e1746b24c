"""Substring dedup on a compacted de Bruijn graph of words.

The edges of the graph are the windows of ``SPAN`` words (k-mers), its nodes
their overlaps.  A window is repeated if its words also start earlier; every
word under a repeated window goes.  Most windows occur once, so the graph is
never built edge by edge:

1. Seeds.  Each window has one seed, its ``SEED_WORDS``-gram of least hash.
   Equal windows have equal seeds, and neighbouring windows mostly share one.
   Seeds are counted; only windows of a repeated seed can be repeated.
2. Paths.  The consecutive windows of one seed occurrence are a nonbranching
   path of edges, kept as one row: its words' hash, source coordinate and
   window hashes.  Equal paths collapse to the first coordinate by one
   aggregation; every later occurrence is repeated as a whole.
3. Branches.  First occurrences of different paths with the same seed may still share
   edges: only their windows are spread out and joined with the first
   coordinate of each edge.
4. Compaction.  Repeated windows that follow each other in a document and in
   their source are joined to maximal spans (document, start, length, source).
5. Verification.  The words of every span are compared, by digest, with the
   words at its source coordinate.  A difference (a hash collision) starts
   the work again with another hash seed.

The seed count reaches the second scan as a Bloom filter of at most
``FILTER_BITS`` bits.  What it lets through by mistake, or past its size, is
dropped by the exact count of paths and edges: size and time depend on it, the
result does not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewtally.llm.common import NULL_ID, id_key, ranges, stage, text_batches, text_key

SPAN = 20               # words of a window
SEED_WORDS = 6          # words of a seed
FILTER_BITS = 1 << 30   # at most 128 MB; about 16 bits for each repeated seed below that
PAGE_BITS = 1 << 20
TRIES = 3
LOT = 4 << 20           # bytes of text hashed at once

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int, cache: dict = {}) -> np.ndarray:  # noqa: B006
    got = cache.get(base)
    if got is None or len(got) < n:
        p = np.full(max(n, 1 << 12), np.uint64(base))
        p[0] = 1
        got = cache[base] = np.multiply.accumulate(p)
    return got[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Line:
    """The words of some documents in a row, hashed once."""

    def __init__(self, words: list[list[bytes]], salt: int):
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.offsets = np.concatenate(([0], np.cumsum(self.sizes)))
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(w, salt) for doc in words for w in doc), np.uint64, int(self.offsets[-1]))
        self.back = _powers(_INVERSE, len(h) + 1)
        self.forth = _powers(_BASE, len(h) + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * self.back[:len(h)], dtype=np.uint64)))

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words in each [start, end); the same wherever they are."""
        return _mix((self.sums[end] - self.sums[start]) * self.forth[start] + (end - start).astype(np.uint64))

    def seeds(self, span: int, seed_words: int):
        """Of the documents with a window: document, place of each window, and
        place and hash of its seed."""
        doc = np.flatnonzero(self.sizes >= span)
        n = self.sizes[doc] - span + 1
        at = ranges(self.offsets[:-1][doc], n)
        if not len(at):
            return np.repeat(doc, n), at, at, np.empty(0, np.uint64)
        total = int(self.offsets[-1])
        first = np.arange(total - seed_words + 1)
        gram = self.hashes(first, first + seed_words)
        # leftmost least of the grams inside each window
        least, where = gram[at], at.copy()
        for s in range(1, span - seed_words + 1):
            g = gram[at + s]
            less = g < least
            least[less] = g[less]
            where[less] = at[less] + s
        return np.repeat(doc, n), at, where, least


def _lots(texts: list[str | None]) -> Iterator[tuple[int, int, list[list[bytes]]]]:
    """Consecutive texts as words, about LOT bytes at a time."""
    a, size, words = 0, 0, []
    for i, t in enumerate(texts):
        raw = t.encode("utf-8", "surrogatepass") if t else b""
        words.append(raw.split())
        size += len(raw)
        if size >= LOT:
            yield a, i + 1, words
            a, size, words = i + 1, 0, []
    if words:
        yield a, len(texts), words


def _as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _repeated_seeds(texts: DataFrame, span: int, seed_words: int, salt: int) -> DataFrame:
    """The seeds (hashes) with two places or more."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for _, _, words in _lots(b.column(0).to_pylist()):
                _, _, where, seed = Line(words, salt).seeds(span, seed_words)
                if len(where):
                    new = np.concatenate(([True], where[1:] != where[:-1]))
                    s, n = np.unique(seed[new], return_counts=True)
                    yield pa.RecordBatch.from_arrays([_as_long(s), pa.array(n)], names=["seed", "n"])

    counts = texts.select("_t").mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    return stage(counts.filter("n > 1").select("seed"), "seeds")


def _bit_places(seed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    x = seed.view(np.uint64)
    m = np.uint64(bits - 1)
    return (x & m).astype(np.int64), (_mix(x + np.uint64(1)) & m).astype(np.int64)


def _bloom(seeds: DataFrame, most: int) -> np.ndarray:
    """Bloom filter (two bits a seed) as bytes; bounded by ``most`` bits."""
    n = seeds.count()
    bits = min(most, max(PAGE_BITS, 1 << (16 * n).bit_length()))
    pages = bits // PAGE_BITS

    def spread(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            places = np.unique(np.concatenate(_bit_places(b.column(0).to_numpy(zero_copy_only=False), bits)))
            yield pa.RecordBatch.from_arrays([pa.array((places // PAGE_BITS).astype(np.int32)),
                                              pa.array((places % PAGE_BITS).astype(np.int32))], names=["page", "bit"])

    def fill(t: pa.Table) -> pa.Table:
        on = np.zeros(PAGE_BITS, dtype=bool)
        on[t.column("bit").to_numpy()] = True
        return pa.table({"page": t.column("page")[:1], "bits": pa.array([np.packbits(on).tobytes()], pa.binary())})

    out = np.zeros((pages, PAGE_BITS // 8), dtype=np.uint8)
    rows = (seeds.mapInArrow(spread, "page int, bit int").groupBy("page")
            .applyInArrow(fill, "page int, bits binary"))
    for r in rows.collect():
        out[r["page"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def _maybe(bloom: np.ndarray, seed: np.ndarray) -> np.ndarray:
    hit = np.ones(len(seed), dtype=bool)
    for place in _bit_places(seed, len(bloom) * 8):
        hit &= (bloom[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
    return hit


PATHS = "seed long, path long, _id long, _tk long, lo int, windows array<long>"


def _paths(texts: DataFrame, bloom, span: int, seed_words: int, salt: int) -> DataFrame:
    """One row per place of a (probably) repeated seed: the windows it stands
    for start at ``lo``, ``lo + 1``, ...; ``path`` hashes all their words."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bloom.value
        for b in it:
            ids = b.column(1).to_numpy(zero_copy_only=False)
            keys = b.column(2).to_numpy(zero_copy_only=False)
            for a, _, words in _lots(b.column(0).to_pylist()):
                line = Line(words, salt)
                doc, at, where, seed = line.seeds(span, seed_words)
                if not len(at):
                    continue
                new = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
                size = np.diff(np.append(new, len(at)))
                ok = _maybe(known, seed[new])
                new, size = new[ok], size[ok]
                if not len(new):
                    continue
                lo = at[new]
                end = lo + size - 1 + span
                # the place of the seed in the path is part of its identity
                path = _mix(line.hashes(lo, end) + (where[new] - lo).astype(np.uint64))
                w = ranges(lo, size)
                owner = doc[new]
                yield pa.RecordBatch.from_arrays(
                    [_as_long(seed[new]), _as_long(path), pa.array(ids[a + owner]), pa.array(keys[a + owner]),
                     pa.array((lo - line.offsets[owner]).astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)),
                                              _as_long(line.hashes(w, w + span)))],
                    names=["seed", "path", "_id", "_tk", "lo", "windows"])

    return texts.select("_t", "_id", "_tk").mapInArrow(run, PATHS)


def _spans(paths: DataFrame, span: int) -> DataFrame:
    """Maximal repeated spans: _id, _tk, lo, n (words), and their source
    src_id, src_tk, src_lo."""
    place = F.struct("_id", "_tk", "lo")
    firsts = paths.groupBy("seed", "path").agg(F.min(F.struct("_id", "_tk", "lo", "windows")).alias("f"),
                                               F.count(F.lit(1)).alias("times"))
    firsts = stage(firsts.withColumn("others", F.col("times") - 1), "paths-first")
    coord = F.struct(F.col("f._id").alias("_id"), F.col("f._tk").alias("_tk"), F.col("f.lo").alias("lo"))
    # later places of a path: repeated as a whole
    later = (paths.select("seed", "path", "_id", "_tk", "lo", F.size("windows").alias("w"))
             .join(firsts.filter("times > 1").select("seed", "path", coord.alias("src")), ["seed", "path"])
             .filter(F.col("src") != place)
             .select("_id", "_tk", "lo", "w", F.col("src._id").alias("src_id"), F.col("src._tk").alias("src_tk"),
                     F.col("src.lo").alias("src_lo")))
    # edges that paths with one seed may share, or that a path holds twice
    forks = firsts.groupBy("seed").agg(
        F.count(F.lit(1)).alias("k"),
        F.max(F.size(F.array_distinct("f.windows")) < F.size("f.windows")).alias("loop")).filter("k > 1 or loop")
    edges = (firsts.join(forks, "seed", "left_semi").select("seed", "f._id", "f._tk", "f.lo", F.posexplode("f.windows").alias("i", "edge"))
             .select("seed", "edge", "_id", "_tk", (F.col("lo") + F.col("i")).alias("lo")))
    first_edge = (edges.groupBy("seed", "edge").agg(F.min(place).alias("src"), F.count(F.lit(1)).alias("times"))
                  .filter("times > 1").drop("times"))
    branched = (edges.join(first_edge, ["seed", "edge"]).filter(F.col("src") != place)
                .select("_id", "_tk", "lo", F.lit(1).alias("w"), F.col("src._id").alias("src_id"),
                        F.col("src._tk").alias("src_tk"), F.col("src.lo").alias("src_lo")))
    # compaction: what goes on in the document and in the source is one span
    runs = later.unionByName(branched).withColumn("shift", F.col("lo") - F.col("src_lo"))
    same = ["_id", "_tk", "src_id", "src_tk", "shift"]
    line = Window.partitionBy(*same).orderBy("lo")
    up_to = F.max(F.col("lo") + F.col("w")).over(line.rowsBetween(Window.unboundedPreceding, -1))
    part = F.sum(F.when(F.col("lo") <= F.coalesce(F.col("up_to"), F.lit(-1)), 0).otherwise(1)).over(line)
    return (runs.withColumn("up_to", up_to).withColumn("part", part).groupBy(*same, "part")
            .agg(F.min("lo").alias("lo"), (F.max(F.col("lo") + F.col("w")) + (span - 1)).alias("hi"))
            .select("_id", "_tk", "lo", (F.col("hi") - F.col("lo")).cast("int").alias("n"), "src_id", "src_tk",
                    (F.col("lo") - F.col("shift")).cast("int").alias("src_lo")))


OUT = ("_id long, _tk long, n_words long, n_removed long, kept_sha256 string, "
       "slices array<struct<lo:int,n:int,own:boolean,digest:binary>>")


def _cut(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """Remove the spans; also digest the words of every span and source."""
    own = spans.select("_id", "_tk", "lo", "n", F.lit(True).alias("own"))
    src = spans.select(F.col("src_id").alias("_id"), F.col("src_tk").alias("_tk"), F.col("src_lo").alias("lo"), "n",
                       F.lit(False).alias("own"))
    asked = (own.union(src).distinct().groupBy("_id", "_tk")
             .agg(F.collect_list(F.struct("lo", "n", "own")).alias("slices")))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = []
            for t, slices in zip(b.column(0).to_pylist(), b.column(3).to_pylist()):
                words = t.encode("utf-8", "surrogatepass").split() if t else []
                keep = np.ones(len(words), dtype=bool)
                told = []
                for s in slices or ():
                    a, z = s["lo"], s["lo"] + s["n"]
                    if s["own"]:
                        keep[a:z] = False
                    told.append(s | {"digest": hashlib.blake2b(b" ".join(words[a:z]), digest_size=16).digest()})
                left = words if keep.all() else [words[i] for i in np.flatnonzero(keep)]
                rows.append((len(words), len(words) - len(left),
                             hashlib.sha256(b" ".join(left)).hexdigest(), told))
            n, removed, sha, told = zip(*rows) if rows else ((), (), (), ())
            kind = pa.list_(pa.struct([("lo", pa.int32()), ("n", pa.int32()), ("own", pa.bool_()), ("digest", pa.binary())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(1), b.column(2), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(sha, pa.string()), pa.array(told, kind)],
                names=["_id", "_tk", "n_words", "n_removed", "kept_sha256", "slices"])

    joined = texts.join(asked, ["_id", "_tk"], "left").select("_t", "_id", "_tk", "slices")
    return joined.mapInArrow(run, OUT)


def _unequal(spans: DataFrame, cut: DataFrame) -> int:
    """Spans whose words differ from the words at their source."""
    told = cut.select("_id", "_tk", F.explode("slices").alias("s")).select(
        "_id", "_tk", "s.lo", "s.n", "s.own", "s.digest").distinct()
    own = told.filter("own").drop("own").withColumnRenamed("digest", "d1")
    src = told.filter("not own").drop("own").withColumnsRenamed(
        {"_id": "src_id", "_tk": "src_tk", "lo": "src_lo", "digest": "d2"})
    both = (spans.join(own, ["_id", "_tk", "lo", "n"], "left")
            .join(src, ["src_id", "src_tk", "src_lo", "n"], "left"))
    return both.filter(~F.coalesce(F.col("d1") == F.col("d2"), F.lit(False))).count()


def repeated_spans(docs: DataFrame, span: int = SPAN, seed_words: int = SEED_WORDS,
                   filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(spans, cut documents), verified; see ``substring_dedup``."""
    texts = docs.select(F.col("text").cast("string").alias("_t"), id_key("doc_id").alias("_id"),
                        text_key().alias("_tk"))
    spark = docs.sparkSession
    with text_batches(spark):
        for salt in range(TRIES):
            bloom = _bloom(_repeated_seeds(texts, span, seed_words, salt), filter_bits)
            shared = spark.sparkContext.broadcast(bloom)
            paths = stage(_paths(texts, shared, span, seed_words, salt), "paths")
            spans = stage(_spans(paths, span), "spans")
            cut = stage(_cut(texts, spans), "cut")
            if not _unequal(spans, cut):
                return spans, cut
    raise RuntimeError(f"hash collisions with {TRIES} hash seeds")


def substring_dedup(docs: DataFrame, span: int = SPAN, seed_words: int = SEED_WORDS,
                    filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256.

    Words are runs without ASCII white space, unchanged.  A word goes if a
    window of ``span`` words over it also starts earlier: in a document with a
    smaller doc_id (null first; of several texts with one doc_id, by their key), or earlier in the
    same one.  Rows that repeat doc_id and text are one document, so they do
    not remove each other.  Null, empty and short texts have no window and
    lose nothing.  An empty table gives no rows; columns but doc_id and text are
    not looked at.
    """
    cut = repeated_spans(docs, span, seed_words, filter_bits)[1]
    shown = F.when(F.col("_id") != F.lit(NULL_ID), F.col("_id"))
    return cut.select(shown.alias("doc_id"), "n_words", "n_removed", "kept_sha256")
