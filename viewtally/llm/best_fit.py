"""Best-fit packing: best-fit decreasing over a segment tree of capacities.

Best-fit decreasing takes pieces from the longest to the shortest and puts each
into the tightest open sequence that has room, or opens one.  It depends on
the lengths alone, so it runs over the histogram of piece lengths (at most
``capacity`` numbers, whatever the input): pieces of one length are placed in
runs, each run found by one descent of a segment tree over the remaining
capacities.  A run is the same choice repeated: a piece that fits twice
into the tightest sequence goes there twice, as what is left of that
sequence is then tighter still.  The result is exactly that of placing
pieces one by one.

The plan of runs is small; which piece takes which place follows from its
rank among the pieces of its length, found by range partitions, so no length
meets in one task.
"""

from __future__ import annotations

import functools
import gc
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewtally.llm.common import id_key, ordered, ranks, stage, text_batches

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0              # closes a document

#: parts of words whose ids a Python worker remembers, and the longest it does
CACHE_WORDS, CACHE_LENGTH = 600_000, 64
#: rows of the plan that are broadcast; a plan is joined beyond that
PLAN_ROWS = 2_000_000
DIGIT_SIZE = 4          # bytes of a stored id


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class WordIds:
    """Token ids of texts as little-endian 32-bit numbers.

    The tokenizer composes and lower-cases a text, drops white space and cuts
    the rest into runs of letters, single digits and runs of anything else; each
    part is merged on its own.  For a text of ASCII and of composed Western letters
    without the start of a special token that is done here, and a part is
    encoded once while remembered.  Other texts are cut at white space only, and
    of their words those that are not plain go through the tokenizer whole."""

    #: what is cut here, and the tokenizer's own cut of it in lower case
    PLAIN = re.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
    PART = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\t-\r a-z0-9\xdf-\xf6\xf8-\xff]+")
    WORD = re.compile("[^\t-\r ]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # one task, one core
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def plain(self, text: str) -> bool:
        return self.PLAIN.fullmatch(text) is not None and "<|" not in text

    def cut(self, text: str) -> list[str]:
        """Parts, and words that are none, in order."""
        if self.plain(text):
            return self.PART.findall(text.lower())
        return [x for w in self.WORD.findall(text) for x in (self.PART.findall(w.lower()) if self.plain(w) else (w,))]

    def _whole(self, word: str) -> bytes:
        return np.array(self.model.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, new: list[str]) -> None:
        """Learn parts and words.  Many parts go in one call: each is one word
        to the tokenizer, which tells the word of every id."""
        parts = [x for x in new if self.plain(x)]
        for at in range(0, len(parts), 4096):
            some = parts[at:at + 4096]
            e = self.model.encode(" ".join(some), add_special_tokens=False)
            cuts = np.flatnonzero(np.diff(np.array(e.word_ids, dtype=np.int64))) + 1
            told, cuts = np.array(e.ids, dtype="<u4").tobytes(), [0, *cuts.tolist(), len(e.ids)]
            if len(cuts) == len(some) + 1:
                self.known.update((p, told[4 * a:4 * b]) for p, a, b in zip(some, cuts, cuts[1:]))
            else:
                self.known.update((p, self._whole(p)) for p in some)
        self.known.update((x, self._whole(x)) for x in new if x not in self.known)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text.  What is new to the worker is encoded together; it
        is forgotten when two halves of the memory have filled without it."""
        if len(self.known) > CACHE_WORDS // 2:
            self.known, self.older = {}, self.known
        cut = [self.cut(t) if t else [] for t in texts]
        new = set().union(*cut).difference(self.known)
        again = new & self.older.keys()
        self.known.update((x, self.older[x]) for x in again)
        new = list(new - again)
        self.encode(new)
        get = self.known.__getitem__
        out = [b"".join(map(get, parts)) for parts in cut]
        for x in new:
            if len(x) > CACHE_LENGTH:
                del self.known[x]
        return out


@functools.lru_cache(2)
def _word_ids(path: str) -> WordIds:
    gc.disable()    # in a worker: many small objects, no cycles
    return WordIds(path)


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece (from 0), start, length, ids (little-endian unsigned
    32-bit), in order of their documents' tokens.  A document is its text's
    ids, special tokens not added, and ``end_id``; only documents longer than
    ``capacity`` are cut, every ``capacity`` ids.  A null text is empty (one
    piece of one id); rows that repeat are documents of their own."""
    path = tokenizer or tokenizer_path()
    end = np.array([end_id], dtype="<u4").tobytes()
    step = capacity * DIGIT_SIZE

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(path)
        for batch in batches:
            rows = batch.to_pydict()
            doc, piece, start, length, ids = [], [], [], [], []
            for d, told in zip(rows["doc_id"], words.ids(rows["text"])):
                told += end
                for k, at in enumerate(range(0, len(told), step)):
                    part = told[at:at + step]
                    doc.append(d)
                    piece.append(k)
                    start.append(at // DIGIT_SIZE)
                    length.append(len(part) // DIGIT_SIZE)
                    ids.append(part)
            yield pa.record_batch([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                                   pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                                  ["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        cut, "doc_id bigint, piece int, start bigint, length bigint, ids binary")


class Capacities:
    """Segment tree over remaining capacities 0..capacity: which of them an
    open sequence has."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, c: int, open_: bool) -> None:
        at = c + self.size
        self.open[at] = open_
        at >>= 1
        while at:
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]
            at >>= 1

    def tightest(self, least: int) -> int:
        """The smallest open capacity of ``least`` or more, -1 if none."""
        at = least + self.size
        if self.open[at]:
            return least
        while at > 1:
            right = at ^ 1
            if not at & 1 and self.open[right]:
                at = right
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return -1


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing as runs (length, first, last, sequence, each, used):
    of the pieces of that length, those of rank ``first`` to ``last`` (from 0,
    inclusive) go to the sequences from ``sequence`` on, ``each`` a sequence,
    behind ``used`` tokens."""
    tree, runs, opened = Capacities(capacity), [], 0
    # remaining capacity -> intervals [low, high) of sequences that have it
    open_: dict[int, list[tuple[int, int]]] = {}

    def add(c: int, low: int, high: int) -> None:
        if c and low < high:
            have = open_.setdefault(c, [])
            if have and have[-1][1] == low:
                have[-1] = have[-1][0], high
            else:
                have.append((low, high))
            tree.set(c, True)

    for length in sorted((x for x, n in histogram.items() if n > 0), reverse=True):
        rank, left = 0, histogram[length]
        while left:
            c = tree.tightest(length)
            if c < 0:       # as many new sequences as the rest fills
                need = -(-left // (capacity // length))
                c, low, high = capacity, opened, opened + need
                opened += need
            else:
                low, high = open_[c].pop()
                if not open_[c]:
                    del open_[c]
                    tree.set(c, False)
            each = c // length
            full = min(high - low, left // each)
            used = capacity - c
            if full:
                runs.append((length, rank, rank + full * each - 1, low, each, used))
                rank, left = rank + full * each, left - full * each
                add(c - each * length, low, low + full)
                low += full
            if left and low < high:     # the last sequence that pieces of this length reach
                runs.append((length, rank, rank + left - 1, low, left, used))
                add(c - left * length, low, low + 1)
                low, left = low + 1, 0
            add(c, low, high)
    return runs


def _by_lookup(ranked: DataFrame, runs: list) -> DataFrame:
    """sequence_id and offset by a binary search in the broadcast plan."""
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 6)
    keys = (table[:, 0] << 48) | table[:, 1]
    shared = ranked.sparkSession.sparkContext.broadcast((keys, table))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, table = shared.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_pos"))
            rank = rank - 1
            run = table[np.searchsorted(keys, (length << 48) | rank, "right") - 1]
            nth, slot = np.divmod(rank - run[:, 1], run[:, 4])
            yield batch.append_column("sequence_id", pa.array(run[:, 3] + nth)) \
                .append_column("offset", pa.array(run[:, 5] + slot * length))

    kind = T.StructType([*ranked.schema.fields, T.StructField("sequence_id", T.LongType()),
                         T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(find, kind)


def _by_join(ranked: DataFrame, runs: list, block: int = 1 << 10) -> DataFrame:
    """The same for a plan too long to broadcast: an equi-join on the length
    and the block of the rank."""
    names = ["length", "_first", "_last", "_seq", "_each", "_used"]
    told = ranked.sparkSession.createDataFrame(runs, ", ".join(f"{n} long" for n in names))
    of = lambda c: F.floor(c / block).cast("bigint")
    told = told.withColumn("_b", F.explode(F.sequence(of(F.col("_first")), of(F.col("_last")))))
    rank = F.col("_pos") - 1
    nth = rank - F.col("_first")
    return (ranked.withColumn("_b", of(rank)).join(told, ["length", "_b"])
            .filter((rank >= F.col("_first")) & (rank <= F.col("_last")))
            .withColumn("sequence_id", F.col("_seq") + F.floor(nth / F.col("_each")).cast("bigint"))
            .withColumn("offset", F.col("_used") + nth % F.col("_each") * F.col("length")))


def place(cut: DataFrame, capacity: int = CAPACITY, plan_rows: int = PLAN_ROWS) -> DataFrame:
    """``cut`` (rows with ``doc_id``, ``piece`` and a ``length`` from 1 to
    ``capacity``) with ``sequence_id`` (from 0) and ``offset`` added; all its
    columns stay.  Pieces of a sequence follow each other without a gap from
    offset 0.  No row: no sequence."""
    with text_batches(cut.sparkSession):    # texts are read and encoded a single time
        found = stage(cut.withColumn("_rid", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = plan(histogram, capacity)
    # ids stay behind while pieces are ranked
    wide = [f.name for f in cut.schema.fields if not isinstance(f.dataType, T.NumericType)]
    ranked = ranks(ordered(found.drop(*wide).withColumn("_id", id_key("doc_id")), ["length", "_id", "piece"], "ranked"),
                   ["length"], "_pos").drop("_at", "_id")
    placed = _by_lookup(ranked, runs) if len(runs) <= plan_rows else _by_join(ranked, runs)
    if wide:
        placed = placed.join(found.select("_rid", *wide), "_rid")
    return placed.select(*cut.columns, "sequence_id", "offset")


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document (see ``pieces``) with its place (see
    ``place``): doc_id, piece, start, length, ids, sequence_id, offset."""
    return place(pieces(docs, capacity, tokenizer, end_id), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, length, ids, and the doc_ids and
    offsets of its pieces.  A sequence holds ``capacity`` ids at most."""
    part = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return (packed.groupBy("sequence_id").agg(part.alias("p"))
            .select("sequence_id", F.aggregate("p", F.lit(0).cast("bigint"), lambda n, x: n + x["length"]).alias("length"),
                    F.aggregate("p", F.lit(b""), lambda b, x: F.concat(b, x["ids"])).alias("ids"),
                    F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets")))
