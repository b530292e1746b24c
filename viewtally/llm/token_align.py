"""Cross-tokenizer alignment: counts of token pairs by minimal perfect hashing.

Two tokenizers cut the same bytes.  Offsets where tokens of both end cut them
into groups, and an A and a B token that end together are a link.

First pass: texts are aligned once and written with their links.  The distinct
pairs (a, b) of each task, with their counts, are counted from the written links and
dealt into shards of some 65,536 by hash; each gets a minimal perfect hash function (a
cascade of bit vectors: a key that shares its place with none is settled, the others go
on to the next vector).  Counts are dense vectors indexed by that hash: a vector
for each (shard, slice of the tasks), then summed as a tree.  Beside the counts
lie the keys, so that a pair that was never counted is told from those that
were.  Second pass: every written link looks up its count.  Functions, keys and counts
are broadcast while there are at most ``BROADCAST_PAIRS`` pairs; beyond that the
links go to the shards instead.

Both tokenizers cut before white space that follows anything else (but for the
few characters, such as carriage returns, that pieces hold behind others), so a
text's tokens are those of its chunks (white space and what follows it up to the
end of a word), and a chunk is encoded and aligned once while remembered.
"""

from __future__ import annotations

import functools
import gc
import json
import re
import struct
from collections.abc import Iterator
from itertools import chain, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtally.llm.common import stage, text_batches

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"

#: texts that a Python worker holds at a time
BATCH_ROWS = 250
#: chunks a Python worker remembers, and the longest it does (characters)
CACHE_CHUNKS, CACHE_LENGTH = 300_000, 64
#: pairs of a shard, about
SHARD_PAIRS = 1 << 16
#: counted rows of a dense vector's slice, about
SLICE_ROWS = 1 << 20
#: most pairs that are broadcast (17 bytes each, about)
BROADCAST_PAIRS = 4_000_000
FAN = 16            # vectors summed together
CELL_BITS = 20      # of the hash that deals pairs into shards
FLUSH = 1 << 20     # pairs a task holds before it hands them on
LOOK_LINKS = 1 << 19    # links counted or looked up at once, about

# Characters with the Unicode property White_Space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Letters and marks between which both tokenizers cut: ASCII and composed
# Western letters, ASCII punctuation.
LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
MARK = r"!-/:-@\[-`{-~"


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


LINK = struct.Struct("<q")


class Aligned(NamedTuple):
    n_a: int
    n_b: int
    n_groups: int
    groups: str         # a1,a2|b1;a3|b2
    links: bytes        # int64 keys of the links, in order


NOTHING = Aligned(0, 0, 0, "", b"")


def _tables(bytes_of: dict[int, bytes], last: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By id: bytes, and the id as text inside and at the end of its group."""
    n = max(bytes_of) + 1
    sizes = np.fromiter((len(bytes_of.get(i, b"")) for i in range(n)), np.int64)
    return sizes, *(np.array([f"{i}{mark}" for i in range(n)], dtype=object) for mark in (",", last))


class ByteTokens:
    """Byte-level BPE from a ``tokenizers`` file, without special tokens; its
    merges must make tokens in the order of their ids."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        made = [model["vocab"][a + b] for a, b in pairs]
        if made != sorted(made):
            raise ValueError(f"{path}: merges are not in the order of their ids")
        # a byte-level vocabulary writes printable Latin-1 as itself, other bytes from U+0100 on
        plain = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
        letters = {chr(b): b for b in plain}
        letters |= {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()}
        self.bytes_of = {i: token for token, i in ranks.items()}
        self.sizes, self.spelt, self.spelt_last = _tables(self.bytes_of, "|")
        self.model = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        return self.model.encode_ordinary(text)

    def all_ids(self, texts: list[str]) -> list[list[int]]:
        return [self.model.encode_ordinary(t) for t in texts]


class PieceTokens:
    """SentencePiece ids; it puts one space before a text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = m = SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        self.bytes_of, glue, mixed = {}, set(), False
        inner = re.compile(f"(?<=[^{SPACE}])[{SPACE}]")
        for i in range(n):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif m.is_control(i) or m.is_unknown(i):
                self.bytes_of[i] = b""
            else:
                text = piece.replace("\u2581", " ")
                self.bytes_of[i] = text.encode()
                glue.update(inner.findall(text))
                mixed = mixed or re.search(f"[{LETTER}][{MARK}]", text)
        self.sizes, self.spelt, self.spelt_last = _tables(self.bytes_of, ";")
        self.before = len(m.encode("x"))
        # white space that some piece holds behind something else cuts no chunk
        glue = "".join(f"\\x{ord(c):02x}" if ord(c) < 256 else c for c in sorted(glue))
        more = f"(?:[{glue}][{SPACE}]*[^{SPACE}]*)*" if glue else ""
        # nor does any piece hold a letter and what follows a word: words end chunks, too
        word = f"[{SPACE}]*[{LETTER}]+(?=[{MARK}])|" if not mixed else ""
        self.chunks = re.compile(f"{word}[{SPACE}]*[^{SPACE}]+{more}|[{SPACE}]+")

    def whole(self, text: str) -> list[int]:
        return self.model.encode(text)

    def all_ids(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks inside a text, which get no space of their own."""
        plain = [c[0] == " " and len(c) > 1 for c in chunks]
        found = self.model.encode([c[1:] if p else "x" + c for c, p in zip(chunks, plain)], num_threads=1)
        return [ids if p else ids[self.before:] for ids, p in zip(found, plain)]


class Aligner:
    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteTokens(byte_path), PieceTokens(piece_path)
        self.known: dict[str, Aligned | None] = {}
        self.older: dict[str, Aligned | None] = {}
        self.seen: set[int] = set()

    def align(self, a: list[int], b: list[int], want: bytes) -> Aligned | None:
        """None: the tokens of one don't spell ``want``."""
        spell_a, spell_b = self.a.bytes_of, self.b.bytes_of
        bytes_a, bytes_b = [spell_a[i] for i in a], [spell_b[i] for i in b]
        if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            return None
        n_a, n_b = len(a), len(b)
        if n_a == 1 == n_b:
            return Aligned(1, 1, 1, f"{a[0]}|{b[0]}", LINK.pack(a[0] << 32 | b[0]))
        groups, links, i, j = [], [], 0, 0
        while i < n_a and j < n_b:
            first_a, first_b = i, j
            behind = len(bytes_a[i]) - len(bytes_b[j])      # how far A's token ends behind B's
            while behind:
                if behind < 0:
                    i += 1
                    behind += len(bytes_a[i])
                else:
                    j += 1
                    behind -= len(bytes_b[j])
            # tokens of no bytes end where the one before them does
            last_a, last_b = i + 1, j + 1
            while last_a < n_a and not bytes_a[last_a]:
                last_a += 1
            while last_b < n_b and not bytes_b[last_b]:
                last_b += 1
            groups.append(f"{str(a[first_a:last_a])[1:-1]}|{str(b[first_b:last_b])[1:-1]}")
            if last_a - i == 1 == last_b - j:
                links.append(LINK.pack(a[i] << 32 | b[j]))
            else:
                links += [LINK.pack(x << 32 | y) for x in a[i:last_a] for y in b[j:last_b]]
            i, j = last_a, last_b
        return Aligned(n_a, n_b, len(groups), ";".join(groups).replace(" ", ""), b"".join(links))

    def align_all(self, texts: list[str], a: list[list[int]], b: list[list[int]]) -> list[Aligned | None]:
        """``align`` of many texts at once, laid end to end."""
        flat_a, flat_b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b))
        size_a, size_b = self.a.sizes[flat_a], self.b.sizes[flat_b]
        ends_a, ends_b = size_a.cumsum(), size_b.cumsum()
        want = [t.encode() for t in texts]
        n_a, n_b, stops = (np.fromiter(map(len, x), np.int64).cumsum() for x in (a, b, want))
        spelled = lambda side, flat: b"".join(map(side.bytes_of.__getitem__, flat.tolist()))
        whole = b"".join(want)
        if not (size_a.all() and size_b.all() and len(flat_a) and np.array_equal(ends_a[n_a - 1], stops)
                and np.array_equal(ends_b[n_b - 1], stops)
                and spelled(self.a, flat_a) == whole == spelled(self.b, flat_b)):
            return [self.align(x, y, z) for x, y, z in zip(a, b, want)]
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        links = (flat_a[last_a] << 32 | flat_b[last_b]).tobytes()
        words_a, words_b = self.a.spelt[flat_a], self.b.spelt[flat_b]
        words_a[last_a], words_b[last_b] = self.a.spelt_last[flat_a[last_a]], self.b.spelt_last[flat_b[last_b]]
        # group by group, A's ids before B's
        turn = np.argsort(np.concatenate((np.searchsorted(cuts, ends_a) * 2, np.searchsorted(cuts, ends_b) * 2 + 1)),
                          kind="stable")
        words = np.concatenate((words_a, words_b))[turn].tolist()
        groups = np.searchsorted(cuts, stops, "right")
        out, w0, g0, a0, b0 = [], 0, 0, 0, 0
        for a1, b1, g1 in zip(n_a.tolist(), n_b.tolist(), groups.tolist()):
            w1 = a1 + b1
            out.append(Aligned(a1 - a0, b1 - b0, g1 - g0, "".join(words[w0:w1])[:-1], links[8 * g0:8 * g1]))
            w0, g0, a0, b0 = w1, g1, a1, b1
        return out

    def texts(self, texts: list[str | None]) -> list[Aligned]:
        """The alignment of each text.  Chunks new to the worker are encoded
        together; one is remembered when it comes for the second time, and
        forgotten when two halves of the memory have filled without it."""
        if len(self.known) > CACHE_CHUNKS // 2:
            self.known, self.older = {}, self.known
        if len(self.seen) > CACHE_CHUNKS:
            self.seen.clear()
        known, older, out = self.known, self.older, []
        cut = [self.b.chunks.findall(" " + t) if t else [] for t in texts]
        new = set().union(*cut).difference(known)
        again = new & older.keys()
        known.update((c, older[c]) for c in again)
        new = list(new - again)
        known.update(zip(new, self.align_all(new, self.a.all_ids(new), self.b.all_ids(new))))
        for text, parts in zip(texts, cut):
            found = [known[c] for c in parts]
            if not found:
                out.append(NOTHING)
            elif None not in found:
                n_a, n_b, n_groups, groups, links = zip(*found)
                out.append(Aligned(sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), b"".join(links)))
            else:
                text = " " + text
                out.append(self.align(self.a.ids(text), self.b.whole(text[1:]), text.encode()) or NOTHING)
        for c in new:
            if hash(c) not in self.seen or len(c) > CACHE_LENGTH:
                self.seen.add(hash(c))
                del known[c]
        return out


@functools.lru_cache(2)
def _aligner(byte_path: str, piece_path: str) -> Aligner:
    gc.disable()    # in a worker: many small tuples, no cycles
    return Aligner(byte_path, piece_path)


# ---- minimal perfect hashing ------------------------------------------------

def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of int64 keys, another for each seed (splitmix64)."""
    x = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cell(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 0) >> np.uint64(64 - CELL_BITS)).astype(np.int32)


class PerfectHash:
    """Distinct int64 keys to 0..n-1, one each.  Level by level, a key that is
    alone in its place of a bit vector sets the bit there; its index is the
    number of bits set before it."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))
        self.n = int(self.before[-1])

    @classmethod
    def build(cls, keys: np.ndarray, spare: float = 2.0) -> PerfectHash:
        sizes, vectors, rest = [], [], keys
        while len(rest):
            size = -(-int(spare * len(rest)) // 64) * 64 or 64
            at = (mix(rest, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            vectors.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            rest = rest[~alone[at]]
        return cls(sizes, np.concatenate(vectors) if vectors else np.empty(0, np.uint64))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; -1 or any index for keys that were not given."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = (mix(keys[open_], level + 1) % np.uint64(size)).astype(np.int64) + start
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            out[open_[hit]] = self.before[at[hit] >> 6] + below
            open_, start = open_[~hit], start + size
            if not len(open_):
                break
        return out

    def dump(self) -> bytes:
        return np.array([len(self.sizes), *self.sizes], dtype=np.uint64).tobytes() + self.words.tobytes()

    @classmethod
    def load(cls, raw: bytes) -> PerfectHash:
        numbers = np.frombuffer(raw, dtype=np.uint64)
        levels = int(numbers[0])
        return cls(numbers[1:levels + 1].tolist(), numbers[levels + 1:])


class Shard(NamedTuple):
    hash: PerfectHash
    keys: np.ndarray
    counts: np.ndarray

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """Count of each key, 0 for a key that has none."""
        at = self.hash.index(keys)
        return np.where((at >= 0) & (self.keys[at] == keys), self.counts[at], 0)


class Counts(NamedTuple):
    """All shards at once, for a broadcast."""
    bits: int
    shards: dict[int, Shard]
    best: np.ndarray        # highest count of each B id

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        at = cell(keys) >> (CELL_BITS - self.bits)
        out = np.zeros(len(keys), dtype=np.int64)
        order = np.argsort(at, kind="stable")
        cuts = np.flatnonzero(np.diff(at[order])) + 1
        for rows in np.split(order, cuts):
            if len(rows) and (shard := self.shards.get(int(at[rows[0]]))):
                out[rows] = shard.look_up(keys[rows])
        return out


# ---- first pass -------------------------------------------------------------

_OWN = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]


def spelled(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Every row's alignment, written once: ``_OWN``, links (int64 keys in
    order) and a number of the row."""
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_path, piece_path)
        long = lambda xs: pa.array(xs, pa.int64())
        for batch in batches:
            found = aligner.texts(batch.column(1).to_pylist())
            yield pa.record_batch([batch.column(0), long([x.n_a for x in found]), long([x.n_b for x in found]),
                                   long([x.n_groups for x in found]), long([len(x.links) // 8 for x in found]),
                                   pa.array([x.groups for x in found], pa.string()),
                                   pa.array([x.links for x in found], pa.binary())], [*_OWN, "links"])

    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, links binary"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(spell, schema)
    with text_batches(docs.sparkSession, BATCH_ROWS):
        return stage(rows.withColumn("_rid", F.monotonically_increasing_id()), "spelled", "zstd")


def _slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """Rows from, rows to and their links, about ``LOOK_LINKS`` at a time."""
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64) // 8
    cuts = np.flatnonzero(np.diff(ends // LOOK_LINKS, prepend=0)) + 1
    for lo, hi in pairwise([0, *cuts[cuts < len(column)].tolist(), len(column)]):
        yield lo, hi, np.frombuffer(b"".join(column.slice(lo, hi - lo).to_pylist()), np.int64)


def pair_counts(rows: DataFrame) -> DataFrame:
    """Links of all rows of ``spelled``, counted within tasks: task, cell, key, n."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        _aligner.cache_clear()      # of this worker's first pass
        task = TaskContext.get().partitionId()
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def rows(keys, counts):
            return pa.record_batch([pa.array(np.full(len(keys), task, np.int32)), pa.array(cell(keys)),
                                    pa.array(keys), pa.array(counts)], ["task", "cell", "key", "n"])

        for _, _, links in chain.from_iterable(_slices(b.column(0)) for b in batches):
            k, n = np.unique(links, return_counts=True)
            keys, at = np.unique(np.concatenate((keys, k)), return_inverse=True)
            counts = np.bincount(at, np.concatenate((counts, n)), len(keys)).astype(np.int64) \
                if len(keys) else np.empty(0, np.int64)
            if len(keys) > FLUSH:
                yield rows(keys, counts)
                keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        if len(keys):
            yield rows(keys, counts)

    return rows.select("links").mapInArrow(count, "task int, cell int, key bigint, n bigint")


class PairTable(NamedTuple):
    """shards: shard, fn, keys, counts (both in the order of the hash).
    best: b, most."""
    bits: int
    n_pairs: int
    shards: DataFrame
    best: DataFrame


def count_pairs(docs: DataFrame, byte_path: str, piece_path: str, shard_pairs: int = SHARD_PAIRS,
                slice_rows: int = SLICE_ROWS) -> PairTable:
    return count_links(spelled(docs, byte_path, piece_path), shard_pairs, slice_rows)


def count_links(rows: DataFrame, shard_pairs: int = SHARD_PAIRS, slice_rows: int = SLICE_ROWS) -> PairTable:
    """The counted links of ``spelled``."""
    with text_batches(rows.sparkSession):
        told = stage(pair_counts(rows), "pairs")
    keys = stage(told.select("cell", "key").distinct(), "keys")
    n_pairs, n_rows = keys.count(), told.count()
    bits = min(CELL_BITS, max(0, (max(n_pairs, 1) - 1) // shard_pairs).bit_length())
    shard = F.shiftright("cell", CELL_BITS - bits).alias("shard")

    def functions(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_numpy()
        fn = PerfectHash.build(keys)
        ordered = np.empty(len(keys), np.int64)
        ordered[fn.index(keys)] = keys
        return pa.table({"shard": table.column("shard")[:1].cast(pa.int32()), "fn": pa.array([fn.dump()], pa.binary()),
                         "keys": pa.array([ordered.tobytes()], pa.binary())})

    fns = stage(keys.select(shard, "key").groupBy("shard").applyInArrow(functions, "shard int, fn binary, keys binary"),
                "functions")
    slices = max(1, -(-n_rows // (slice_rows << bits)))

    def vector(rows: pa.Table, fn: pa.Table) -> pa.Table:
        hash_ = PerfectHash.load(fn.column("fn")[0].as_py())
        counts = np.zeros(hash_.n, np.int64)
        np.add.at(counts, hash_.index(rows.column("key").to_numpy()), rows.column("n").to_numpy())
        return pa.table({"shard": fn.column("shard")[:1], "part": fn.column("part")[:1],
                         "counts": pa.array([counts.tobytes()], pa.binary())})

    part = F.pmod(F.col("task"), F.lit(slices)).cast("int").alias("part")
    left = told.select(shard, part, "key", "n").groupBy("shard", "part")
    right = fns.select("shard", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("part"), "fn") \
        .groupBy("shard", "part")
    vectors = left.cogroup(right).applyInArrow(vector, "shard int, part int, counts binary")

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_py(), np.int64) for c in table.column("counts"))
        return pa.table({"shard": table.column("shard")[:1], "part": table.column("part")[:1],
                         "counts": pa.array([total.tobytes()], pa.binary())})

    while slices > 1:
        vectors = vectors.withColumn("part", F.floor(F.col("part") / FAN).cast("int")) \
            .groupBy("shard", "part").applyInArrow(add, "shard int, part int, counts binary")
        slices = -(-slices // FAN)
    shards = stage(fns.join(vectors.drop("part"), "shard"), "counts")

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, c in zip(batch.column(0), batch.column(1)):
                b = np.frombuffer(k.as_py(), np.int64) & 0xFFFFFFFF
                ids, at = np.unique(b, return_inverse=True)
                most = np.zeros(len(ids), np.int64)
                np.maximum.at(most, at, np.frombuffer(c.as_py(), np.int64))
                yield pa.record_batch([pa.array(ids), pa.array(most)], ["b", "most"])

    # one row for each id of the B vocabulary at most
    best = shards.select("keys", "counts").mapInArrow(highest, "b bigint, most bigint").groupBy("b").agg(F.max("most").alias("most"))
    return PairTable(bits, n_pairs, shards, stage(best, "best"))


def pairs(table: PairTable) -> DataFrame:
    """The counted pairs: a, b, count."""
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, c in zip(batch.column(0), batch.column(1)):
                keys = np.frombuffer(k.as_py(), np.int64)
                yield pa.record_batch([pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF),
                                       pa.array(np.frombuffer(c.as_py(), np.int64))], ["a", "b", "count"])
    return table.shards.select("keys", "counts").mapInArrow(spell, "a bigint, b bigint, count bigint")


# ---- second pass ------------------------------------------------------------

def _by_broadcast(rows: DataFrame, table: PairTable) -> DataFrame:
    most = {r["b"]: r["most"] for r in table.best.collect()}
    best = np.zeros(max(most, default=0) + 1, np.int64)
    best[list(most)] = list(most.values())
    shards = {r["shard"]: (bytes(r["fn"]), bytes(r["keys"]), bytes(r["counts"])) for r in table.shards.collect()}
    shared = rows.sparkSession.sparkContext.broadcast((table.bits, shards, best))

    @F.arrow_udf("struct<n_best bigint, count_sum bigint>")
    def find(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        _aligner.cache_clear()
        bits, raw, best = shared.value
        counts = Counts(bits, {s: Shard(PerfectHash.load(f), np.frombuffer(k, np.int64), np.frombuffer(c, np.int64))
                               for s, (f, k, c) in raw.items()}, best)
        for column in columns:
            sizes = pc.binary_length(column).to_numpy(zero_copy_only=False) // 8
            out = np.zeros((2, len(column)), np.int64)
            for lo, hi, links in _slices(column):
                keys, at = np.unique(links, return_inverse=True)
                n = counts.look_up(keys)
                top = n == best[keys & 0xFFFFFFFF]
                starts = np.concatenate(([0], np.cumsum(sizes[lo:hi], dtype=np.int64)))
                for total, x in zip(out, (top, n)):
                    total[lo:hi] = np.diff(np.concatenate(([0], np.cumsum(x[at], dtype=np.int64)))[starts])
            yield pa.StructArray.from_arrays([pa.array(x) for x in out], ["n_best", "count_sum"])

    found = rows.select(*_OWN, find("links").alias("_found")).select(*_OWN, "_found.n_best", "_found.count_sum")
    with text_batches(rows.sparkSession):
        return stage(found, "aligned", "zstd")


def _by_shards(rows: DataFrame, table: PairTable, slice_rows: int) -> DataFrame:
    """The same with the links sent to the shards: nothing is broadcast."""
    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, links in zip(batch.column(0).to_pylist(), batch.column(1)):
                ks, ms = np.unique(np.frombuffer(links.as_py(), np.int64), return_counts=True)
                yield pa.record_batch([pa.array(np.full(len(ks), rid, np.int64)), pa.array(cell(ks)), pa.array(ks), pa.array(ms)],
                                      ["_rid", "cell", "key", "m"])

    links = rows.select("_rid", "links").mapInArrow(tell, "_rid bigint, cell int, key bigint, m bigint").select(
        "_rid", F.shiftright("cell", CELL_BITS - table.bits).alias("shard"), "key", "m")
    n = links.count()
    slices = max(1, -(-n // (slice_rows << table.bits)))
    links = links.withColumn("part", F.pmod(F.xxhash64("_rid"), F.lit(slices)).cast("int"))
    shards = table.shards.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))

    def look(rows: pa.Table, shard: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"_rid": pa.array([], pa.int64()), "b": pa.array([], pa.int64()),
                             "m": pa.array([], pa.int64()), "count": pa.array([], pa.int64())})
        s = Shard(PerfectHash.load(shard.column("fn")[0].as_py()), np.frombuffer(shard.column("keys")[0].as_py(), np.int64),
                  np.frombuffer(shard.column("counts")[0].as_py(), np.int64))
        keys = rows.column("key").to_numpy()
        return pa.table({"_rid": rows.column("_rid"), "b": pa.array(keys & 0xFFFFFFFF), "m": rows.column("m"),
                         "count": pa.array(s.look_up(keys))})

    known = (links.groupBy("shard", "part").cogroup(shards.groupBy("shard", "part"))
             .applyInArrow(look, "_rid bigint, b bigint, m bigint, count bigint")
             .join(F.broadcast(table.best), "b")        # the B vocabulary at most
             .groupBy("_rid").agg(F.sum(F.when(F.col("count") == F.col("most"), F.col("m")).otherwise(0)).alias("n_best"),
                                  F.sum(F.col("count") * F.col("m")).alias("count_sum")))
    none = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.drop("links").join(known, "_rid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", none("n_best"), none("count_sum"))


def align(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None,
          broadcast_pairs: int = BROADCAST_PAIRS, shard_pairs: int = SHARD_PAIRS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, groups
    (``a1,a2|b1;a3|b2``), n_best (links whose count is the highest that their B
    id has, ties included), count_sum (over links).

    Texts are read whole.  Null and empty texts, and texts which a tokenizer does not give
    back byte for byte, have no tokens: zeros and empty groups.  Repeated rows
    count as often as they occur; an empty table gives no rows.  Columns but doc_id and
    text are not looked at.
    """
    byte_path, piece_path = byte_path or tokenizer_path(BYTE_BPE), piece_path or tokenizer_path(PIECE_BPE)
    rows = spelled(docs, byte_path, piece_path)
    table = count_links(rows, shard_pairs, slice_rows)
    return _by_broadcast(rows, table) if table.n_pairs <= broadcast_pairs else _by_shards(rows, table, slice_rows)


def alignment_digests(docs: DataFrame) -> DataFrame:
    """``align`` with the groups as their sha256, empty for no tokens."""
    found = align(docs)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                        digest.alias("groups_sha256"))
