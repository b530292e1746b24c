"""Token alignment and best-fit packing: brute force with the tokenizers
themselves, both lookup paths, odd texts."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from viewtally.llm import best_fit, queries, token_align

SF = "/root/testdata/sf0.01"
ODD = ["", None, " ", "  ", "a  b", "\n\nfoo", "a▁b", "a\tb\n c ", "\x00a", "ﬁ é Å", "x y   z", "a \n\n  b",
       "  \nbar", "<|endoftext|> a<s></s>", "<|startoftext|>x <|ENDOFTEXT|>", "한국어 中文\U0001f642 á",
       "\x1c a\x1db \x85c", "don't  'S ’s we'll 12ab", " " * 50 + "a" + " " * 9, "a;\r\n\r\n b\r\n", "a \rb;\r c",
       "İstanbul ΣΣ abΣ", "J̌ab İ", "﻿a​b a　　b", "x" * 3000 + " " + "ab1" * 500, "the " * 20_000]


@pytest.fixture(scope="module")
def paths():
    return tuple(map(token_align.tokenizer_path, (token_align.BYTE_BPE, token_align.PIECE_BPE)))


def texts(spark):
    return [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]


def brute(text, a_model, b_model, bytes_a, bytes_b):
    """Groups as lists of ids and links, token by token."""
    if not text:
        return [], [], [], []
    want = (" " + text).encode()
    a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
    if b"".join(bytes_a[i] for i in a) != want or b"".join(bytes_b[i] for i in b) != want:
        return [], [], [], []
    ends = lambda ids, spell: np.cumsum([len(spell[i]) for i in ids]).tolist()
    ea, eb = ends(a, bytes_a), ends(b, bytes_b)
    cuts, groups = sorted(set(ea) & set(eb)), []
    for lo, hi in zip([0, *cuts], cuts):
        groups.append(([i for i, e in zip(a, ea) if lo < e <= hi], [i for i, e in zip(b, eb) if lo < e <= hi]))
    return a, b, groups, [(ga[-1], gb[-1]) for ga, gb in groups]


@pytest.mark.parametrize("limits", [{}, {"broadcast_pairs": 0, "shard_pairs": 100, "slice_rows": 20}])
def test_alignment_equals_brute_force(spark, paths, limits):
    a_model, b_model = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a_model.encode_special_tokens = True
    own = token_align.Aligner(*paths)
    rows = list(enumerate([*ODD, *texts(spark)[::12]])) + [(3, "a  b"), (None, "the the")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_a": F.lit("x"), "links": F.lit(1)})
    told = [brute(t, a_model, b_model, own.a.bytes_of, own.b.bytes_of) for _, t in rows]
    count = Counter(x for *_, links in told for x in links)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    spell = lambda groups: ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
    want = [(str(i), len(a), len(b), len(g), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), spell(g))
            for (i, _), (a, b, g, links) in zip(rows, told)]
    got = [(str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups)
           for r in token_align.align(df, **limits).collect()]
    assert sorted(got) == sorted(want) and sum(w[1] == 0 for w in want) >= 3
    table = token_align.count_pairs(df, *paths, limits.get("shard_pairs", 1 << 16), limits.get("slice_rows", 1 << 20))
    assert {(r.a, r.b): r["count"] for r in token_align.pairs(table).collect()} == dict(count)
    assert token_align.align(df.limit(0), **limits).count() == 0


def test_a_text_is_encoded_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(text):
        read.add(1)
        return text

    rows = [(i, t) for i, t in enumerate(ODD[:20])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text", told("text"))
    assert len(token_align.align(df).collect()) == 20 and read.value == 20


def test_slices_hold_every_link_once(monkeypatch):
    monkeypatch.setattr(token_align, "LOOK_LINKS", 10)
    rng = random.Random(2)
    for _ in range(200):
        links = [np.array([rng.randrange(9) for _ in range(rng.choice([0, 0, 1, 3, 25]))], np.int64) for _ in range(rng.randrange(0, 30))]
        got = list(token_align._slices(pa.array([x.tobytes() for x in links], pa.binary())))
        assert [x for lo, hi, _ in got for x in range(lo, hi)] == list(range(len(links)))
        for lo, hi, flat in got:
            assert flat.tolist() == [int(x) for doc in links[lo:hi] for x in doc] and sum(map(len, links[lo:hi - 1])) < 20


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal_and_keys_are_verified(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 47, n))
    fn = token_align.PerfectHash.load(token_align.PerfectHash.build(keys).dump())
    assert sorted(fn.index(keys).tolist()) == list(range(len(keys)))
    at = np.empty(len(keys), np.int64)
    at[fn.index(keys)] = keys
    shard = token_align.Shard(fn, at, at % 97 + 1)
    other = np.setdiff1d(rng.integers(0, 1 << 47, 1000), keys)
    if n:
        assert (shard.look_up(keys) == keys % 97 + 1).all() and not shard.look_up(other).any()


def first_fit_brute(lengths, cap):
    bins = []
    for x in sorted(lengths, reverse=True):
        fit = [b for b in range(len(bins)) if bins[b] >= x]
        if fit:
            bins[min(fit, key=lambda b: bins[b])] -= x
        else:
            bins.append(cap - x)
    return sorted(bins)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(3)
    for _ in range(200):
        cap = rng.choice([10, 64, 100, 257])
        lengths = [rng.randrange(1, cap + 1) for _ in range(rng.randrange(0, 120))]
        fill = {}
        for length, first, last, seq, each, used in best_fit.plan(Counter(lengths), cap):
            for r in range(first, last + 1):
                b, at = seq + (r - first) // each, used + (r - first) % each * length
                assert fill.get(b, 0) == at
                fill[b] = at + length
        assert sorted(cap - x for x in fill.values()) == first_fit_brute(lengths, cap)


def test_tightest_capacity():
    rng = random.Random(8)
    tree, have = best_fit.Capacities(300), set()
    for _ in range(2000):
        c = rng.randrange(301)
        tree.set(c, c not in have)
        have ^= {c}
        q = rng.randrange(301)
        assert tree.tightest(q) == min((x for x in have if x >= q), default=-1)


@pytest.mark.parametrize("plan_rows", [best_fit.PLAN_ROWS, 0])
def test_packing_holds_every_id_in_its_place(spark, plan_rows):
    model = Tokenizer.from_file(best_fit.tokenizer_path())
    rows = list(enumerate([*ODD, *texts(spark)[::9]])) + [(3, "a  b"), (3, "a  b"), (None, "the the")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"length": F.lit("x"), "offset": F.lit(1)})
    packed = best_fit.place(best_fit.pieces(df, 300), 300, plan_rows).collect()
    want = Counter((str(i), tuple(model.encode(t or "", add_special_tokens=False).ids) + (0,)) for i, t in rows)
    by_doc, fill = {}, {}
    for r in packed:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert r.length == len(ids) <= 300 and r.start == 300 * r.piece
        by_doc.setdefault((str(r.doc_id), r.piece), []).append(ids)
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for (i, ids), n in want.items():
        for k in range(0, len(ids), 300):
            assert by_doc[i, k // 300].count(list(ids[k:k + 300])) >= n
    assert sum(map(len, by_doc.values())) == sum(n * -(-len(ids) // 300) for (_, ids), n in want.items())
    for places in fill.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 300
    lengths = [r.length for r in packed]
    assert len(fill) == len(first_fit_brute(lengths, 300)) and sorted(fill) == list(range(len(fill)))
    assert best_fit.place(best_fit.pieces(df.limit(0))).count() == 0


def test_sequences_are_the_ids_in_order(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    packed = best_fit.pack(df).cache()
    ids = {(r.sequence_id, r.offset): bytes(r.ids) for r in packed.collect()}
    for s in best_fit.sequences(packed).collect():
        assert s.length == len(s.ids) // 4 <= best_fit.CAPACITY
        for offset in s.offsets:
            part = ids[s.sequence_id, offset]
            assert bytes(s.ids)[4 * offset:4 * offset + len(part)] == part


def test_query_digests_are_those_of_the_ids(spark):
    model = Tokenizer.from_file(best_fit.tokenizer_path())
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.best_fitted(spark, SF).collect()
    assert got[0].asDict().keys() >= {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    for r in got[::25]:
        ids = model.encode(docs[r.doc_id], add_special_tokens=False).ids + [0]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
