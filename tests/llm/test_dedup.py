"""Exact, near and substring dedup against brute force, on small and odd tables."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from viewtally.llm import exact_dedup, simhash, substring_dedup
from viewtally.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _id string, _row int, size string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1, "y") for i, t in rows], DOCS)


def passage(rng, n):
    return " ".join(f"w{rng.randrange(40)}x{rng.randrange(50)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    shared = [passage(rng, 60) for _ in range(3)]
    out = [(i, passage(rng, rng.randrange(1, 90))) for i in range(60)]
    out += [(100 + i, f"{passage(rng, 12)} {shared[i % 3]} {passage(rng, 9)}") for i in range(12)]
    out += [(200 + i, out[i][1]) for i in range(10)] + [(300, out[0][1]), (301, out[0][1])]
    long = passage(rng, 3000)
    out += [(400, long), (401, long.replace("w1x", "q1x")), (402, "a " * 120), (403, "a b " * 30),
            (500, None), (501, ""), (502, " \n\t "), (503, "one"), (7, out[7][1]), (7, out[7][1]), (None, "no id"),
            (504, "ÄÖ\u00a0x é\u2003y " * 15)]
    return out


def test_exact_dedup(spark, rows):
    got = exact_dedup.dedup_decisions(table(spark, rows)).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    left = exact_dedup.drop_exact_copies(table(spark, rows))
    assert left.columns == table(spark, rows).columns
    assert sorted(r.text or "" for r in left.collect()) == sorted(groups)


def test_exact_dedup_compares_bytes(spark, rows):
    """A hash with collisions changes nothing."""
    t = table(spark, rows)
    weak = exact_dedup.dedup_decisions(t, lambda c: F.length(c) % 7)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(weak.collect(), key=key) == sorted(exact_dedup.dedup_decisions(t).collect(), key=key)


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else \
        ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


@pytest.mark.parametrize("cell", [simhash.CELL, 2])
def test_near_dedup(spark, rows, cell):
    got = simhash.near_dedup(table(spark, rows), cell=cell).collect()
    assert len(got) == len(rows)
    prints = sorted({brute_fingerprint(t) for _, t in rows})
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root = [root[j] if r == root[i] else r for r in root]
    comp = dict(zip(prints, root))
    low = {}
    for i, t in rows:
        c = comp[brute_fingerprint(t)]
        low[c] = min(low.get(c, 10**9), -1 if i is None else i)
    expect = sorted((str(i), f"{(p := brute_fingerprint(t)):016x}", low[comp[p]]) for i, t in rows)
    assert expect == sorted((str(r.doc_id), r.fingerprint, -1 if r.component_id is None else r.component_id) for r in got)


def test_links_lose_none(spark):
    """Random fingerprints and chains of close ones: same components as all pairs."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = base[rng.integers(0, 300, 900)]
    for _ in range(4):
        near = near ^ (np.uint64(1) << rng.integers(0, 64, 900, dtype=np.uint64))
    chain = base[:40].copy()
    for k in range(1, 40):
        chain[k] = chain[k - 1] ^ np.uint64(0b1111 << (k % 60))
    fp = np.unique(np.concatenate([base, near, chain]))
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    for cell in (simhash.CELL, 3):
        found = {r.node: r.root for r in components(simhash.links(df, cell=cell)).collect()}
        close = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4
        label = np.arange(len(fp))
        while True:
            new = np.where(close, label[None, :], len(fp)).min(axis=1)
            if (new == label).all():
                break
            label = new
        got = [found.get(int(x), int(x)) for x in fp.view(np.int64)]
        pairs = {(a, b) for a, b in zip(label.tolist(), got)}
        assert len(pairs) == len(set(label.tolist())) == len(set(got))


def test_drop_near_copies_keeps_one_of_each(spark, rows):
    t = table(spark, [r for r in rows if r[0] is not None])
    groups = {r.component_id for r in simhash.near_dedup(t).collect()}
    left = simhash.drop_near_copies(t)
    assert left.columns == t.columns and sorted(r.doc_id for r in left.collect()) == sorted(groups)


def brute_substring(rows, span):
    """Documents are (doc_id, text) once, in (doc_id, text key) order."""
    docs = sorted({(-(1 << 63) if i is None else i, np.uint64(xxhash.xxh64_intdigest((t or "").encode(), 42)).astype(np.int64), t or "")
                   for i, t in rows})
    seen, out = set(), {}
    for i, _, t in docs:
        w = t.encode().split()
        gone = set()
        for p in range(len(w) - span + 1):
            g = tuple(w[p:p + span])
            if g in seen:
                gone |= set(range(p, p + span))
            seen.add(g)
        left = [x for k, x in enumerate(w) if k not in gone]
        out[i, t] = (len(w), len(gone), hashlib.sha256(b" ".join(left)).hexdigest())
    return sorted((str(i),) + out[-(1 << 63) if i is None else i, t or ""] for i, t in rows)


@pytest.mark.parametrize("bits", [substring_dedup.FILTER_BITS, substring_dedup.PAGE_BITS])
def test_substring_dedup(spark, rows, bits):
    got = substring_dedup.substring_dedup(table(spark, rows), filter_bits=bits).collect()
    assert brute_substring(rows, 20) == sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got)


def test_substring_dedup_when_all_seeds_pass(spark, rows, monkeypatch):
    """A full filter costs time, never rows."""
    monkeypatch.setattr(substring_dedup, "_bloom", lambda seeds, most: np.full(1 << 17, 255, np.uint8))
    got = substring_dedup.substring_dedup(table(spark, rows)).collect()
    assert brute_substring(rows, 20) == sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got)


@pytest.mark.parametrize("make", [
    exact_dedup.dedup_decisions, exact_dedup.drop_exact_copies, simhash.near_dedup, simhash.drop_near_copies,
    substring_dedup.substring_dedup])
def test_empty_table(spark, make):
    assert make(table(spark, [])).count() == 0
