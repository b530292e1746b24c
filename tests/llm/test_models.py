"""Language ID, toxicity and nearest neighbours: held-out accuracy, brute force, odd rows."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from viewtally.llm import ann_hilbert, langid, queries, toxicity
from viewtally.llm.common import bounded_sample

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    got = queries.languages(spark, SF)
    assert got.columns[:3] == ["doc_id", "lang_pred", "score"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = got.join(docs, "doc_id").filter("held_out and lang is not null").collect()
    assert len(held) > 150 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in held)


def test_language_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "", "de"),
            (5, "12 34 !!", "en"), (6, "the the and", None), (6, "the the and", None), (None, "und der", "de"),
            (7, "katzen " * 50000, "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(
        {"score": F.lit("mine"), "lang_pred": F.lit(1), "t": F.lit(2)})
    model = langid.fit(df.filter("doc_id < 5"))
    got = {(r.doc_id, i): r for i, r in enumerate(langid.predict_languages(df, model).collect())}
    pred = {k[0]: r.lang_pred for k, r in got.items()}
    assert len(got) == len(rows) and pred[6] == "en" and pred[None] == "de" and pred[7] == "de"
    assert pred[3] == pred[4] == pred[5] == "und"
    kept = langid.keep_identified(df, model)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "6", "6", "7", "None"]
    none = langid.fit(df.limit(0))
    assert {r.lang_pred for r in langid.predict_languages(df, none).collect()} == {"und"}
    assert langid.predict_languages(df.limit(0), model).count() == 0


def test_every_language_is_learnt(spark):
    """More languages than 200; the rarest by rows is as good as any."""
    rng = np.random.default_rng(5)
    say = {f"l{i:03}": ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(5)] for i in range(230)}
    rows = [(x, w) for x, w in say.items() for _ in range(3 if x < "l200" else 2)]
    learn = spark.createDataFrame([(i, " ".join(w), x) for i, (x, w) in enumerate(rows)], "doc_id long, text string, lang string")
    model = langid.fit(learn)
    assert model.langs == sorted(say)
    assert len(model.rows.lang) < len(model.rows) * 20  # not token x language
    held = spark.createDataFrame([(i, " ".join(w[:3]), x) for i, (x, w) in enumerate(say.items())], learn.schema)
    got = {r.doc_id: r.lang_pred for r in langid.predict_languages(held, model).collect()}
    assert [got[i] for i in range(len(say))] == list(say)


@pytest.mark.parametrize("langs", [1, 3, 4, 5])
def test_unknown_script_is_rejected_at_any_number_of_languages(spark, langs):
    say = ["the cat and the dog", "der Hund und die Katze", "le chat et le chien", "il gatto e il cane", "a gata e o cachorro"]
    learn = spark.createDataFrame([(i, t, f"l{i}") for i, t in enumerate(say[:langs])], "doc_id long, text string, lang string")
    docs = learn.union(spark.createDataFrame([(10, "\u043a\u043e\u0442 \u0438 \u043f\u0451\u0441", None),
                                              (11, "the cat", None), (12, "12", None)], learn.schema))
    kept = {r.doc_id for r in langid.keep_identified(docs, langid.fit(learn)).collect()}
    assert kept == {*range(langs), 11}
    nothing = langid.fit(learn.limit(0))
    assert {r.doc_id for r in langid.keep_identified(docs, nothing).collect()} == {*range(langs), 10, 11}


def test_all_grams_of_a_word_are_learnt(spark):
    model = langid.fit(spark.createDataFrame([(1, "katze", "de")], "doc_id long, text string, lang string"))
    assert {n: set(g) for n, g in model.grams.items()} == {
        n: {"<katze>"[i:i + n] for i in range(8 - n)} for n in langid.ORDERS}


def test_sparse_scores_are_the_dense_ones(monkeypatch):
    rng = np.random.default_rng(6)
    counts = rng.integers(0, 3, (40, 7)) * rng.integers(1, 9, (40, 7))
    counts[:, 0] += 1
    langs, (t, x) = list("abcdefg"), np.nonzero(counts)
    place, got = langid._scores(pa.table({"w": [f"w{i}" for i in t], "lang": [langs[i] for i in x], "n": counts[t, x]}), langs, "w")
    assert place == {f"w{i}": i for i in range(40)}
    want = np.log(counts + 0.5) - np.log(counts.sum(axis=0) + 20)
    joined = langid._joined([got, got], 7)
    sizes = np.array([1, 3, 40, 9])
    ids = rng.integers(0, 80, sizes.sum())
    ids[1:4], ids[4:44], ids[44:] = ids[1:4] % 40, ids[4:44] % 40 + 40, ids[44:] % 40
    for cells in (langid.CELLS, 56 * 3):
        monkeypatch.setattr(langid, "CELLS", cells)
        for s, (a, b) in zip(joined.means(ids, sizes), ((0, 1), (1, 4), (4, 44), (44, 53))):
            w = want[ids[a:b] % 40].mean(axis=0)
            assert np.allclose(s - s.mean(), w - w.mean())
    assert not joined.means(np.array([80]), np.array([1])).any()


@pytest.mark.parametrize("most, cell_bits", [(1, 16), (7, 16), (40, 3), (40, 1), (10000, 16)])
def test_bounded_sample_is_the_least_hashes(spark, most, cell_bits):
    rows = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "big")
                                   .when(F.col("id") % 2 > 0, "mid").alias("lang"), F.lit("x").alias("_n"))
    got = bounded_sample(rows, "lang", "doc_id", most, cell_bits)
    assert got.columns == rows.columns
    hashed = rows.withColumn("h", F.xxhash64("doc_id")).collect()
    want = {r.doc_id for g in ("big", "mid", None)
            for r in sorted((r for r in hashed if r.lang == g), key=lambda r: r.h)[:most]}
    found = [r.doc_id for r in got.collect()]
    assert len(found) == len(want) and set(found) == want
    assert bounded_sample(rows.limit(0), "lang", "doc_id", most, cell_bits).count() == 0


def test_backoff_goes_to_shorter_grams():
    rows = np.array([[2.0, -2.0], [1.0, -1.0], [-3.0, 3.0], [0.0, 0.0]])
    m = langid.Model(["a", "b"], {"known": 0}, {4: {"<unk": 1}, 1: {"z": 2}}, rows)
    r = langid.Reader(m)
    assert r._rows("known") == [0] and r._rows("unkn") == [1] and r._rows("zz") == [2, 2] and r._rows("q") == [3]
    assert r.predict("known q")[0] == "a" and r.predict("zz zz known")[0] == "b"


def brute_segments(scores):
    """Maximal scoring subsequences by their recursive definition."""
    best, at = 0, None
    for a, b in itertools.combinations(range(len(scores) + 1), 2):
        s = sum(scores[a:b])
        if s > best + 1e-9:
            best, at = s, (a, b)
    if at is None:
        return []
    a, b = at
    left = brute_segments(scores[:a])
    right = [(x + b, y + b) for x, y in brute_segments(scores[b:])]
    return left + [at] + right


def test_segments_match_definition():
    rng = np.random.default_rng(1)
    for _ in range(150):
        n = int(rng.integers(1, 14))
        place = np.flatnonzero(rng.random(n) < 0.6)
        s = rng.choice([-3.0, -1.25, 1.0, 2.5, 4.125], len(place))
        dense = np.full(n, -0.37)
        dense[place] = s
        got = [(a, b) for a, b, _ in toxicity.segments(place, s, 0.37)]
        assert got == brute_segments(dense.tolist())


def test_segments_are_linear():
    n = 200_000
    s = np.where(np.arange(n) % 2 == 0, 1.0, -1.1)
    assert len(toxicity.segments(np.arange(n), s, 0.1)) == n // 2


def test_toxicity_held_out(spark):
    got = queries.toxic(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = got.join(labels, "doc_id").filter("held_out").collect()
    clean = [r.predicted for r in held if r.toxic == 0]
    toxic = [r.predicted for r in held if r.toxic == 1]
    assert np.mean(clean) < 0.02 and np.mean(toxic) > 0.75
    assert got.count() == spark.read.parquet("/root/testdata/sf0.1/documents.parquet").count()


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(i, "good " * 5 + ("vile" if i % 2 else "nice")) for i in range(60)]
                                 + [(100, None), (101, ""), (101, ""), (None, "vile"), (102, "nice " * 60000 + "vile " * 20)],
                                 "doc_id long, text string").withColumns({"score": F.lit("x"), "n": F.lit(1)})
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(100, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, toxicity.learns_from())
    got = toxicity.toxic_passages(docs, model).collect()
    assert len(got) == 65 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1].score > by[2].score and by[None].score > by[100].score == by[101].score
    assert [(p.start, p.end) for p in by[1].passages] == [(5, 6)]
    assert (by[102].passages[-1].start, by[102].passages[-1].end) == (60000, 60020)
    none = toxicity.fit(docs, labels.limit(0), toxicity.learns_from())
    assert len({r.score for r in toxicity.toxic_passages(docs, none).collect()}) == 1
    assert toxicity.toxic_passages(docs.limit(0), model).count() == 0


def test_hilbert_curve_is_one():
    """Every cell once, neighbours on the curve are neighbours in the grid."""
    for d, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.array(list(itertools.product(range(1 << bits), repeat=d)))
        key = ann_hilbert.hilbert_key(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def brute_nearest(rows, k):
    out = []
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], dtype=np.float64)
    for i, q in zip(ids, x):
        if i % 50 == 0:
            s = (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))
            order = sorted((-round(c, 12), j) for c, j in zip(s.tolist(), ids) if j != i)[:k]
            out += [(i, n + 1, j, -c) for n, (c, j) in enumerate(order)]
    return sorted(out)


def test_nearest_is_exact_in_one_block_with_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).round(3).tolist()) for i in range(160)]
    rows += [(200 + i, rows[0][1]) for i in range(12)] + [(250, rows[0][1])]
    odd = [(300, None), (350, [0.0] * 8), (400, [float("nan")] * 8), (450, [1.0, None] + [0.0] * 6), (500, [1.0]),
           (550, []), (600, [float("inf")] * 8), (None, rows[1][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x"))
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in ann_hilbert.nearest(df).collect())
    assert got == brute_nearest(rows, 5)
    few = ann_hilbert.nearest(df.filter("vec_id in (0, 1, 50)")).collect()
    assert len(few) == 4
    assert ann_hilbert.nearest(df.limit(0)).count() == 0 and ann_hilbert.nearest(df.filter("vec_id = 300")).count() == 0


@pytest.mark.parametrize("clustered", [False, True])
def test_nearest_recall_over_many_blocks(spark, clustered):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 32))
    if clustered:
        x = x[rng.integers(0, 60, 3000)] + 0.2 * rng.normal(size=(3000, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = ann_hilbert.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=64).collect()
    true = {(q, j) for q, _, j, _ in brute_nearest(rows, 5)}
    assert len(got) == len(true) == 300
    assert len(true & {(r.query_id, r.vec_id) for r in got}) / len(true) >= 0.9
