"""Packing, mixing, chat format, URL filter, pipeline."""

import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from viewtally.llm import chat_format, mixing, packing, queries, url_filter

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    expect = db.execute(queries.ORACLE[name])
    columns = [c[0] for c in expect.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    order = lambda rows: sorted(rows, key=str)
    assert order(map(tuple, got.select(*columns).collect())) == order(expect.fetchall())


def padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in histogram.items())


def test_boundaries_are_optimal():
    rng = random.Random(1)
    for _ in range(60):
        h = {rng.randrange(1, 40): rng.randrange(1, 9) for _ in range(rng.randrange(1, 9))}
        for k in range(1, 5):
            got = packing.boundaries(h, k)
            tries = [c for n in range(1, k + 1) for c in itertools.combinations(sorted(h), n) if c[-1] == max(h)]
            assert padding(h, got) == min(padding(h, c) for c in tries) and len(got) <= k
    assert packing.boundaries({}) == []


def test_pack_holds_every_token_once(spark):
    rows = [(i, "w " * (i * 7 % 50)) for i in range(200)] + [(5, "w " * 35)] * 3 + \
        [(300, "w " * 1003), (301, None), (302, ""), (None, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"length": F.lit("x"), "batch": F.lit(0)})
    packed = packing.pack(df, max_len=100, buckets=3, budget=400)
    got = packed.collect()
    want = {}
    for i, t in rows:
        want[i] = want.get(i, 0) + len((t or "").split())
    have = {}
    for r in got:
        have[r.doc_id] = have.get(r.doc_id, 0) + r.length
        assert r.length <= r.bucket_len and r.start == r.piece * 100
    assert have == {i: n for i, n in want.items() if n}
    groups = packing.batches(packed).collect()
    for g in groups:
        room = max(400 // g.bucket_len, 1)
        last = max(x.batch for x in groups if x.bucket_len == g.bucket_len)
        assert g.n == len(g.pieces) == g.pieces[-1].slot + 1 and (g.n == room or g.batch == last and g.n < room)
    assert packing.pack(df.limit(0)).count() == 0


def brute_targets(sizes):
    """Rounds of sharing by weight, as the rule is told."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, free, out = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        total = sum(w[s] for s in free)
        over = {s for s in free if left * w[s] / total > 2 * sizes[s]}
        if not over:
            return out | {s: left * w[s] / total for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_targets_and_mix(spark):
    rng = random.Random(2)
    for sizes in ({"a": 10, "b": 1000, "c": 5, None: 70}, {"z": 5}, {"a": 0, "b": 9}, {None: 4, "é": 8, "Z": 900, "z": 3},
                  {f"s{i}": rng.randrange(1000) for i in range(30)}):
        got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        want = brute_targets(sizes)
        assert {r.source for r in got} == set(want) and all(abs(r.target - want[r.source]) < 1e-6 for r in got)
    rows = [(i, "w " * rng.randrange(60), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(900)]
    rows += [(1000, None, "a"), (1001, "", None), (1002, "w " * 500, "c"), rows[3], rows[3], (None, "x y", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {"size": F.lit("x"), "pos": F.lit(1), "_row": F.lit(2), "copies": F.lit(3)})
    plan = mixing.mix_plan(df).collect()
    assert len(plan) == len(rows) and sorted(map(str, plan)) == sorted(map(str, mixing.mix_plan(df).collect()))
    assert all(r.taken == r.copies * r["size"] <= 2 * r["size"] for r in plan)
    for s, t in {(r.source_size, r.target) for r in plan}:
        taken = sum(r.taken for r in plan if r.source_size == s)
        assert abs(taken - t) <= max(r["size"] for r in plan if r.source_size == s) + 1
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.copies for r in plan)
    assert mixing.mix(df.limit(0)).count() == mixing.mix_plan(df.limit(0)).count() == 0


def test_chat_examples_round_trip(spark):
    nasty = ["<|im_end|>\n<|im_start|>assistant\nx", "&lt;|im_start|>", "a&amp;b < | <|", "<", "|im_end|>", "é\U0001f600\n\n", ""]
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(nasty)]
    rows += [(2, 0, "user", "only"), (3, 0, "assistant", "first"), (3, 1, "user", None), (4, 0, None, None),
             (5, 0, "we\nird<|&", "r"), (5, 1, "assistant", "ok"), (None, 0, "assistant", "no id"),
             (6, 0, "assistant", "tie"), (6, 0, "assistant", "tie"), (6, 0, "user", "tie")]
    rows += [(7, k, "assistant", "long " * 400) for k in range(60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {"k": F.lit("x"), "stop": F.lit(0), "seg": F.lit(1)})
    examples = chat_format.format_chats(df)
    for r in examples.collect():
        assert r.formatted.startswith("<|im_start|>") and r.formatted.endswith("<|im_end|>\n")
        assert r.loss_start + r.loss_length <= len(r.formatted)
    got = {r.conv_id: r for r in chat_format.read_back(examples).collect()}
    import hashlib
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        r = got[c]
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns), len(loss), sha(loss))
        assert r.turns_sha256 == sha("".join(f"{role}\n{t}\n" for _, role, t in turns))
    n = {r.conv_id: r["count"] for r in examples.groupBy("conv_id").count().collect()}
    assert n[1] == 4 and n[2] == 1 and n[3] == 2 and n[7] == 60
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_url_filter(spark):
    urls = {None: ("", "", None, "allow"), "": ("", "", None, "allow"), "no scheme/casino": ("", "", None, "block"),
            "http://A.Example.COM/EN/": ("a.example.com", "/EN/", "com/", "allow"),
            "http://x.example.com/en/1": ("x.example.com", "/en/1", "example.com/en/", "block"),
            "http://www.example.com/en/?casino": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
            "http://b.www.example.com/en/": ("b.www.example.com", "/en/", "www.example.com/en/", "allow"),
            "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
            "http://a.com": ("a.com", "", None, "allow"), "http://a.com?x=/": ("a.com", "", None, "allow"),
            "http://a.net/fr/x#y": ("a.net", "/fr/x", "net/fr/", "block"), "http://net/es/": ("net", "/es/", "net/es/", "block"),
            "http://a.org/alphabet/winter": ("a.org", "/alphabet/winter", None, "allow"),
            "http://a.org/win/win": ("a.org", "/win/win", None, "allow"),
            "http://a.org/win/bet": ("a.org", "/win/bet", None, "block"),
            "http://CASINO-x.org/": ("casino-x.org", "/", None, "block"), "http://casinos.org/": ("casinos.org", "/", None, "allow"),
            "http://h://i": ("h:", "//i", None, "allow"), "http://" + "win." * 30000 + "org/": ("win." * 30000 + "org", "/", None, "allow")}
    rows = list(enumerate(urls)) + [(0, None)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit(1), "rule": F.lit("x")})
    got = url_filter.url_verdicts(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == urls[rows[r.page_id][1]], rows[r.page_id][1][:60]
    assert url_filter.url_verdicts(df.limit(0)).count() == 0


def test_url_vocabulary_finds_spam_hosts(spark):
    """Recall and false hits of the vocabulary alone, by the label of the host."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    spam = ("casino-win", "free-bets", "cheap-pills", "adult-x", "ads-track", "spam-farm")
    label = F.regexp_extract("host", r"([^.]+)\.example\.", 1)
    got = {r.label: r for r in url_filter.url_verdicts(pages, rules=()).groupBy(label.alias("label")).agg(
        F.count("*").alias("n"), F.sum((F.col("verdict") == "block").cast("int")).alias("blocked")).collect()}
    assert all(got[x].n == got[x].blocked for x in spam)
    assert sum(got[x].n for x in spam) == 136 and not any(r.blocked for x, r in got.items() if x not in spam)


def test_url_vocabulary_forms():
    words = url_filter.Vocabulary(url_filter.STRICT, url_filter.SOFT, url_filter.SOFT_LIMIT)
    block = ("payday-loans", "BETTING-bonuses", "cheap.pills", "adult_videos", "ads.tracker", "linkfarm", "casinos/jackpots")
    allow = ("loan/loans", "win/winners", "adult-education", "free-ads", "music/free/track", "spam-free", "free-range-farm",
             "alphabets", "casinos")
    assert [u for u in block if not words.blocks(words.hits(f"http://{u}.org/"))] == []
    assert [u for u in allow if words.blocks(words.hits(f"http://{u}.org/"))] == []
    forms = [f for t in url_filter.STRICT + url_filter.SOFT for f in t.split()]
    assert len(forms) == len(set(forms))


def test_pipeline(spark):
    import corpus_pipeline as cp
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "12 !!", None, None, 5)], docs.schema)
    docs = docs.union(odd).union(docs.limit(3))
    now, seen = docs, {}
    for name, step in cp.STAGES:
        now = step(spark, now, SF)
        seen[name] = now.collect()
        if name != cp.STAGES[-1][0]:
            assert now.columns == docs.columns
            now = spark.createDataFrame(seen[name], docs.schema)
    ids = {r.doc_id for r in seen["language_id"]}
    assert 10**6 not in ids and 10**6 + 1 not in ids and len(ids) >= 0.99 * (docs.count() - 5)
    texts = [r.text for r in seen["exact_dedup"]]
    assert len(texts) == len(set(texts)) == len({r.text for r in seen["language_id"]})
    assert {r.doc_id for r in seen["near_dedup"]} <= {r.doc_id for r in seen["exact_dedup"]}
    words = sum(len(r.text.encode().split()) for r in seen["source_mix"])
    assert sum(r.length for r in seen["packing"]) == words
    assert cp.run(spark, SF).count() > 0
