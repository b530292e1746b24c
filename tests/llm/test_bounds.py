"""Bounded groups and models: positions of any ids, no caps beside the samples,
one document per id, an index for each vector length, plans of the queries."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewtally.llm import ann_hilbert, langid, queries, toxicity
from viewtally.llm import common


@pytest.mark.parametrize("ids", ["dense", "hashed", "one id"])
def test_positions_of_any_ids(spark, ids, monkeypatch):
    key = {"dense": F.col("id"), "hashed": F.xxhash64("id"), "one id": F.lit(7).cast("bigint")}[ids]
    df = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
                                    (F.col("id") % 2).alias("size"), key.alias("k"), F.col("id").alias("row"))
    runs = []
    stage = common.stage
    monkeypatch.setattr(common, "stage", lambda x, name: runs.append(stage(x, name)) or runs[-1])
    got = common.positions(df, ["g"], ["size", "k"]).toPandas()
    assert len(got) == 20_000
    for _, part in got.groupby("g"):
        part = part.sort_values("pos")
        assert part["pos"].tolist() == list(range(1, len(part) + 1))
        pairs = list(zip(part["size"], part["k"]))
        assert pairs == sorted(pairs)
    # the rows are even over the range partitions, so no task holds a group
    sizes = [r.n for r in runs[0].groupBy(F.shiftright("_at", 33)).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) >= 6 and max(sizes) < 2 * 20_000 / len(sizes)


def test_more_terms_than_the_old_caps(spark):
    n = 21_000
    learn = spark.range(2).select(F.col("id").alias("doc_id"), F.expr(
        f"concat_ws(' ', transform(sequence(0, {n - 1}), i -> concat('w', translate(cast(i as string), '0123456789', 'abcdefghij'), "
        "if(id = 0, 'x', 'y'))))").alias("text"), F.concat(F.lit("l"), "id").alias("lang"))
    twice = learn.withColumn("text", F.concat_ws(" ", "text", "text"))
    model = langid.fit(twice)
    assert len(model.words) == 2 * n and len(model.grams[4]) > 10_000
    small = langid.fit(twice.union(twice.withColumn("doc_id", F.col("doc_id") + 10).withColumn("text", F.lit("wa wa"))), sample=2, entries=9)
    assert small.langs == ["l0", "l1"]      # halved down to one row each, never refused


def test_no_cap_on_toxic_terms(spark):
    vocabulary = [f"t{''.join(chr(97 + int(d)) for d in str(i))}" for i in range(60_000)]
    text = " ".join(vocabulary)
    rows = [(i, text if i % 2 else "plain words of peace") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    model = toxicity.fit(docs, labels, F.lit(True))
    assert len(model.terms) > 60_000


def test_an_id_on_a_third_of_the_rows_counts_once(spark):
    rows = [(i, "vile filth here" if i % 2 else "kind words here") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic")).distinct()
    hot = docs.union(spark.createDataFrame([(0, "kind words here")] * 20, docs.schema))
    a, b = (toxicity.fit(d, labels, F.lit(True)) for d in (docs, hot))
    assert a == b


def test_vectors_of_two_lengths_are_all_answered(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8 if i % 3 else 5).tolist()) for i in range(301)]
    got = ann_hilbert.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    of = dict(rows)
    assert {r.query_id for r in got} == {i for i, _ in rows if i % 50 == 0} and len(got) == 7 * 5
    for r in got:
        same = [(j, v) for j, v in rows if len(v) == len(of[r.query_id]) and j != r.query_id]
        q = np.array(of[r.query_id])
        cos = sorted(((-float(np.dot(q, v) / np.linalg.norm(q) / np.linalg.norm(v)), j) for j, v in same))
        assert cos[r["rank"] - 1][1] == r.vec_id


def test_of_rows_with_equal_id_and_text_one_stays_always_the_same(spark):
    rows = [(1, "a", lang, src) for lang in ("de", "en", None) for src in ("x", "y", None)] + [(None, None, "en", "x"), (None, "", "de", "y")]
    kept = []
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        df = spark.createDataFrame(order, "doc_id long, text string, lang string, source string").repartition(len(kept) + 1)
        kept.append(sorted(map(str, common.keep_rows(df, df.select(common.id_key("doc_id").alias("_id"), common.text_key().alias("_tk"))).collect())))
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 2


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_nested_loop_or_cartesian(spark, name):
    p = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
