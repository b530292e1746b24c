"""Toxicity by maximum-scoring segments.

Token scores are log-odds of toxic against clean documents with an
informative Dirichlet prior (a token's share of both classes), kept where
their z-score is clear, less a drift per token so that a random text scores
below zero.  A linear scan finds every maximal segment of a text's scores
(all of them, not only the best).  Segment scores are calibrated by an
extreme-value law: on clean texts the number of segments above S in n tokens
is about K n exp(-lambda S), fitted on clean training texts.  A document's
evidence is the sum of log(1 / E) over its segments that are rarer than
chance, and a logistic curve fitted on the training rows turns it into a score.

The model is fitted on at most ``SAMPLE`` labelled rows of each class, by hash
of the id, counted in Spark; it keeps at most ``TERMS`` tokens.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtally.llm.common import bounded_sample, stage, text_batches

SAMPLE = 10000      # labelled rows of each class that the model is fitted on
CLEAR = 3.0         # least |z| of a kept token
PRIOR = 0.05        # weight of the prior, as a share of the training documents
DRIFT = 0.05        # taken off for every token
STEMS = (6, 5, 4)   # letters of the stems that stand in for an unseen word
THRESHOLD = 0.7
CACHE = 300_000     # words a task remembers

TOKEN = re.compile(r"[^\W\d_]+")


def segments(at: np.ndarray, score: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end exclusive, score) of a token
    sequence that scores ``score[i]`` at the ascending places ``at[i]`` and
    ``-drift`` elsewhere (the scan of Ruzzo and Tompa).  ``back`` leads from a
    segment to the nearest earlier one that starts lower, which keeps the
    scan linear."""
    low, high, start, end, back = [], [], [], [], []
    total, last = 0.0, 0
    for p, s in zip(at.tolist(), score.tolist()):
        total -= drift * (p - last)
        last = p + 1
        before, total = total, total + s
        if s <= 0:
            continue
        first = p
        while True:
            j = len(low) - 1
            while j >= 0 and low[j] >= before:
                j = back[j]
            if j < 0 or high[j] >= total:
                break
            before, first = low[j], start[j]
            for x in (low, high, start, end, back):
                del x[j:]
        for x, v in ((low, before), (high, total), (start, first), (end, p + 1), (back, j)):
            x.append(v)
    return [(a, b, r - x) for x, r, a, b in zip(low, high, start, end)]


class _Words(dict):
    """Word -> score, by the word itself or its longest known stem."""

    def __init__(self, terms: dict[str, float]):
        super().__init__()
        self.terms = terms

    def __missing__(self, w: str) -> float:
        s = self.terms.get(w)
        if s is None:
            s = next((x for n in STEMS if len(w) > n and (x := self.terms.get(w[:n] + "*")) is not None), 0.0)
        if len(self) >= CACHE:
            self.clear()
        self[w] = s
        return s


@dataclass
class Model:
    terms: dict[str, float]     # word, or stem and "*" -> log-odds
    k: float = 1.0              # extreme-value law of clean texts
    lam: float = 1.0
    bias: float = -2.0          # logistic curve over the evidence
    slope: float = 1.0

    def passages(self, tokens: list[str], words: dict[str, float]) -> list[tuple[int, int, float]]:
        s = np.fromiter(map(words.__getitem__, tokens), np.float64, len(tokens))
        at = np.flatnonzero(s)
        return segments(at, s[at] - DRIFT, DRIFT)

    def rarity(self, n: int, score: float) -> float:
        """-log of the segments this high expected in n clean tokens."""
        return self.lam * score - math.log(self.k * max(n, 1))

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + self.slope * evidence))))


SEGMENTS = "array<struct<start:int,end:int,score:double,rarity:double>>"


def _scan(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (first column the text): the other columns, n (tokens),
    segments, evidence, score."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                               ("score", pa.float64()), ("rarity", pa.float64())]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        words = _Words(m.terms)
        for b in it:
            n, found, evidence = [], [], []
            for t in b.column(0).to_pylist():
                tokens = TOKEN.findall(t.lower()) if t else []
                segs = [(a, z, s, m.rarity(len(tokens), s)) for a, z, s in m.passages(tokens, words)]
                n.append(len(tokens))
                found.append([dict(zip(("start", "end", "score", "rarity"), x)) for x in segs])
                evidence.append(math.fsum(x[3] for x in segs if x[3] > 0))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array(n, pa.int64()), pa.array(found, kind),
                 pa.array(evidence, pa.float64()), pa.array(map(m.score, evidence), pa.float64())],
                names=[*b.schema.names[1:], "n", "segments", "evidence", "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]),
                        "n long", f"segments {SEGMENTS}", "evidence double", "score double"])
    return rows.mapInArrow(run, schema)


def _terms(sample: DataFrame, n0: int, n1: int) -> dict[str, float]:
    """Clear log-odds of words and stems, by documents that hold them."""
    word = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))))
    words = sample.select("toxic", "doc_id", word.alias("w"))
    stems = [words.filter(F.length("w") > n).select("toxic", "doc_id", F.concat(F.substring("w", 1, n), F.lit("*"))
                                                    .alias("w")).distinct() for n in STEMS]
    for x in stems:
        words = words.union(x)
    c1, c0 = F.sum("toxic"), F.sum(1 - F.col("toxic"))
    counts = words.groupBy("w").agg(c1.cast("double").alias("c1"), c0.cast("double").alias("c0"))
    a0 = max(PRIOR * (n0 + n1), 1.0)
    a = (F.col("c1") + F.col("c0")) * (a0 / (n0 + n1))
    # no odds for a word of all documents: null, it is not clear
    odds = lambda c, n: F.log(F.try_divide(c + a, n + a0 - c - a))
    scored = (counts.withColumn("s", odds(F.col("c1"), float(n1)) - odds(F.col("c0"), float(n0)))
              .withColumn("z", F.col("s") / F.sqrt(1 / (F.col("c1") + a) + 1 / (F.col("c0") + a))))
    # every clear token; the sample of rows is what bounds them
    clear = scored.filter(F.abs("z") >= CLEAR)
    return {r["w"]: r["s"] for r in clear.select("w", "s").collect()}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> tuple[float, float]:
    """Bias and slope; a small ridge on the slope keeps separable data finite."""
    w = np.zeros(2)
    a = np.stack([np.ones_like(x), x], axis=1)
    pen = np.diag([1e-3, ridge])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (y - p) - pen @ w
        hess = (a * (p * (1 - p))[:, None]).T @ a + pen
        step = np.clip(np.linalg.solve(hess, grad), -5, 5)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 0.0))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Model:
    """Fit on the rows of ``docs`` that ``learn`` admits and ``labels``
    (doc_id, toxic 0 or 1) covers; null texts and other labels teach nothing.
    A document with two labels counts once for each, and a doc_id that repeats
    is one document (of several texts the one with the least hash), so at most
    ``2 * sample`` rows are learnt from.  Without both classes every text gets the same
    low score."""
    rows = labels.filter(learn & F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int")).distinct()
    chosen = bounded_sample(rows, "toxic", "doc_id", sample)
    # at most 2 * sample ids
    drawn = stage(docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text is not null")
                  .join(F.broadcast(chosen), "doc_id")
                  # kept before the shuffle: an id on many rows moves once a task
                  .groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "sample")
    n = {r["toxic"]: r["n"] for r in drawn.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        return Model({}, slope=0.0)
    model = Model(_terms(drawn, n0, n1))
    with text_batches(docs.sparkSession):
        seen = stage(_scan(drawn.select("text", "toxic"), model), "seen")
    clean = seen.filter("toxic = 0").agg(
        F.sum("n").alias("n"), F.sum(F.size("segments")).alias("k"),
        F.sum(F.aggregate("segments", F.lit(0.0), lambda t, x: t + x["score"])).alias("s")).first()
    # one more segment of score 1 keeps both finite where clean texts have none
    model.k = (clean["k"] + 1) / max(clean["n"], 1)
    model.lam = (clean["k"] + 1) / (clean["s"] + 1.0)
    rare = F.lit(model.lam) * F.col("s.score") - F.log(F.lit(model.k) * F.greatest(F.col("n"), F.lit(1)))
    by_row = (seen.withColumn("row", F.monotonically_increasing_id()).select("row", "toxic", "n", F.explode_outer("segments").alias("s"))
              .groupBy("row").agg(F.max("toxic").alias("toxic"), F.sum(F.greatest(F.coalesce(rare, F.lit(0.0)), F.lit(0.0))).alias("x"))
              .select("toxic", "x").collect())
    model.bias, model.slope = _logistic(np.array([r["x"] for r in by_row], float), np.array([r["toxic"] for r in by_row], float))
    return model


def learns_from(part: int = 1, of: int = 3) -> Column:
    """Rows that may be learnt from; null ids may not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % of != part, F.lit(False))


def toxic_passages(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, and passages: the segments
    rarer than chance (start and end token, score, rarity).

    A null or empty text has no token and no evidence, so the score of a text
    without a toxic sign.  Repeated rows get equal results; an empty table
    gives no rows; columns but doc_id and text are not looked at.
    """
    rows = docs.select(F.col("text").cast("string").alias("_t"), "doc_id")
    with text_batches(docs.sparkSession):
        seen = stage(_scan(rows, model), "scores")
    return seen.select("doc_id", "score", F.filter("segments", lambda s: s["rarity"] > 0).alias("passages"))
