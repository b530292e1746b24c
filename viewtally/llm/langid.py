"""Language ID by word-first backoff.

A word is a run of letters, lower-cased.  A known word is scored by its log
frequency in each language; an unseen one by its character n-grams, longest
order first: the first order of which any n-gram is known gives the score.
Word scores are summed over the whole text.

The model knows every language that labels a row.  It is fitted on a bounded
sample of the labelled rows (``SAMPLE`` rows per language, by hash of the id),
counted in Spark; the tables keep all words and n-grams of the sample, and of a
token only the languages that use it.  Their entries are counted before they are
collected and broadcast: a sample that gives more than ``ENTRIES`` is halved.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewtally.llm.common import bounded_sample, ranges, stage, text_batches

SAMPLE = 1000       # labelled rows per language that the model is fitted on
ENTRIES = 10_000_000    # (token, language) pairs of the model at most; 20 bytes each and the tokens
ORDERS = (4, 3, 2, 1)
NONE = "und"
MIN_KNOWN = 0.5     # known share of a text's letters; below it the pipeline rejects a document
CACHE = 300_000     # words a task remembers
CELLS = 8_000_000   # at most: words a task remembers x languages
BROADCAST_IDS = 5_000_000  # sampled ids; more meet their texts in a shuffle

LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class Scores:
    """Sparse rows of log frequencies: a row is ``base`` of its table, and more
    for the languages that use the token."""
    base: np.ndarray    # table x language: an unused token
    table: np.ndarray   # row -> table
    start: np.ndarray   # row -> its first entry; then the number of entries
    lang: np.ndarray    # entry -> language
    more: np.ndarray    # entry -> what use adds

    @classmethod
    def of(cls, rows: np.ndarray) -> Scores:
        n, m = rows.shape
        return cls(np.zeros((1, m)), np.zeros(n, np.int32), np.arange(n + 1) * m, np.tile(np.arange(m), n), rows.ravel())

    def __len__(self) -> int:
        return len(self.table)

    def means(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The mean of each run of ``sizes`` rows, of one table each."""
        m = self.base.shape[1]
        out, run = np.zeros((len(sizes), m)), np.repeat(np.arange(len(sizes)), sizes)
        step = max(1, CELLS // (8 * m))  # bounds the entries held at a time
        for k in range(0, len(ids), step):
            some, owner = ids[k:k + step], run[k:k + step]
            n = self.start[some + 1] - self.start[some]
            at, first, rows = ranges(self.start[some], n), owner[0], owner[-1] - owner[0] + 1
            cell = np.repeat((owner - first) * m, n) + self.lang[at]
            out[first:first + rows] += np.bincount(cell, self.more[at], rows * m).reshape(rows, m)
        return out / sizes[:, None] + self.base[self.table[ids[np.cumsum(sizes) - sizes]]]


@dataclass
class Model:
    langs: list[str]
    words: dict[str, int]               # known word -> row of ``rows``
    grams: dict[int, dict[str, int]]    # order -> n-gram -> row
    rows: Scores                        # log frequencies per language; the last row is zero

    def __post_init__(self):
        if isinstance(self.rows, np.ndarray):
            self.rows = Scores.of(self.rows)


class Reader:
    """Predicts with a model; remembers the scores of up to ``CACHE`` words, of
    fewer if the languages are many."""

    def __init__(self, model: Model, letters: bool = True):
        self.m, self.at, self.letters = model, {}, letters
        self.most = min(CACHE, max(1, CELLS // max(1, len(model.langs))))
        # scores, then letters and known letters
        self.scores = np.zeros((self.most, len(model.langs) + 2))

    def _rows(self, w: str) -> list[int]:
        """Rows whose mean is the word's score."""
        if (r := self.m.words.get(w)) is not None:
            return [r]
        padded = f"<{w}>"
        for n in ORDERS:
            known = self.m.grams.get(n, {})
            hits = [r for i in range(len(padded) - n + 1) if (r := known.get(padded[i:i + n])) is not None]
            if hits:
                return hits
        return [len(self.m.rows) - 1]

    def _letters(self, w: str) -> tuple[int, int]:
        """Letters, and those in a known word or in a known n-gram of two or
        more; longer n-grams are made of known ones of two."""
        if w in self.m.words:
            return len(w), len(w)
        padded, two = f"<{w}>", self.m.grams.get(2, {})
        pairs = [padded[i:i + 2] in two for i in range(len(w) + 1)]
        return len(w), sum(a or b for a, b in zip(pairs, pairs[1:]))

    def _sum(self, words: list[str], n: np.ndarray) -> np.ndarray:
        new = [w for w in words if w not in self.at]
        if len(self.at) + len(new) > self.most:
            self.at.clear()
            new = words
        if new:
            first, ids, sizes = len(self.at), [], []
            for i, w in enumerate(new, first):
                r = self._rows(w)
                ids += r
                sizes.append(len(r))
                self.at[w] = i
            to = self.scores[first:first + len(new)]
            to[:, :-2] = self.m.rows.means(np.array(ids), np.array(sizes))
            if self.letters:
                to[:, -2:] = [self._letters(w) for w in new]
        at = self.at
        return n @ self.scores[[at[w] for w in words]]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, posterior under equal priors, known share of the letters);
        ``und``, 0, 0 without a letter.  A model without languages knows no
        letter from another: ``und``, 0, 1."""
        counts = Counter(LETTERS.findall(text.lower())) if text else {}
        if not counts or not self.m.langs:
            return NONE, 0.0, float(bool(counts))
        words = list(counts)
        n = np.fromiter(counts.values(), np.float64, len(words))
        total = sum(self._sum(words[k:k + self.most], n[k:k + self.most])
                    for k in range(0, len(words), self.most))
        total, (letters, known) = total[:-2], total[-2:]
        best = int(total.argmax())
        return self.m.langs[best], float(1 / np.exp(np.minimum(total - total[best], 0)).sum()), \
            float(known / letters) if self.letters else 0.0


def _scores(rows: pa.Table, langs: list[str], token: str) -> tuple[dict[str, int], Scores]:
    """Tokens by row, and their log frequencies, add-half smoothed."""
    at = {x: i for i, x in enumerate(langs)}
    tokens, names = (rows[c].combine_chunks().dictionary_encode() for c in (token, "lang"))
    place = {t: i for i, t in enumerate(tokens.dictionary.to_pylist())}
    row = tokens.indices.to_numpy(zero_copy_only=False)
    lang = np.array([at[x] for x in names.dictionary.to_pylist()], np.int32)[names.indices.to_numpy(zero_copy_only=False)]
    n = rows["n"].to_numpy().astype(np.float64)
    base = np.log(0.5) - np.log(np.bincount(lang, n, len(langs)) + 0.5 * max(len(place), 1))
    order = np.lexsort((lang, row))
    start = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(place)))]).astype(np.int64)
    return place, Scores((base - base.mean())[None], np.zeros(len(place), np.int32), start, lang[order],
                         np.log(n[order] + 0.5) - np.log(0.5))


def _joined(parts: list[Scores], langs: int) -> Scores:
    """The rows of all tables, and a last row of zero."""
    parts = [*parts, Scores.of(np.zeros((1, langs)))]
    first = np.cumsum([0] + [len(p.lang) for p in parts])
    return Scores(np.concatenate([p.base for p in parts]),
                  np.concatenate([np.full(len(p), i, np.int32) for i, p in enumerate(parts)]),
                  np.concatenate([*(p.start[:-1] + f for p, f in zip(parts, first)), first[-1:]]),
                  np.concatenate([p.lang for p in parts]), np.concatenate([p.more for p in parts]))


def fit(labelled: DataFrame, sample: int = SAMPLE, entries: int = ENTRIES) -> Model:
    """Fit on ``labelled`` (doc_id, text, lang): rows with null lang or no
    letter teach nothing; languages tie by name.  At most ``sample`` rows of a
    language are learnt from, half as many for as long as the model would have more
    than ``entries`` (token, language) pairs."""
    rows = labelled.filter("lang is not null and text is not null").select("doc_id", "text", "lang")
    # ids and languages written once: choosing the sample reads no text again
    ids = stage(rows.select("doc_id", "lang"), "labelled")
    langs = sorted(r["lang"] for r in ids.select("lang").distinct().collect())
    if not langs:
        return Model([], {}, {}, np.zeros((1, 0)))
    while True:
        counted, pieces = _counts(rows, ids, sample, len(langs))
        if sample == 1 or counted.filter("n > 1").count() + pieces.count() <= entries:
            break
        sample = max(1, sample // 2)
    # words seen once say no more than their n-grams
    vocabulary, table = _scores(counted.filter("n > 1").toArrow(), langs, "w")
    parts, by_n, kept = [table], {}, pieces.toArrow()
    for o in ORDERS:
        place, table = _scores(kept.filter(pc.equal(kept["o"], o)), langs, "g")
        first = sum(map(len, parts))
        by_n[o] = {g: first + i for g, i in place.items()}
        parts.append(table)
    return Model(langs, vocabulary, by_n, _joined(parts, len(langs)))


def _counts(rows: DataFrame, ids: DataFrame, sample: int, langs: int) -> tuple[DataFrame, DataFrame]:
    """Words (lang, w, n) and n-grams (lang, o, g, n) of the sample."""
    chosen = bounded_sample(ids, "lang", "doc_id", sample).distinct()
    # at most so many ids of two short columns
    docs = rows.join(F.broadcast(chosen) if sample * langs <= BROADCAST_IDS else chosen, ["doc_id", "lang"])
    found = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))
    counted = stage(docs.select("lang", found.alias("w")).groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n")),
                    "words")
    padded = F.concat(F.lit("<"), "w", F.lit(">"))

    def pieces_of(n: int) -> Column:  # a lambda with a second argument would get the index
        last = F.greatest(F.length(padded) - (n - 1), F.lit(1))
        return F.transform(F.sequence(F.lit(1), last),
                           lambda i: F.struct(F.lit(n).alias("o"), F.substr(padded, i, F.lit(n)).alias("g")))

    cut = F.flatten(F.array(*map(pieces_of, ORDERS)))
    pieces = (counted.select("lang", "n", F.explode(cut).alias("c")).select("lang", "n", "c.o", "c.g")
              .filter("length(g) = o").groupBy("lang", "o", "g").agg(F.sum("n").alias("n")))
    return counted, stage(pieces, "grams")


def _predicted(rows: DataFrame, model: Model, letters: bool = True) -> DataFrame:
    """``rows`` (first column the text) with lang_pred, score and known (the
    share of known letters, which costs a look at every new word's; 0 without
    ``letters``)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value, letters)
        for b in it:
            got = [reader.predict(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([g[0] for g in got], pa.string()),
                 *(pa.array([g[i] for g in got], pa.float64()) for i in (1, 2))],
                names=[*b.schema.names, "lang_pred", "score", "known"])

    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("known", T.DoubleType())])
    return rows.mapInArrow(run, schema)


def learns_from(part: int = 2, of: int = 4) -> Column:
    """Rows that may be learnt from; null ids may not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % of != part, F.lit(False))


def predict_languages(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score (0 to 1).

    ``und`` with score 0 if the text is null, empty or has no letter, or if
    the model knows no language.  Equal scores go to the language first by
    name.  Repeated rows get equal results; an empty table gives no rows; columns
    but doc_id and text are not looked at.
    """
    rows = docs.select(F.col("text").cast("string").alias("_t"), "doc_id")
    with text_batches(docs.sparkSession):
        return stage(_predicted(rows, model, letters=False).drop("_t", "known"), "languages")


def keep_identified(docs: DataFrame, model: Model, min_known: float = MIN_KNOWN) -> DataFrame:
    """``docs`` without the rows that have no letter or of whose letters less
    than ``min_known`` are known, whatever the number of languages; columns
    unchanged, no shuffle.  If no language could be learnt, every row with a
    letter stays."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.select(F.col("text").cast("string").alias("t"),
                       *[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)])
    kept = _predicted(rows, model).filter((F.col("known") > 0) & (F.col("known") >= min_known))
    return kept.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])
