"""Packing: optimal length buckets, then token-budget batches inside each.

Documents are cut into pieces of at most ``max_len`` tokens.  One aggregation
gives the histogram of all piece lengths: at most ``max_len`` rows whatever
the input, which is all the driver sees.  A dynamic programme over it chooses
the bucket boundaries with the least total padding.  Inside a bucket pieces
are numbered in (length, doc_id, piece) order without any bucket meeting in
one task (range-partitioned ranks), and every ``budget // boundary`` consecutive pieces are a batch.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtally.llm.common import id_key, positions, stage, word_count

MAX_LEN = 2048      # tokens of a training sequence
BUCKETS = 8
BUDGET = 16384      # tokens of a batch, padding included


def pieces(docs: DataFrame, max_len: int = MAX_LEN, tokens: Column | None = None) -> DataFrame:
    """doc_id, n_tokens, piece (from 0), start, length: every token of every
    document once.  ``tokens`` is the token count of a row, words of ``text``
    by default.  Documents without a token have no piece."""
    n = word_count("text") if tokens is None else tokens
    return (docs.select("doc_id", n.cast("bigint").alias("n_tokens")).filter("n_tokens > 0")
            .withColumn("piece", F.explode(F.expr(f"sequence(0L, (n_tokens - 1) div {max_len})")))
            .withColumn("start", F.col("piece") * max_len)
            .withColumn("length", F.least(F.lit(max_len).cast("bigint"), F.col("n_tokens") - F.col("start"))))


def boundaries(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Ascending bucket boundaries (each a length that occurs) which minimise
    sum(count * (boundary - length)); ties to the smaller last cut.  Exact:
    best[k][j] = min over i of best[k-1][i] + cost(i, j)."""
    lengths = np.array(sorted(x for x, n in histogram.items() if n > 0), dtype=np.int64)
    if not len(lengths):
        return []
    count = np.array([histogram[x] for x in lengths.tolist()], dtype=object)
    # Python integers: exact at any size
    total = np.concatenate(([0], np.cumsum(count)))
    words = np.concatenate(([0], np.cumsum(count * lengths.astype(object))))
    m = len(lengths)
    limit = int(total[-1]) * int(lengths[-1])
    kind = np.int64 if limit < 1 << 62 else object
    total, words, size = total.astype(kind), words.astype(kind), lengths.astype(kind)
    best = size * total[1:] - words[1:]
    cuts = [np.zeros(m, dtype=np.int64)]
    for _ in range(1, min(buckets, m)):
        new, cut = best.copy(), np.zeros(m, dtype=np.int64)
        for j in range(1, m):
            # the last bucket holds lengths[i + 1 .. j]
            cost = best[:j] + size[j] * (total[j + 1] - total[1:j + 1]) - (words[j + 1] - words[1:j + 1])
            i = int(np.argmin(cost))
            if cost[i] < new[j]:
                new[j], cut[j] = cost[i], i + 1
        best = new
        cuts.append(cut)
    out, j = [], m - 1
    for cut in reversed(cuts):
        out.append(int(lengths[j]))
        if cut[j] == 0:
            break
        j = int(cut[j]) - 1
    return out[::-1]


def pack(docs: DataFrame, max_len: int = MAX_LEN, buckets: int = BUCKETS, budget: int = BUDGET,
         tokens: Column | None = None) -> DataFrame:
    """Place every piece in a batch: doc_id, piece, start, length, bucket_len
    (padded length), batch (from 0 in its bucket), slot (from 0 in its batch).

    A batch holds ``budget // bucket_len`` pieces (one at least); only the last
    of a bucket may hold fewer.  Null and empty texts have no token and no row;
    repeated rows are packed as often as they occur (in any order among
    themselves); an empty table gives no rows.  Columns but doc_id and text
    are not looked at.
    """
    # written once: texts are read and counted a single time
    cut = stage(pieces(docs, max_len, tokens), "pieces")
    found = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    bounds = boundaries(found, buckets) or [max_len]
    bucket = F.coalesce(*[F.when(F.col("length") <= b, F.lit(b)) for b in bounds]).cast("bigint")
    placed = positions(cut.withColumns({"bucket_len": bucket, "_id": id_key("doc_id")}),
                       ["bucket_len"], ["length", "_id", "piece"])
    room = F.greatest(F.lit(1).cast("bigint"), F.expr(f"{int(budget)}L div bucket_len"))
    place = F.col("pos") - 1
    return placed.select("doc_id", "piece", "start", "length", "bucket_len",
                         F.floor(place / room).cast("bigint").alias("batch"),
                         (place % room).cast("int").alias("slot"))


def batches(packed: DataFrame) -> DataFrame:
    """One row per batch: bucket_len, batch, n, tokens, padding and its pieces
    in slot order; a list is bounded by the token budget."""
    return (packed.groupBy("bucket_len", "batch")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("tokens"),
                 F.sum(F.col("bucket_len") - F.col("length")).alias("padding"),
                 F.sort_array(F.collect_list(F.struct("slot", "doc_id", "start", "length"))).alias("pieces")))
