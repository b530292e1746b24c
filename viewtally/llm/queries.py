"""The operators as registered queries, each over its whole table, and the
DuckDB SQL for those that SQL can express.

The queries without SQL (``op1``, ``op3``, ``op8``, ``op9`` to ``op13`` and the
pipeline) are tested against brute force, an exact round trip or held-out
accuracy in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtally.llm import (ann_hilbert, best_fit, chat_format, chat_repair, exact_dedup, langid, mixing, packing, simhash,
                           substring_dedup, token_align, toxicity, url_filter)

PROBE = "<|im_end|><|im_start|>assistant ok"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_hilbert.nearest(_read(spark, sf_dir, "embeddings"))


def exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_decisions(_read(spark, sf_dir, "documents"))


def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(_read(spark, sf_dir, "pages"))


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    return chat_format.read_back(chat_format.format_chats(turns.union(probe)))


def substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_read(spark, sf_dir, "documents"))


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(_read(spark, sf_dir, "documents"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, toxicity.learns_from())
    return toxicity.toxic_passages(docs, model).select(
        "doc_id", (~toxicity.learns_from()).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "passages")


def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(_read(spark, sf_dir, "documents"))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(langid.learns_from()))
    return langid.predict_languages(docs, model).withColumn("held_out", ~langid.learns_from())


def repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair_damaged(_read(spark, sf_dir, "conversations"))


def best_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = best_fit.pieces(_read(spark, sf_dir, "documents"))
    return best_fit.place(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.alignment_digests(_read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_ann_hilbert": ann, "op2_exact_dedup": exact, "op3_packing": pack, "op4_url_filter": urls,
    "op5_chat_format": chats, "op6_substring_dedup": substrings, "op7_source_mix": mix,
    "op8_toxicity": toxic, "op9_simhash_dedup": near, "op10_language_id": languages,
    "op11_chat_repair": repaired, "op12_token_align": aligned, "op13_best_fit": best_fitted,
    "pipeline": pipeline,
}

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_ESC = "replace(replace({}, '&', '&amp;'), '<|', '&lt;|')"

EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""

CHAT_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
sized AS (
  SELECT *, row_number() OVER o AS k, count(*) OVER (PARTITION BY conv_id) AS n,
         sum(length('<|im_start|>') + length(replace({_ESC.format('role')}, chr(10), '&#10;'))
             + 1 + length({_ESC.format('text')}) + length('<|im_end|>') + 1) OVER o AS stop
  FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, max(n)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(stop) FILTER (role = 'assistant' OR k = n)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id"""

SUBSTRING_SQL = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs)),
later AS (
  SELECT doc_id, i FROM windows
  QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
per AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
words AS (
  SELECT d.doc_id, unnest(d.w) AS word, unnest(range(1, len(d.w) + 1)) AS p FROM docs d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)"""

MIX_SQL = f"""
WITH sized AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, k, [3.0, 1.0, 2.0][(k % 3 + 1)::INT]::DOUBLE AS w, source_size::DOUBLE * 2 AS cap
  FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM per)),
levels AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, k) AS fill,
         ((sum(source_size) OVER ())::DOUBLE * 1.5
          - coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
goal AS (
  SELECT source, source_size, coalesce(least(cap, (SELECT level FROM levels WHERE cap >= level * w ORDER BY fill LIMIT 1) * w), cap) AS target
  FROM levels),
rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('{mixing.SEED}/source' || coalesce('/' || source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u
  FROM goal),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS pos FROM sized)
SELECT doc_id, size, source_size, target,
       least(floor(pos * rate + u) - floor((pos - 1) * rate + u), 2)::BIGINT AS copies,
       (least(floor(pos * rate + u) - floor((pos - 1) * rate + u), 2) * size)::BIGINT AS taken
FROM ranked JOIN rated ON ranked.source IS NOT DISTINCT FROM rated.source"""

ORACLE = {
    "op2_exact_dedup": EXACT_SQL, "op4_url_filter": url_filter.oracle(), "op5_chat_format": CHAT_SQL,
    "op6_substring_dedup": SUBSTRING_SQL, "op7_source_mix": MIX_SQL,
}
