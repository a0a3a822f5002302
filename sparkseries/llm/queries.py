"""Registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkseries.llm.alignment import align_tokenizers
from sparkseries.llm.ann import nearest
from sparkseries.llm.bpe import transcode
from sparkseries.llm.chat import maximal_conversations
from sparkseries.llm.collocation import collocations
from sparkseries.llm.common import table
from sparkseries.llm.linededup import deduplicate_lines, digest
from sparkseries.llm.packing import pack
from sparkseries.llm.quality import quality
from sparkseries.llm.sharding import shard
from sparkseries.llm.simhash import near_duplicates
from sparkseries.llm.suffix import remove_repeats
from sparkseries.llm.topk import top_k
from sparkseries.llm.toxicity import toxicity


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer's file, the same on every worker."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op2_ann(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return digest(deduplicate_lines(table(spark, folder, "documents")))


def fold(column: str, parts: int):
    """Remainder by which labels are dealt to training and held-out documents."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def scored(scores: DataFrame, held_out, threshold: float) -> DataFrame:
    return scores.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return scored(quality(docs, labels, fold("doc_id", 5) != 0), fold("doc_id", 5) == 0, 0.3)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return scored(toxicity(docs, labels, fold("doc_id", 3) != 1), fold("doc_id", 3) == 1, 0.7)


def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return maximal_conversations(table(spark, folder, "conversations"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), vocabulary_path())


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return digest(remove_repeats(table(spark, folder, "documents")))


def op9_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = transcode(table(spark, folder, "documents"), vocabulary_path())
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_tokenizers(table(spark, folder, "documents"), vocabulary_path(), vocabulary_path("piece_bpe_32k.model"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


def op13_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard(table(spark, folder, "documents"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_ann": op2_ann,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality": op4_quality,
    "op5_toxicity": op5_toxicity,
    "op6_chat_format": op6_chat_format,
    "op7_packing": op7_packing,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_topk": op9_topk,
    "op10_bpe": op10_bpe,
    "op11_alignment": op11_alignment,
    "op12_collocations": op12_collocations,
    "op13_sharding": op13_sharding,
}
_OP3 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM documents),
keys AS (
  SELECT doc_id, line, i, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
hot AS (
  SELECT key, max(doc_id) AS last FROM keys WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.*, h.key IS NOT NULL AND k.doc_id <> h.last AS gone FROM keys k LEFT JOIN hot h USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
_OP6 = r"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
  SELECT conv_id, row_number() OVER w AS n, lead(1) OVER w IS NULL AS last,
         md5(string_agg(md5(role) || md5(text), '') OVER (w ROWS UNBOUNDED PRECEDING)) AS h,
         '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS shown
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
whole AS (SELECT n, h, min(conv_id) AS conv_id, count(*) AS copies FROM placed WHERE last GROUP BY n, h),
maximal AS (SELECT * FROM whole w WHERE NOT EXISTS (SELECT 1 FROM placed p WHERE NOT p.last AND p.n = w.n AND p.h = w.h))
SELECT m.conv_id, m.n AS n_turns, m.copies, string_agg(p.shown, '' ORDER BY p.n) AS rendered
FROM maximal m JOIN placed p USING (conv_id) GROUP BY m.conv_id, m.n, m.copies
"""
_OP9 = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
_OP8 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (SELECT doc_id, h, unnest(range(0, greatest(0, length(h) // 2 - 49))) AS p FROM d),
strings AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM places),
firsts AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s),
hits AS (SELECT DISTINCT doc_id, p FROM strings JOIN firsts USING (s) WHERE doc_id > first),
begun AS (SELECT *, coalesce(p > 50 + lag(p) OVER (PARTITION BY doc_id ORDER BY p), true) AS new FROM hits),
counted AS (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM begun),
spans AS (SELECT doc_id, g, min(p) AS a, max(p) + 50 AS b FROM counted GROUP BY doc_id, g),
ends AS (SELECT *, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS c FROM spans),
cut AS (
  SELECT d.doc_id, d.h, sum(b - a) AS n_removed, count(*) AS n_spans,
         substr(d.h, 1, 2 * min(a)) || string_agg(substr(d.h, 2 * b + 1, 2 * (coalesce(c, length(d.h) // 2) - b)), '' ORDER BY a) AS kept
  FROM d JOIN ends USING (doc_id) GROUP BY d.doc_id, d.h)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, d.h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""
_OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-]')) AS piece
  FROM documents),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ 	]+'), lambda w: w <> '') AS ws FROM pieces),
counted AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM split GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM split, range(1, 6) AS t(k))),
f AS (SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY lang, phrase, k HAVING count(*) >= 100),
candidates AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cuts AS (
  SELECT lang, phrase, f AS a, cut, array_to_string(ws[1 : cut], ' ') AS lp, array_to_string(ws[cut + 1 : k], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r, n, (1000::HUGEINT * a * n // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.lp JOIN f r ON r.lang = c.lang AND r.phrase = c.rp JOIN counted ON counted.lang = c.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, array_to_string(ws[i : i + s - 1], ' ') AS phrase, max(f) AS most
  FROM (SELECT *, unnest(range(1, k - s + 2)) AS i FROM candidates, range(2, 5) AS t(s) WHERE s < k) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * a QUALIFY rank <= 2000
"""
SQL: dict[str, str] = {"op3_line_dedup": _OP3, "op6_chat_format": _OP6, "op8_suffix_dedup": _OP8, "op9_topk": _OP9, "op12_collocations": _OP12}
