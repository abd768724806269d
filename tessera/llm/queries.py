"""The registered queries of the subpackage, and DuckDB SQL where it can say
the same over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.bpe import bpe_digests
from tessera.llm.common import cut_lineage, documents
from tessera.llm.conversations import damage, repair
from tessera.llm.decontaminate import contamination
from tessera.llm.exact_dedup import copy_groups
from tessera.llm.fingerprints import fingerprint_documents
from tessera.llm.mixing import plan_mix
from tessera.llm.quality import fit, score, with_statistics
from tessera.llm.sharding import shard_documents
from tessera.llm.simhash import near_duplicates
from tessera.llm.spelling import spelling_variants
from tessera.llm.suffix_dedup import remove_repeats
from tessera.llm.token_counts import token_counts
from tessera.llm.toxicity import score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_mix(documents(spark, sf_dir), weights=(3, 1, 2), share=1.5, most=2)


@register
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register
def op3_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir), weights=[1.0] * 8)


@register
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), "toxic", threshold=0.5)


@register
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


@register
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir), size=3, most=3, seed=42)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir)).drop("removed_digests", "added_digests")


@register
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copy_groups(documents(spark, sf_dir), keep="max")


ORACLES["op8_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


@register
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = cut_lineage(with_statistics(documents(spark, sf_dir)))
    return score(stats, fit(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality"), threshold=0.3)


@register
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


#: CRC-32 of the bytes of ``w``, by the table ``tab`` that ``CRC_TABLE`` makes of the polynomial.
CRC_TABLE = """crc AS MATERIALIZED (SELECT list(x ORDER BY k) AS tab FROM (
  SELECT k, list_reduce(range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, k) AS x FROM range(256) r(k)))"""
CRC = """xor(list_reduce(list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT),
  lambda a, b: xor(a >> 8, tab[1 + (xor(a, b) & 255)]), 4294967295), 4294967295)"""
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@register
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair(damage(rows), ids=rows)


ORACLES["op11_repair"] = f"""
WITH RECURSIVE {CRC_TABLE},
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS w FROM conversations),
kinds AS (SELECT conv_id, turn, role, text, {CRC} % 20 AS kind FROM named, crc),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(2) c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid FROM damaged),
marked AS (
  SELECT *, role[1] AS initial, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS prior,
         CASE WHEN solid = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault
  FROM numbered),
sums AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (prior IS NOT NULL AND prior || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id),
inserts(q, letters, price, lines, q2) AS (VALUES
  (0, '', 0, []::VARCHAR[], 0), (1, '', 0, [], 1), (2, '', 0, [], 2), (3, '', 0, [], 3),
  (0, 'I', 5, ['user:'], 2), (0, 'II', 10, ['user:', 'assistant:'], 3), (1, 'I', 5, ['user:'], 2), (1, 'II', 10, ['user:', 'assistant:'], 3),
  (2, 'I', 5, ['assistant:'], 3), (3, 'I', 5, ['user:'], 2)),
writes(q, initial, role, q2) AS (VALUES (0, 's', 'system', 1), (0, 'u', 'user', 2), (1, 'u', 'user', 2), (2, 'a', 'assistant', 3), (3, 'u', 'user', 2)),
edits(q, initial, letter, price, q2) AS (
  SELECT q, NULL, 'D', 2, q FROM range(4) r(q)
  UNION ALL SELECT q, initial, 'K', 0, q2 FROM writes
  UNION ALL SELECT q, role, 'R', 1, q2 FROM writes WHERE initial <> 's'),
best AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM sums
  UNION ALL
  SELECT conv_id, i, q, cost, audit, lines FROM (
    SELECT b.conv_id, b.i + 1 AS i, e.q2 AS q, b.cost + s.price + e.price + CASE WHEN e.letter <> 'D' AND m.fault = 'truncated' THEN 5 ELSE 0 END AS cost,
           b.audit || s.letters || e.letter AS audit,
           list_concat(b.lines, s.lines, CASE e.letter WHEN 'D' THEN [] WHEN 'K' THEN [m.role || ':' || m.text] ELSE [e.initial || ':' || m.text] END) AS lines
    FROM best b JOIN marked m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.i = b.i + 1
    JOIN inserts s ON s.q = b.q JOIN edits e ON e.q = s.q2
    WHERE e.letter = 'D' OR (m.fault NOT IN ('blank', 'duplicate') AND (e.letter = 'R' OR e.initial = m.initial))
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1),
ended AS (
  SELECT b.conv_id, b.cost + s.price AS cost, b.audit || s.letters AS audit, list_concat(b.lines, s.lines) AS lines
  FROM best b JOIN sums ON sums.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i = sums.n JOIN inserts s ON s.q = b.q WHERE s.q2 IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + s.price, b.audit || s.letters) = 1)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@register
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


ORACLES["op12_spelling"] = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, {LOWER.format("run")} AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, n, {CRC} AS h FROM (SELECT run, n, coalesce(doc_id::VARCHAR, '') || ':' || run AS w FROM runs), crc),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
without AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words, unnest(range(length(word))) u(i)),
shorter AS (SELECT DISTINCT l.word AS long, l.n AS long_n, s.word AS short, s.n AS short_n FROM without l JOIN words s ON s.word = l.rest),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM without a JOIN without b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT long, short, short_n FROM shorter
  UNION ALL SELECT short, long, long_n FROM shorter),
tops AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word),
formed AS MATERIALIZED (
  SELECT words.word, CASE WHEN other_n >= 10 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words LEFT JOIN tops ON tops.word = words.word),
ways AS (
  SELECT word, word AS root, form FROM formed
  UNION ALL SELECT ways.word, ways.form, f.form FROM ways JOIN formed f ON f.word = ways.form)
SELECT formed.word, formed.form, root, n, n_near, form_n FROM formed JOIN ways ON ways.word = formed.word AND ways.form IS NULL
"""


@register
def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


ORACLES["op13_decontaminate"] = f"""
WITH docs AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all({LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS words FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item, least(len(words), 10) AS k, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS phrase
  FROM items, unnest(range(1, greatest(len(words) - 10, 0) + 2)) u(i) WHERE len(words) > 0),
grams AS (
  SELECT r, i, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
  FROM (SELECT r, k, words, unnest(range(1, len(words) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM windows))),
hits AS MATERIALIZED (SELECT r, i, grams.k, item FROM grams JOIN windows ON windows.phrase = grams.phrase AND windows.k = grams.k),
covered AS (SELECT r, count(DISTINCT w) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS w FROM hits) GROUP BY r),
owned AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered ON covered.r = docs.r LEFT JOIN owned ON owned.r = docs.r
"""
