"""The registered queries of this subpackage: ``name -> (function, DuckDB SQL or None)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wxmesh.llm import (
    best_fit,
    decontaminate,
    html_text,
    katz,
    language_id,
    packing,
    prefix_trie,
    quality_pu,
    quality_rules,
    simhash,
    spelling,
    suffix_dedup,
    toxicity,
)
from wxmesh.llm.common import table


def tokenizer_paths() -> tuple[str, str]:
    """The vocabulary that the packing query uses, as JSON and as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).drop("text")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id", "toxic as label")
    return toxicity.classify(table(spark, sf_dir, "documents"), labels)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id", "quality as label")
    return quality_pu.classify(table(spark, sf_dir, "documents"), labels)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id", "quality as label")
    return quality_rules.assess(table(spark, sf_dir, "documents"), labels)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer_paths())


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return best_fit.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(spelling.vocabulary(table(spark, sf_dir, "documents")))


#: Whole texts as hex; each 50-byte string with the smallest id that has it; covered bytes as spans.
SUFFIX_DEDUP_SQL = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM texts)),
earliest AS (SELECT s, min(doc_id) AS first_id FROM strings GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT doc_id, i FROM strings JOIN earliest USING (s) WHERE first_id < doc_id),
marked AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER w + 50 THEN 0 ELSE 1 END AS opens
  FROM gone WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM marked),
spans AS (SELECT doc_id, k, min(i) AS lo, max(i) + 50 AS hi FROM numbered GROUP BY doc_id, k),
gaps AS (  -- what is kept: before each span, and after the last
  SELECT doc_id, k, coalesce(lag(s.hi) OVER (PARTITION BY s.doc_id ORDER BY s.k), 0) AS lo, s.lo AS hi FROM spans s
  UNION ALL
  SELECT t.doc_id, 1e9, coalesce(max(s.hi), 0), any_value(length(t.h) // 2)
  FROM texts t LEFT JOIN spans s USING (doc_id) GROUP BY t.doc_id),
kept AS (
  SELECT g.doc_id, string_agg(substr(t.h, 2 * CAST(g.lo AS BIGINT) + 1, 2 * CAST(g.hi - g.lo AS BIGINT)), '' ORDER BY g.k) AS h
  FROM gaps g JOIN texts t USING (doc_id) GROUP BY g.doc_id),
counted AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT t.doc_id, CAST(length(t.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(c.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(c.n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(k.h)) AS kept_sha256
FROM texts t JOIN kept k USING (doc_id) LEFT JOIN counted c USING (doc_id)"""

#: crc32 in SQL: the 256 remainders by their rule, then one step per byte of ``{text}``.
CRC_TABLE = """
crc_steps AS (
  SELECT list(list_reduce(range(8), lambda r, k: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END, b) ORDER BY b) AS step
  FROM range(256) AS t(b))"""


def crc_sql(text: str) -> str:
    """The unsigned crc32 of an SQL text expression, where ``crc_steps`` is joined."""
    return (f"xor(list_reduce(range(length(hex(encode({text}))) // 2), lambda r, k: "
            f"xor(r // 256, step[1 + xor(r % 256, CAST(concat('0x', substr(hex(encode({text})), 2 * k + 1, 2)) AS BIGINT))]), "
            f"4294967295), 4294967295)")


#: Rebuilt conversations as lists; every prefix with its members; every node under each of its own prefixes.
PREFIX_TRIE_SQL = f"""
WITH {CRC_TABLE},
own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
    ORDER BY turn NULLS FIRST, coalesce(role, ''),
             sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
lent AS (SELECT conv_id, turns, {crc_sql("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM own, crc_steps),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS path
  FROM lent a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
members AS (SELECT conv_id, len(path) AS size, unnest(range(len(path) + 1)) AS depth, path FROM rebuilt),
nodes AS (
  SELECT depth, path[1:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (size = depth), '') AS ends,
         (count(*) - 1) * max(CASE WHEN depth = 0 THEN 0 ELSE strlen(path[depth].text) END) AS saved
  FROM members GROUP BY depth, path[1:depth]),
kids AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY prefix[1:depth - 1]),
counted AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (prefix)),
above AS (SELECT unnest(range(depth + 1)) AS up, prefix, n_children, saved FROM counted),
sums AS (
  SELECT prefix[1:up] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM above GROUP BY prefix[1:up])
SELECT CAST(n.conv_id AS BIGINT) AS conv_id, CAST(n.depth AS BIGINT) AS depth, CAST(p.conv_id AS BIGINT) AS parent_conv_id,
       CAST(n.n_convs AS BIGINT) AS n_convs, CAST(n.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM counted n JOIN sums s USING (prefix) LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = n.prefix[1:n.depth - 1]"""

#: Words with the planted slips; words that agree but for one place, or that lack one code point of another.
SPELLING_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{6,}}')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
hashed AS (
  SELECT run, n, {crc_sql("concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', run)")} AS h
  FROM (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run), crc_steps),
slipped AS (
  SELECT CASE WHEN h % 199 = 0 THEN concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word, n
  FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
places AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
cut AS (SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM places),
near AS (
  SELECT x.word, y.word AS other, y.n AS n_other FROM cut x JOIN cut y USING (i, a, b) WHERE x.word <> y.word
  UNION SELECT x.word, w.word, w.n FROM cut x JOIN words w ON w.word = concat(x.a, x.b)
  UNION SELECT w.word, x.word, x.n FROM cut x JOIN words w ON w.word = concat(x.a, x.b)),
best AS (
  SELECT word, count(*) AS n_near, max(n_other) AS n_best, min(other) FILTER (n_other = n_most) AS other
  FROM (SELECT *, max(n_other) OVER (PARTITION BY word) AS n_most FROM near) GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.n_best >= 5 * w.n THEN b.other END AS form,
         CASE WHEN b.n_best >= 5 * w.n THEN b.n_best END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
roots AS (
  SELECT word AS root, word FROM forms WHERE form IS NULL
  UNION ALL SELECT r.root, f.word FROM forms f JOIN roots r ON f.form = r.word)
SELECT f.word, f.form, r.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM forms f JOIN roots r USING (word)"""

QUERIES = {
    "op1_decontamination": (op1_decontamination, None),
    "op2_suffix_dedup": (op2_suffix_dedup, SUFFIX_DEDUP_SQL),
    "op3_toxicity": (op3_toxicity, None),
    "op4_html_extraction": (op4_html_extraction, None),
    "op5_language_id": (op5_language_id, None),
    "op6_simhash": (op6_simhash, None),
    "op7_lm_scoring": (op7_lm_scoring, None),
    "op8_quality_classifier": (op8_quality_classifier, None),
    "op9_quality_rules": (op9_quality_rules, None),
    "op10_packing": (op10_packing, None),
    "op11_best_fit_packing": (op11_best_fit_packing, None),
    "op12_prefix_trie": (op12_prefix_trie, PREFIX_TRIE_SQL),
    "op13_spelling_variants": (op13_spelling_variants, SPELLING_SQL),
}
