"""The registered queries of the text operators, each on its whole table, and the SQL that states a result."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, classifier, conversations, decontaminate, html, lexical_search, ngram_join, pii, rules, shards, token_files, toxicity, url_filter
from .common import work_folder, written

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# An id that the vocabulary leaves free.
SEPARATOR = 50256


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify_quality(_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rule_report(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"), size=4, percent=85, n_links=True)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign_shards(_table(spark, sf_dir, "documents"), shards.even_tree(24))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as flat token files (written once), then the scan of their blocks; as a table where Python cannot write."""
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    streams = token_files.flat_tokens(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, SEPARATOR)
    folder = f"{work_folder(spark)}/llm-streams-{uuid.uuid4().hex}"
    if token_files._local(folder) is None:
        return token_files.count_document_tokens(written(streams, "streams"), SEPARATOR)
    token_files.write_token_files(streams, folder)
    blocks = token_files.read_token_files(spark, folder)
    name = F.regexp_extract("file", r"([^/]+)\.bin$", 1)
    return token_files.count_document_tokens(blocks.withColumn("file", name), SEPARATOR)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.benchmark_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return hits.drop("hit_spans")


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_main_text(_table(spark, sf_dir, "pages"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.encode_digest(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(_table(spark, sf_dir, "conversations"))


# The rules that the query is given, fixed values.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_quality_rules, op3_toxicity, op4_ngram_jaccard_join, op5_sharding,
        op6_token_counts, op7_personal_data, op8_decontamination, op9_main_text, op10_byte_bpe,
        op11_lexical_search, op12_conversation_repair, op13_url_filters,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
grams AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS k FROM grams) WHERE k > 1),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r),
f AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    coalesce(hit.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: regexp_full_match(x, '[^a-z]*[A-Z][^a-z]*') AND strlen(x) > 1)) AS shouted,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS echoes
  FROM d LEFT JOIN hit USING (r)),
g AS (SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (100 * n_symbols > 5 * word_chars OR 100 * shouted > 30 * n_words OR 100 * n_dup_lines > 50 * len(lines) OR 100 * echoes > 30 * n_words
    OR NOT (2 * n_words <= word_chars AND word_chars <= 15 * n_words)) AS kept
FROM g""",
    "op11_lexical_search": r"""
WITH t AS (SELECT doc_id, r, unnest(w) AS term FROM (SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents)),
q AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
d AS (SELECT r, any_value(doc_id) AS doc_id, count(*)::BIGINT AS n FROM t GROUP BY r),
g AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM d),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM t GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, g GROUP BY term, docs),
s AS (SELECT item_id, doc_id, r, sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN d USING (r), g GROUP BY item_id, doc_id, r)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10""",
    "op12_conversation_repair": r"""
WITH RECURSIVE crc AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i)),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
coded AS (SELECT * EXCLUDE (key, t), xor(list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS code FROM keyed, crc),
rows AS (SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role, unnest(range(CASE code WHEN 3 THEN 2 ELSE 1 END)) AS copy,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM coded WHERE code <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS x FROM rows),
r AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lead(x) OVER (PARTITION BY conv_id ORDER BY i) AS y FROM placed),
chain(s, t, ins, c, made) AS (VALUES (0, 0, '', 0, ''), (1, 1, '', 0, ''), (2, 2, '', 0, ''), (3, 3, '', 0, ''), (0, 2, 'I', 2, 'user:' || chr(10)), (1, 2, 'I', 2, 'user:' || chr(10)),
  (3, 2, 'I', 2, 'user:' || chr(10)), (2, 3, 'I', 2, 'assistant:' || chr(10)), (0, 3, 'II', 4, 'user:' || chr(10) || 'assistant:' || chr(10)), (1, 3, 'II', 4, 'user:' || chr(10) || 'assistant:' || chr(10))),
keep(s, x, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
arc AS (SELECT conv_id, i, s, t, 'K' AS e, CASE fault WHEN 'truncated' THEN 1 ELSE 0 END AS c, role || ':' || text || chr(10) AS made FROM r JOIN keep USING (x) WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, i, s, t, 'R', CASE fault WHEN 'truncated' THEN 3 ELSE 2 END, CASE t WHEN 2 THEN 'user:' ELSE 'assistant:' END || text || chr(10)
    FROM r, (VALUES (0, 2), (1, 2), (2, 3), (3, 2)) AS n(s, t) WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, i, s, s, 'D', 3, '' FROM r, (VALUES (0), (1), (2), (3)) AS n(s)),
path AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS s, 0 AS cost, '' AS audit, '' AS made FROM r
  UNION ALL (SELECT p.conv_id, p.i + 1, a.t, p.cost + k.c + a.c, p.audit || k.ins || a.e, p.made || k.made || a.made
    FROM path AS p JOIN chain AS k ON k.s = p.s JOIN arc AS a ON a.conv_id IS NOT DISTINCT FROM p.conv_id AND a.i = p.i + 1 AND a.s = k.t
    QUALIFY row_number() OVER (PARTITION BY p.conv_id, a.t ORDER BY p.cost + k.c + a.c, p.audit || k.ins || a.e) = 1)),
facts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (x || y NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
done AS (SELECT f.*, p.cost + k.c AS cost, p.audit || k.ins AS audit, p.made || k.made AS made
  FROM facts AS f JOIN path AS p ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND p.i = f.n JOIN chain AS k ON k.s = p.s AND k.t IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY f.conv_id ORDER BY p.cost + k.c, p.audit || k.ins) = 1)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(left(made, length(made) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c LEFT JOIN done AS d ON d.conv_id IS NOT DISTINCT FROM c.conv_id""",
    "op13_url_filters": r"""
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
r(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
c AS (SELECT b.*, (SELECT max_by({'r': h || p, 'v': v}, length(h || p)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS x FROM b)
SELECT page_id, host, path, x.r AS rule, coalesce(x.v, 'allow') AS verdict FROM c""",
}
