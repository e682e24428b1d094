"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ndspark.llm import bpe, chat_format, langid, mixing, outliers, rules, setsketch, spotsigs, toxicity, url_filter
from ndspark.llm.common import table

#: Verdict, host, path of each rule.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]

#: Public vocabulary files are a parameter of the tokenizing operators.
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)


def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprint_edits(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).selectExpr("cast(-1 as bigint) conv_id", "id turn", "if(id = 0, 'user', 'assistant') role", f"'{said}' text")
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(more)
    return chat_format.digests(chat_format.read_back(chat_format.expand(turns)))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents", "doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents", "doc_id", "text"), VOCABULARY, public_tokenizers.PATTERN)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = outliers.statistics(table(spark, sf_dir, "documents", "doc_id", "lang", "source", "text"))
    return outliers.judge(counts).drop("lang", "source")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.judge(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op9_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), shingle=2)


def op10_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_url_filter, op2_spotsigs, op3_chat_format, op4_toxicity, op5_mixing, op6_byte_bpe, op7_quality_rules, op8_language_id, op9_setsketch, op10_rule_ensemble)
}

_RULES_SQL = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
_URL_SQL = f"""
WITH parts AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages
), rules(v, h, p) AS (VALUES {_RULES_SQL})
SELECT page_id, host, path, max_by(h || p, length(h || p)) AS rule, coalesce(max_by(v, length(h || p)), 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY page_id, host, path
"""


def _escaped(c: str) -> str:
    """SQL for chat_format.escape."""
    out = f"replace(coalesce({c}, ''), '&', '&amp;')"
    for a, b in chat_format.CONTROL.items():
        out = f"replace({out}, '{a}', '{b}')"
    return out


_CHAT_SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
    SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
           sum({len(chat_format.TURN) + 1 + len(chat_format.END) + 1} + length(replace({_escaped("role")}, chr(10), '&#10;')) + length({_escaped("text")})) OVER (w ROWS UNBOUNDED PRECEDING) AS total
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(total) FILTER (WHERE role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""
#: Exact over all pairs that share a shingle; meant for small tables.
_NEAR_SQL = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s FROM texts
), rows_ AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM rows_ a JOIN rows_ b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(a, b) AS (SELECT doc_id, doc_id FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least ON a = doc_id
"""
_MIX_SQL = r"""
WITH docs AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           md5(text) AS digest
    FROM (SELECT doc_id, source, coalesce(text, '') AS text FROM documents)
), marked AS (
    SELECT *, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(source, '') || ':' || size || ':' || digest) AS mark FROM docs
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS n, CAST([5, 2, 1][(row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w FROM docs GROUP BY source
), filled AS (
    -- sources in the order in which they reach their cap; the level is the first that no other source's cap is below
    SELECT *, 3.0::DOUBLE * n AS cap, 3.0::DOUBLE * n / w AS ratio,
           (sum(n) OVER () - coalesce(sum(3.0::DOUBLE * n) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources WINDOW o AS (ORDER BY 3.0::DOUBLE * n / w, source)
), targets AS (
    SELECT source, n, CASE WHEN ratio < water THEN cap ELSE least(cap, water * w) END AS target
    FROM filled, (SELECT min_by(level, ratio) AS water FROM filled WHERE level <= ratio)
), placed AS (
    SELECT doc_id, size, n, target, CASE WHEN n = 0 THEN 0 ELSE CAST(floor(target / n) AS BIGINT) END AS epochs,
           coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY mark ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM marked d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, n AS source_size, target,
       CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * n - before)) AS BIGINT) AS taken
FROM placed
"""

#: The others train models, keep sketches or recurse over a vocabulary; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {"op1_url_filter": _URL_SQL, "op3_chat_format": _CHAT_SQL, "op5_mixing": _MIX_SQL, "op9_setsketch": _NEAR_SQL}
