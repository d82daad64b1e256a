"""One query per operator, on its whole table with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwise.llm.common import table, tokenizer_path
from tripwise.llm import (ann, bpe_lexicon, huffman, lsh_forest, order_minhash, packing, periodic_runs, prefix_trie, quality,
                          secrets, simhash, toxicity, url_filter)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return keep


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


#: Fixed values of the query's contract.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

URL_SQL = r"""
WITH u AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM u)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r"""


@register("op1_url_filter", URL_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@register("op8_simhash_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4)


@register("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.classify(docs, labels).select("doc_id", "held_out", "score", "predicted")


@register("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs).select("doc_id", "votes", "posterior", "score", "predicted")


@register("op4_secret_scans")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@register("op5_ann_one_bit")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register("op6_order_minhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edited_copies(table(spark, sf_dir, "documents"))


@register("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@register("op9_huffman_tokens")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@register("op10_bpe_lexicon")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_lexicon.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@register("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(table(spark, sf_dir, "documents"))


@register("op12_lsh_forest")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"))


#: Turns are structs of role and text; a prefix is a list of them, compared as a whole.
TRIE_SQL = r"""
WITH own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (
  SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
      lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 4 AS h
  FROM own),
built AS (
  SELECT o.conv_id AS c, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns
  FROM hashed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
member AS (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM built),
prefix AS (SELECT c, d, len(turns) AS m, turns[1:d] AS p FROM member),
node AS (
  SELECT p, d, min(c) AS least, count(*) AS n,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (m = d), '')) AS ends
  FROM prefix GROUP BY p, d),
valued AS (
  SELECT k.*, CASE WHEN d = 0 THEN 0 ELSE (n - 1) * len(regexp_extract_all(p[d].t, '[^\x20\x09-\x0D]+')) END AS saved,
    (SELECT count(*) FROM node c WHERE c.d = k.d + 1 AND c.p[1:k.d] = k.p) AS children
  FROM node k),
below AS (
  SELECT u, count(*) FILTER (children = 0) AS leaves, sum(saved) AS saved
  FROM (SELECT unnest(list_transform(range(0, d + 1), lambda i: p[1:i])) AS u, children, saved FROM valued) GROUP BY u)
SELECT k.least AS conv_id, k.d AS depth, up.least AS parent_conv_id, k.n AS n_convs, k.children AS n_children,
  below.leaves AS n_leaves, below.saved::BIGINT AS saved_tokens, k.ends AS ends_sha256
FROM valued k JOIN below ON below.u = k.p LEFT JOIN node up ON k.d > 0 AND up.d = k.d - 1 AND up.p = k.p[1:k.d - 1]"""


@register("op11_conversation_trie", TRIE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.conversations(turns)))
