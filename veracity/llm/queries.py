"""Registered queries of the operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from veracity.llm import (gru_lm, html_extract, langid, mixing, multi_index, packing, prefix_trie, quality, sharding, strata_search,
                          superminhash, topk, warc)
from veracity.llm.shared import table
from veracity.session import ensure_checkpoint_dir

#: Path of the vocabulary that packing counts by; a parameter of the operator.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op3_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op4_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op6_gru_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.score(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op10_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_length_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strata_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(warc.deduplicate(table(spark, sf_dir, "pages")), folder)
    return warc.resolve(warc.read(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_maxscore_topk, op2_packing, op3_html_consensus, op4_ordinal_quality, op5_bounded_ring,
                            op6_gru_scoring,
                            op7_language_id, op8_multi_index, op9_superminhash, op10_entropy_mix, op11_length_strata,
                            op12_prefix_trie, op13_warc_revisits)}

ORACLES: dict[str, str] = {
    "op1_maxscore_topk": """
        WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND len(embedding) > 0
                     AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(
                  [CAST(x AS DOUBLE) FOR x IN q.e], [CAST(x AS DOUBLE) FOR x IN c.e]) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10""",
    "op11_length_strata": r"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS row_id, regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        held AS (SELECT doc_id, row_id, terms, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
        size AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM held),
        asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        flat AS (SELECT row_id, unnest(terms) AS term FROM held),
        tf AS (SELECT row_id, term, CAST(count(*) AS BIGINT) AS tf FROM flat GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
              FROM tf, size GROUP BY term),
        m AS (SELECT doc_id, row_id, 50 + (50 * n * n_docs) // n_terms AS m FROM held, size),
        s AS (SELECT item_id, any_value(doc_id) AS doc_id, row_id,
                     CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
              FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN m USING (row_id) GROUP BY item_id, row_id)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50""",
    "op12_prefix_trie": r"""
        WITH t AS (SELECT conv_id, turn, coalesce(text, '') AS text,
                          md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS tid
                   FROM conversations WHERE conv_id IS NOT NULL),
        p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tid) AS pos FROM t),
        c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(
                  list_concat([4294967295], [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
                  lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                           lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) % 4 AS h
              FROM (SELECT DISTINCT conv_id FROM p)),
        r AS (SELECT c.conv_id, 0 AS own, p.pos, tid, text FROM c JOIN p ON p.conv_id = c.base AND p.pos <= h
              UNION ALL SELECT c.conv_id, 1, p.pos, tid, text FROM c JOIN p ON p.conv_id = c.conv_id AND p.pos > h),
        g AS (SELECT conv_id, text, row_number() OVER o AS depth, string_agg(tid, '') OVER o AS path
              FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY own, pos)),
        mem AS (SELECT conv_id, depth, path, text FROM g UNION ALL SELECT conv_id, 0, '', '' FROM c),
        total AS (SELECT conv_id, max(depth) AS total FROM mem GROUP BY conv_id),
        node AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n,
                        CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(any_value(text),
                            '[^\x20\x09-\x0D]+')) END AS saved,
                        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = total), '')) AS sha
                 FROM mem JOIN total USING (conv_id) GROUP BY path, depth),
        kids AS (SELECT left(path, len(path) - 32) AS path, count(*) AS kids FROM node WHERE depth > 0 GROUP BY 1),
        full_ AS (SELECT node.*, coalesce(kids, 0) AS kids FROM node LEFT JOIN kids USING (path)),
        up AS (SELECT left(path, 32 * CAST(unnest(range(0, depth + 1)) AS INTEGER)) AS path, saved,
                      CASE WHEN kids = 0 THEN 1 ELSE 0 END AS leaf FROM full_),
        sums AS (SELECT path, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves FROM up GROUP BY path)
        SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, CAST(f.n AS BIGINT) AS n_convs,
               CAST(f.kids AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
               f.sha AS ends_sha256
        FROM full_ f JOIN sums USING (path)
        LEFT JOIN node q ON f.depth > 0 AND q.depth = f.depth - 1 AND q.path = left(f.path, len(f.path) - 32)""",
    "op13_warc_revisits": """
        WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
        d AS (SELECT page_id, url, CAST(strlen(html) AS BIGINT) AS payload_bytes, list_aggregate(list_transform(range(0, 32),
                  lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(hex, 1 + 5 * CAST(i // 4 AS INTEGER), 5)
                      AS BIGINT) >> (15 - 5 * (i % 4))::INTEGER) & 31)::INTEGER, 1)), 'string_agg', '') AS payload_digest FROM p),
        o AS (SELECT *, row_number() OVER w AS place, first_value(page_id) OVER w AS first
              FROM d WINDOW w AS (PARTITION BY payload_digest, payload_bytes ORDER BY page_id NULLS LAST, url NULLS FIRST))
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN place > 1 THEN first END AS refers_to FROM o""",
}
