"""One query per operator over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweave.llm import (
    exact_dedup,
    fm_index,
    language,
    maxent,
    mixing,
    near_join,
    packing,
    phrases,
    prefix_free,
    ranked_search,
    records,
    url_filter,
    winnow,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return winnow.compare_with_next(_table(spark, folder, "documents"))


def op2_near_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_join.near_classes(_table(spark, folder, "documents"))


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_free.remove_repeats(_table(spark, folder, "documents")).drop("spans")


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(
        _table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return fm_index.remove_repeats(_table(spark, folder, "documents")).drop("spans")


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    profile = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    return language.predict_languages(docs, profile)


def op7_records(spark: SparkSession, folder: str) -> DataFrame:
    return records.round_trip(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_copies(_table(spark, folder, "documents"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, folder, "documents"))


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, folder, "pages"), url_filter.rule_table(spark))


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.mine_phrases(_table(spark, folder, "documents"))


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.rank_documents(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_maxent(spark: SparkSession, folder: str) -> DataFrame:
    return maxent.score_texts(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_fingerprints,
        op2_near_join,
        op3_suffix_dedup,
        op4_packing,
        op5_substring_dedup,
        op6_language,
        op7_records,
        op8_exact_dedup,
        op9_mixing,
        op10_url_filter,
        op11_phrases,
        op12_ranked_search,
        op13_maxent,
    )
}

ORACLE_SQL = {
    "op12_ranked_search": r"""
        WITH worded AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), used AS (
            SELECT row, doc_id, w, len(w)::BIGINT AS n FROM worded WHERE len(w) > 0
        ), totals AS (
            SELECT count(*)::HUGEINT AS docs, sum(n)::HUGEINT AS words FROM used
        ), lengths AS (
            SELECT row, doc_id, (100 - 25 + (25 * n * docs) // words)::BIGINT AS m FROM used, totals
        ), postings AS (
            SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM used) GROUP BY ALL
        ), weighted AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM postings, totals GROUP BY term, docs
        ), asked AS (
            SELECT item_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), scored AS (
            SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
            FROM asked JOIN postings USING (term) JOIN weighted USING (term) JOIN lengths USING (row)
            GROUP BY ALL
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM scored WHERE score > 0
        QUALIFY rank <= 20
    """,
    "op11_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), worded AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
        ), occurrences AS (
            SELECT lang, 1 AS words, unnest(w) AS phrase FROM worded
            UNION ALL
            SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM worded
            UNION ALL
            SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1),
                                                  lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM worded
        ), counts AS (
            SELECT lang, words, phrase, count(*) AS f FROM occurrences GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE words = 1 GROUP BY lang
        ), cuts AS (
            SELECT lang, phrase, f AS a, words, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS first,
                   array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
            FROM counts, (VALUES (1), (2)) AS cut(k)
            WHERE f >= 10 AND k < words
        ), scored AS (
            SELECT c.lang, c.phrase, c.a, c.words, c.k, x.f AS l, y.f AS r,
                   ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM cuts c
            JOIN counts x ON x.lang = c.lang AND x.phrase = c.first
            JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1
        ), around AS (
            SELECT lang, phrase, max(f) AS f
            FROM (
                SELECT lang, f, array_to_string(string_split(phrase, ' ')[i:i + 1], ' ') AS phrase
                FROM counts, (VALUES (1), (2)) AS part(i) WHERE words = 3 AND f >= 10
            ) GROUP BY ALL
        ), kept AS (
            SELECT s.* FROM scored s LEFT JOIN around o ON o.lang = s.lang AND o.phrase = s.phrase
            WHERE o.f IS NULL OR 100 * o.f < 50 * s.a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score
        FROM kept JOIN totals USING (lang)
        QUALIFY rank <= 2000
    """,
    "op8_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op10_url_filter": """
        WITH rules(verdict, r_host, r_path) AS (
            VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                   ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
        ), rests AS (
            SELECT page_id,
                   CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), parts AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM rests
        ), judged AS (
            SELECT p.page_id, p.host, p.path, r.r_host || r.r_path AS rule, r.verdict,
                   row_number() OVER (
                       PARTITION BY p.page_id
                       ORDER BY length(r.r_host || r.r_path) DESC NULLS LAST, length(r.r_host) DESC
                   ) AS place
            FROM parts p
            LEFT JOIN rules r
              ON (p.host = r.r_host OR p.host LIKE '%.' || r.r_host) AND starts_with(p.path, r.r_path)
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM judged WHERE place = 1
    """,
}
