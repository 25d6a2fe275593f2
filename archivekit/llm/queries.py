"""The named queries of these operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivekit.llm import (
    bytebpe, conversations, ctw, decontaminate, divergence, licenses, neardup, piececount, projections, redirects, shards,
    toxicity, warc,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op8_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), size=2, percent=80)


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.score_documents(docs, table(spark, folder, "labels")).drop("text")


def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_content_addressed_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages")).drop("record_length")


def op4_byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digests(table(spark, folder, "documents"))


def bpe_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Token ids of whole texts and the bytes decoded from them, as counts and digests."""
    import public_tokenizers

    files = path or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return docs.select("doc_id", bytebpe.digest_udf(*files)("text").alias("d")).select("doc_id", "d.*")


def op5_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return projections.near_vectors(table(spark, folder, "embeddings"))


def op6_karmarkar_karp_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shard_documents(table(spark, folder, "documents"), 24)


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(table(spark, folder, "documents"))


def op9_context_tree_weighting(spark: SparkSession, folder: str) -> DataFrame:
    return ctw.score_documents(table(spark, folder, "documents"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = piececount.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    return counted.select("doc_id", n_bytes, "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op11_source_divergence_audit(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op12_redirect_equivalence(spark: SparkSession, folder: str) -> DataFrame:
    return redirects.judge(table(spark, folder, "pages"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair_damaged(table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_content_addressed_warc": op3_content_addressed_warc,
    "op4_byte_level_bpe": op4_byte_level_bpe,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_karmarkar_karp_sharding": op6_karmarkar_karp_sharding,
    "op7_license_scan": op7_license_scan,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_context_tree_weighting": op9_context_tree_weighting,
    "op10_token_counts": op10_token_counts,
    "op11_source_divergence_audit": op11_source_divergence_audit,
    "op12_redirect_equivalence": op12_redirect_equivalence,
    "op13_conversation_repair": op13_conversation_repair,
}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# Rules of `redirects.RULES`, longest first, as a SQL expression of host and path.
_RULED = "CASE " + " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p} {v}'"
    for h, p, v in sorted(redirects.RULES, key=lambda r: (-len(r[0] + r[1]), r[2] != "allow"))
) + " END"
_HOST = f"translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), {_LOWER})"
_PATH = "regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"

#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op3_content_addressed_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), d AS (
            SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d
        )
        SELECT page_id, n AS payload_bytes, digest AS payload_digest,
               CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
        FROM f""",
    "op5_embedding_near_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        ), sound AS MATERIALIZED (
            SELECT vec_id, label, e FROM v
            WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(e, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
            ON a.label = b.label AND a.vec_id < b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98
        ), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (
            SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a
        ), least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
        counts AS (SELECT a AS vec_id, count(*) AS n FROM edges GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM v JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)""",
    "op8_minhash_near_dedup": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
        ), sets AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
                ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM d
        ), s AS (SELECT doc_id, unnest(g) AS shingle, len(g) AS n FROM sets),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
            GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
        ), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a
        ), least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, len(g) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)""",
    "op11_source_divergence_audit": f"""
        WITH d AS (
            SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
                                      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
            FROM documents
        ), w AS (SELECT doc, lang, source, unnest(terms) AS term FROM d),
        k AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT doc) >= 30),
        c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
        g AS (
            SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(sum(n), 0) AS total
            FROM (SELECT DISTINCT lang, source FROM d)
            LEFT JOIN (SELECT lang, count(*) AS v FROM k GROUP BY lang) USING (lang)
            LEFT JOIN c USING (lang, source) GROUP BY lang, source
        ), dense AS (
            SELECT lang, source, term, coalesce(n, 0) AS n,
                   1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v) AS p
            FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
        ), whole AS (
            SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // (any_value(lang_total) + 5 * any_value(v)) AS q
            FROM c JOIN (SELECT lang, sum(n) AS lang_total FROM c GROUP BY lang) USING (lang)
                   JOIN (SELECT DISTINCT lang, v FROM g) USING (lang)
            GROUP BY lang, term
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN dense x ON x.lang = a.lang AND x.source = a.source
            LEFT JOIN dense y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
            GROUP BY ALL
        ), found AS (
            SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL
            SELECT lang, source, 'term', term, p - q FROM dense JOIN whole USING (lang, term) WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM found
        )
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR rank <= 50""",
    "op12_redirect_equivalence": f"""
        WITH RECURSIVE tags AS (
            SELECT url AS base, unnest(regexp_extract_all(regexp_replace(html,
                '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', ' ', 'g'),
                '(?is)<(?:link|meta)\\s[^>]*>')) AS tag
            FROM pages WHERE contains(url, '://')
        ), said AS (
            SELECT base, trim(replace(CASE
                WHEN regexp_matches(tag, '(?is)^<link\\s.*?\\brel\\s*=\\s*["'']?\\s*canonical\\s*(?:["'']|\\s|/?>)')
                THEN regexp_extract(tag, '(?is)\\shref\\s*=\\s*["'']?([^\\s"''>]*)', 1)
                WHEN regexp_matches(tag, '(?is)^<meta\\s.*?\\bhttp-equiv\\s*=\\s*["'']?\\s*refresh\\s*(?:["'']|\\s|/?>)')
                THEN regexp_extract(tag, '(?is)\\scontent\\s*=\\s*["'']\\s*[0-9.]+\\s*[;,]\\s*url\\s*=\\s*["'']?([^"'']*)', 1)
                END, '&amp;', '&')) AS link FROM tags
        ), resolved AS (
            SELECT split_part(base, '#', 1) AS src, split_part(CASE
                WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
                WHEN starts_with(link, '//') THEN regexp_extract(base, '^(.*?)://', 1) || ':' || link
                WHEN starts_with(link, '/') THEN regexp_extract(base, '^(.*?://[^/?#]*)', 1) || link
                WHEN starts_with(link, '?') THEN regexp_extract(base, '^([^?#]*)', 1) || link
                ELSE regexp_extract(base, '^(.*?://[^/?#]*)', 1)
                     || coalesce(nullif(regexp_extract(base, '^.*?://[^/?#]*([^?#]*/)', 1), ''), '/') || link
                END, '#', 1) AS dst
            FROM said WHERE link <> ''
        ), edges AS (SELECT src AS a, dst AS b FROM resolved UNION SELECT dst, src FROM resolved),
        reach AS (
            SELECT a, a AS b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a
        ), ruled AS (
            SELECT url AS node, {_RULED} AS rule FROM (SELECT url, {_HOST} AS host, {_PATH} AS path FROM (SELECT DISTINCT a AS url FROM edges))
        ), caught AS (
            SELECT DISTINCT reach.a AS node FROM reach JOIN ruled ON reach.b = ruled.node WHERE ends_with(rule, ' block')
        ), judged AS (
            SELECT page_id, host, path, {_RULED} AS own, node FROM (
                SELECT page_id, coalesce({_HOST}, '') AS host, coalesce({_PATH}, '') AS path,
                       CASE WHEN contains(url, '://') THEN split_part(url, '#', 1) END AS node FROM pages)
        )
        SELECT page_id, host, path, split_part(own, ' ', 1) AS rule,
               coalesce(split_part(own, ' ', 2), CASE WHEN caught.node IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
        FROM judged LEFT JOIN caught USING (node)""",
}
