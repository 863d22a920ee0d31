"""Registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import (
    conversations,
    decontam,
    fingerprints,
    manifest,
    mixing,
    packing,
    pii,
    quality,
    scoring,
    simhash,
    substrings,
    urls,
    warc,
)
from ordermill.llm.common import remainder, stored

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixing.words_taken(mixed).select("doc_id", "size", "source_size", "target", "taken")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    classifier = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs.select("doc_id", "text"), classifier).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        F.col("quality_predicted").alias("predicted"),
    )


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(_table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remainder(F.col("doc_id"), 7) == 2
    model = scoring.fit(docs.filter(~out))
    return scoring.score(docs, model).select(
        "doc_id",
        out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontam.judge(decontam.find_contamination(docs, benchmark)).drop("spans")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = warc.plan_records(_table(spark, sf_dir, "pages"))
    archives = stored(warc.write_archives(planned), "warc-archives")
    return warc.read_archives(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", digits, "component_id")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = urls.rules_table(spark, urls.RULES)
    return urls.judge_urls(_table(spark, sf_dir, "pages"), rules)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.report(_table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), path)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    build.__name__: build
    for build in (
        op1_mix_sources,
        op2_quality_classifier,
        op3_document_fingerprints,
        op4_lm_scoring,
        op5_substring_dedup,
        op6_benchmark_decontamination,
        op7_warc,
        op8_pii,
        op9_simhash_near_dedup,
        op10_url_filters,
        op11_merkle_manifest,
        op12_packing,
        op13_conversation_repair,
    )
}

ORACLE = {
    "op1_mix_sources": r"""
        WITH sized AS (
            SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
                   CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
            FROM documents
        ), per AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   row_number() OVER (ORDER BY source NULLS LAST) AS src
            FROM sized GROUP BY source
        ), limits AS (
            SELECT *, (src - 1) % 3 + 1 AS weight, 3 * source_size AS most,
                   CAST(sum(source_size) OVER () AS BIGINT) AS total
            FROM per
        ), levels AS (
            SELECT *, CAST(total - coalesce(sum(most) OVER (ORDER BY most / weight, src
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
                      / CAST(sum(weight) OVER (ORDER BY most / weight, src
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS here
            FROM limits
        ), targets AS (
            SELECT source, source_size, least(CAST(most AS DOUBLE), weight * max(here) OVER ()) AS target FROM levels
        ), placed AS (
            SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS take,
                   CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
                                          ROWS UNBOUNDED PRECEDING) AS BIGINT) - s.size AS start
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size, source_size, target,
               CAST(greatest(0, least(start + size, take) - start)
                    + greatest(0, least(source_size + start + size, take) - (source_size + start))
                    + greatest(0, least(2 * source_size + start + size, take) - (2 * source_size + start))
                    AS BIGINT) AS taken
        FROM placed""",
    "op7_warc": r"""
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), f AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first < page_id THEN first END AS refers_to
        FROM f""",
    "op10_url_filters": r"""
        WITH r AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), p AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM (SELECT page_id, coalesce(rest, '') AS rest FROM r) x
        ), judged AS (
            SELECT page_id, host, path,
                   CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/')
                        THEN 'example.net/en/'
                        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/')
                        THEN 'example.com/de/'
                        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
            FROM p
        )
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
        FROM judged""",
    "op11_merkle_manifest": r"""
        WITH RECURSIVE fields AS (
            SELECT *, [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text] AS v,
                   list_reduce([4294967295] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                       lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
                       lambda s, b: CASE WHEN b >= 0 THEN xor(s, b) WHEN s % 2 = 1 THEN xor(s >> 1, 3988292384)
                                      ELSE s >> 1 END) AS crc
            FROM documents
        ), leaves AS (
            SELECT doc_id, lang, sha256(array_to_string(list_transform(v, lambda x: coalesce(
                       octet_length(encode(x)) || ':' || x, '-')), '')) AS leaf,
                   CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN sha256(array_to_string(list_transform(
                       [v[1], v[2], v[3], CAST(n_chars + 1 AS VARCHAR), v[5]],
                       lambda x: coalesce(octet_length(encode(x)) || ':' || x, '-')), '')) END AS altered,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place
            FROM fields
        ), levels(lang, height, nodes) AS (
            SELECT lang, 0, list(leaf ORDER BY place) FROM leaves GROUP BY lang
            UNION ALL
            SELECT lang, height + 1, list_transform(range((len(nodes) + 1) // 2),
                   lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
            FROM levels WHERE len(nodes) > 1
        ), subroots AS (
            SELECT lang, height AS top, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
            FROM levels WHERE len(nodes) = 1
        ), tops(height, nodes) AS (
            SELECT 0, list(subroot ORDER BY tree) FROM subroots
            UNION ALL
            SELECT height + 1, list_transform(range((len(nodes) + 1) // 2),
                   lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
            FROM tops WHERE len(nodes) > 1
        ), places AS (
            SELECT l.doc_id, v.height, l.place >> v.height AS i, v.nodes
            FROM leaves l JOIN levels v ON l.lang IS NOT DISTINCT FROM v.lang WHERE len(v.nodes) > 1
            UNION ALL
            SELECT l.doc_id, 1000 + t.height, s.tree >> t.height, t.nodes
            FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang, tops t WHERE len(t.nodes) > 1
        ), steps AS (
            SELECT doc_id, height, CASE WHEN i % 2 = 1 THEN 'L' ELSE 'R' END AS side,
                   coalesce(nodes[CASE WHEN i % 2 = 1 THEN i ELSE i + 2 END], '') AS beside
            FROM places
        ), paths AS (
            SELECT doc_id, list(side || beside ORDER BY height) AS path,
                   string_agg(beside, '' ORDER BY height) AS proof
            FROM steps GROUP BY doc_id
        )
        SELECT *, folded_root = root AS verified FROM (
            SELECT l.doc_id, l.leaf, s.subroot, t.nodes[1] AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
                   list_reduce([coalesce(l.altered, l.leaf)] || coalesce(p.path, []), lambda a, b:
                       sha256(CASE WHEN b[1] = 'L' THEN b[2:] || a ELSE a || b[2:] END)) AS folded_root
            FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
            LEFT JOIN paths p USING (doc_id), tops t
            WHERE len(t.nodes) = 1
        ) x""",
}
