"""The registered queries of these operators, and SQL for those that it can express."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from paralane.llm import bpe, divergence, exact, jaccard, licenses, packing, quality, sharding, simhash, substring, topk, vector_codes, warc


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_minimax_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(_table(spark, folder, "documents"), shards=40)


def op2_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip_digests(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_maxscore_top10(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(_table(spark, folder, "embeddings"), k=10)


def op4_warc_captures(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived_pages(_table(spark, folder, "pages"))


def op5_packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op7_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, folder, "documents"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.substring_digests(_table(spark, folder, "documents"))


def op9_exact_groups(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_groups(_table(spark, folder, "documents"))


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, folder, "documents"))


def op11_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit_sources(_table(spark, folder, "documents"))


def op12_jaccard_groups(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_groups(_table(spark, folder, "documents"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.vector_codes(_table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_minimax_shards, op2_bpe_round_trip, op3_maxscore_top10, op4_warc_captures, op5_packed_sequences,
        op6_quality_scores, op7_simhash_groups, op8_substring_dedup, op9_exact_groups, op10_license_scan,
        op11_source_audit, op12_jaccard_groups, op13_vector_codes,
    )
}

#: Integer inner products of all vectors with the queries; ranks by score, then id.
_TOP = r"""
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda x: coalesce(x[1], 0) * coalesce(x[2], 0))) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

#: Equal without white space; the longest stays, then the smallest id.
_EXACT = r"""
WITH plain AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
    FROM documents
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS place,
           first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY body) AS group_size
    FROM plain
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM ranked
"""

#: Terms in ten documents of their language; gaps of smoothed shares, by source.
_AUDIT = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), words AS (
    SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
    SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), sizes AS (
    SELECT lang, count(*) AS v FROM kept GROUP BY lang
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), totals AS (
    SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source
), groups AS (
    SELECT lang, source, coalesce(v, 0) AS v, coalesce(total, 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN sizes USING (lang) LEFT JOIN totals USING (lang, source)
), of_lang AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 2)) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * any_value(v)) AS q
    FROM counts JOIN sizes USING (lang) GROUP BY lang, term
), grid AS (
    SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (g.total + 2 * g.v) AS p
    FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
    FROM grid JOIN of_lang USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""

#: Sets of three-word shingles, links between different sets, and what links lead to.
_JACCARD = r"""
WITH RECURSIVE words AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT r, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' ')) END)) AS s
    FROM words
), nodes AS (
    SELECT s, min(r) AS node FROM sets WHERE len(s) > 0 GROUP BY s
), tokens AS (
    SELECT node, len(s) AS n, hash(t) AS t FROM (SELECT node, s, unnest(s) AS t FROM nodes)
), meets AS (
    SELECT a.node AS a, b.node AS b, count(*) AS overlap, any_value(a.n) AS na, any_value(b.n) AS nb
    FROM tokens a JOIN tokens b ON a.t = b.t AND a.node <> b.node GROUP BY a.node, b.node
), links AS (
    SELECT a, b FROM meets WHERE 100 * overlap >= 90 * (na + nb - overlap)
), reached(node, other) AS (
    SELECT node, node FROM nodes UNION SELECT reached.node, links.b FROM reached JOIN links ON links.a = reached.other
), ids AS (
    SELECT node, s, doc_id FROM nodes JOIN sets USING (s)
), named AS (
    SELECT reached.node, min(doc_id) AS component_id FROM reached JOIN ids ON ids.node = reached.other GROUP BY reached.node
)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, CASE WHEN len(sets.s) = 0 THEN sets.doc_id ELSE component_id END AS component_id
FROM sets LEFT JOIN nodes ON nodes.s = sets.s LEFT JOIN named USING (node)
"""

_MOVE = """
), near{n} AS (
    SELECT r, part, arg_min(entry, (list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), entry)) AS entry
    FROM points JOIN book{n} USING (part) GROUP BY r, part
), mean{m} AS (
    SELECT part, entry, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS c
    FROM (SELECT part, entry, i, sum(x[i])::DOUBLE AS s, count(*) AS n
          FROM points JOIN near{n} USING (r, part), range(1, 17) t(i) GROUP BY part, entry, i)
    GROUP BY part, entry
), book{m} AS (
    SELECT part, entry, coalesce(mean{m}.c, book{n}.c) AS c FROM book{n} LEFT JOIN mean{m} USING (part, entry)"""

#: Codebooks of 256 entries a part, moved four times; for vectors of 64 components.
_CODES = r"""
WITH usable AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), points AS MATERIALIZED (
    SELECT r, part, v[16 * part + 1 : 16 * part + 16] AS x FROM usable, range(4) t(part)
), book0 AS (
    SELECT part, r - 1 AS entry, x AS c FROM points WHERE r <= 256""" + "".join(_MOVE.format(n=n, m=n + 1) for n in range(4)) + r"""
), nearest AS (
    SELECT r, part, min((list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), entry)) AS best
    FROM points JOIN book4 USING (part) GROUP BY r, part
), coded AS (
    SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM nearest GROUP BY r
), books AS (
    SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book4
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM usable JOIN coded USING (r), books
"""

ORACLES: dict[str, str] = {"op13_vector_codes": _CODES, "op12_jaccard_groups": _JACCARD, "op11_source_audit": _AUDIT, "op3_maxscore_top10": _TOP, "op9_exact_groups": _EXACT}
