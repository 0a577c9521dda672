"""The thirteen queries, each beside the SQL that checks it (None where SQL cannot express it)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rillwork.llm import (embedding_dedup, fingerprints, id_files, langid, merkle, mixing, near_dedup, packing, pii, secret_scan, token_counts,
                          vector_codes, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op10_minmax_near_dedup", r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
items AS (SELECT doc_id, unnest(s) AS e FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.e = b.e AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
    WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, label) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT b, label FROM reached JOIN both_ways ON doc_id = a),
labels AS (SELECT doc_id, min(label) AS component_id FROM reached GROUP BY 1)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN labels USING (doc_id)""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@query("op9_minhash_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op5_pareto_mixing", r"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS BIGINT) AS size,
        (CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0 AS u
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
    FROM sized GROUP BY source),
ordered AS (
    SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS spare, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS weights
    FROM sources
    WINDOW before AS (ORDER BY CAST(source_size AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
open AS (SELECT spare, weights FROM ordered WHERE CAST(spare AS DOUBLE) * w / CAST(weights AS DOUBLE) <= 3 * source_size ORDER BY weights DESC LIMIT 1),
goals AS (
    SELECT source, source_size, coalesce(least(CAST((SELECT spare FROM open) AS DOUBLE) * w / CAST((SELECT weights FROM open) AS DOUBLE), CAST(3 * source_size AS DOUBLE)),
        CAST(3 * source_size AS DOUBLE)) AS target FROM sources),
copied AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM goals),
budgets AS (SELECT *, CAST(floor(target - copies * source_size + 0.5) AS BIGINT) AS budget FROM copied),
histogram AS (
    SELECT source, size, count(*) AS n, CAST(floor(sqrt(CAST(size AS DOUBLE)) * 1000) AS BIGINT) AS x FROM sized WHERE size > 0 GROUP BY source, size),
steps AS (
    SELECT h.source, size, x, sum(CAST(n AS HUGEINT) * size * x) OVER (PARTITION BY h.source ORDER BY size ROWS UNBOUNDED PRECEDING) AS rest,
        budget - coalesce(sum(n * size) OVER (PARTITION BY h.source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spare
    FROM histogram h JOIN budgets b ON h.source IS NOT DISTINCT FROM b.source),
chances AS (
    SELECT source, max(CASE WHEN spare * x < rest THEN CAST(spare AS DOUBLE) / CAST(rest AS DOUBLE) END) AS c,
        min(CASE WHEN spare * x >= rest THEN size END) AS certain_from
    FROM steps GROUP BY source),
odds AS (
    SELECT s.*, coalesce(size >= certain_from, false) AS certain, c * CAST(floor(sqrt(CAST(size AS DOUBLE)) * 1000) AS BIGINT) AS chance
    FROM sized s LEFT JOIN chances c ON s.source IS NOT DISTINCT FROM c.source),
ranked AS (
    SELECT *, CASE WHEN size = 0 THEN 2 WHEN certain THEN 0 ELSE 1 END AS turn,
        CASE WHEN size > 0 AND NOT certain THEN (u / (1 - u)) / (CASE WHEN chance > 0 THEN chance / (1 - chance) ELSE 1.0 END) END AS rank
    FROM odds)
SELECT doc_id, size, source_size, target,
    CAST(copies * size + greatest(0, least(size, budget - coalesce(sum(size) OVER (
        PARTITION BY r.source ORDER BY turn, rank NULLS LAST, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS taken
FROM ranked r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).drop("source")


@query("op8_pca_tiled_links", r"""
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
both_ways AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.95),
reached(vec_id, label) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT b, label FROM reached JOIN both_ways ON vec_id = a),
labels AS (SELECT vec_id, min(label) AS component_id FROM reached GROUP BY 1),
counts AS (SELECT a AS vec_id, count(*) AS n FROM both_ways GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM labels LEFT JOIN counts USING (vec_id)""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.linked_vectors(table(spark, sf_dir, "embeddings"), 0.95)


@query("op3_compression_langid")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


@query("op1_seekable_warc", r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (SELECT html, min(page_id) AS first FROM p GROUP BY html),
bits AS (SELECT html, CAST(CAST(unhex(sha1(html)) AS BIT) AS VARCHAR) AS b FROM firsts),
digests AS (
    SELECT html, array_to_string(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5), lambda k:
            CAST(substr(b, CAST(5 * i + k + 1 AS BIGINT), 1) AS INTEGER) * [16, 8, 4, 2, 1][k + 1]))::BIGINT, 1)), '') AS payload_digest
    FROM bits)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN firsts USING (html) JOIN digests USING (html)""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write(table(spark, sf_dir, "pages"), warc.new_folder(spark), revisit_from=0)
    return warc.read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_cutting_stock_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


@query("op7_trie_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op6_bootstrapped_pii")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(table(spark, sf_dir, "documents"))


@query("op4_randomness_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.found(table(spark, sf_dir, "documents"))


@query("op11_path_copying_manifest", r"""
WITH RECURSIVE table_of_crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
rows_of AS (
    SELECT doc_id, source, text,
        CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
            || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
            || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
            || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS head,
        xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
            lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) AS crc
    FROM documents, table_of_crc),
texts AS (
    SELECT *, CASE WHEN crc % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS after FROM rows_of),
leaves AS (
    SELECT doc_id, source, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
        sha256(head || CASE WHEN after IS NULL THEN '-' ELSE strlen(after) || ':' || after END) AS changed FROM texts),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM leaves),
up(source, level, idx, node, n) AS (
    SELECT source, 0, idx, leaf, n FROM placed
    UNION ALL
    SELECT source, level + 1, idx // 16, sha256(string_agg(node, '' ORDER BY idx)), (any_value(n) + 15) // 16 FROM up WHERE n > 1 GROUP BY source, level, idx // 16),
runs AS (SELECT source, level, idx // 16 AS run, list(node ORDER BY idx) AS nodes FROM up WHERE n > 1 GROUP BY ALL),
tops AS (SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM up WHERE n = 1),
above(level, idx, node, n) AS (
    SELECT 0, place, subroot, n FROM tops
    UNION ALL
    SELECT level + 1, idx // 16, sha256(string_agg(node, '' ORDER BY idx)), (any_value(n) + 15) // 16 FROM above WHERE n > 1 GROUP BY level, idx // 16),
upper_runs AS (SELECT level, idx // 16 AS run, list(node ORDER BY idx) AS nodes FROM above WHERE n > 1 GROUP BY ALL),
climb(doc_id, leaf, source, level, idx, node, proof) AS (
    SELECT doc_id, leaf, source, 0, idx, changed, '' FROM placed
    UNION ALL
    SELECT c.doc_id, c.leaf, c.source, c.level + 1, c.idx // 16,
        sha256(array_to_string(nodes[:c.idx % 16], '') || c.node || array_to_string(nodes[c.idx % 16 + 2:], '')),
        c.proof || array_to_string(nodes[:c.idx % 16], '') || array_to_string(nodes[c.idx % 16 + 2:], '')
    FROM climb c JOIN runs r ON r.source IS NOT DISTINCT FROM c.source AND r.level = c.level AND r.run = c.idx // 16),
at_tops AS (SELECT DISTINCT ON (doc_id, leaf) * FROM climb ORDER BY level DESC),
climb_on(doc_id, leaf, subroot, level, idx, node, proof) AS (
    SELECT doc_id, leaf, subroot, 0, place, node, proof FROM at_tops c JOIN tops t ON t.source IS NOT DISTINCT FROM c.source
    UNION ALL
    SELECT c.doc_id, c.leaf, c.subroot, c.level + 1, c.idx // 16,
        sha256(array_to_string(nodes[:c.idx % 16], '') || c.node || array_to_string(nodes[c.idx % 16 + 2:], '')),
        c.proof || array_to_string(nodes[:c.idx % 16], '') || array_to_string(nodes[c.idx % 16 + 2:], '')
    FROM climb_on c JOIN upper_runs r ON r.level = c.level AND r.run = c.idx // 16),
ends AS (SELECT DISTINCT ON (doc_id, leaf) * FROM climb_on ORDER BY level DESC),
root_of AS (SELECT node AS root FROM above WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified FROM ends, root_of""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered(table(spark, sf_dir, "documents")).versions().select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def lloyd_sql() -> str:
    """Four rounds of plain Lloyd, every part against all entries."""
    squared = "CAST(list_dot_product(v.x, v.x) - 2 * list_dot_product(v.x, b.x) + list_dot_product(b.x, b.x) AS BIGINT)"
    steps = []
    for k in range(5):
        steps.append(f"""
near{k} AS (SELECT v.rn, v.p, min({squared} * 256 + b.e) AS best FROM parts v JOIN book{k} b ON v.p = b.p GROUP BY v.rn, v.p)""")
        if k < 4:
            steps.append(f"""
used{k} AS (SELECT p, e, list(CAST(floor(s / n) AS DOUBLE) ORDER BY i) AS x FROM (
    SELECT v.p, best % 256 AS e, i, sum(v.x[i]) AS s, count(*) AS n FROM near{k} JOIN parts v USING (rn, p), unnest(range(1, 1 + len(v.x))) r(i) GROUP BY ALL) GROUP BY p, e),
book{k + 1} AS (SELECT p, e, coalesce(u.x, b.x) AS x FROM book{k} b LEFT JOIN used{k} u USING (p, e))""")
    return f"""
WITH usable AS (SELECT vec_id, label, embedding FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
whole AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS rn, vec_id, label,
    list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS DOUBLE)) AS x FROM usable),
parts AS (SELECT rn, vec_id, label, p, x[1 + p * len(x) // 4:(p + 1) * len(x) // 4] AS x FROM whole, unnest(range(4)) r(p)),
book0 AS (SELECT p, rn AS e, x FROM parts WHERE rn < 256),{",".join(steps)},
coded AS (
    SELECT vec_id, label, string_agg(lower(lpad(to_hex(best % 256), 2, '0')), '' ORDER BY p) AS code, CAST(sum(best // 256) AS BIGINT) AS error
    FROM near4 JOIN parts USING (rn, p) GROUP BY rn, vec_id, label),
books AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda c: CAST(CAST(c AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book4)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, books"""


@query("op12_active_lloyd_codes", lloyd_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


@query("op13_elias_fano_id_files")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = id_files.write(table(spark, sf_dir, "documents"), id_files.new_folder(spark), public_tokenizers.path("byte_bpe_50k.json"))
    return id_files.read(index)
