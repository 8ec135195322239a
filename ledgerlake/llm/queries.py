"""The operators applied to their whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import (
    byte_bpe,
    decontamination,
    fingerprints,
    hard_negatives,
    html_paths,
    packing,
    quality,
    repair,
    simhash_mih,
    spelling,
    substrings,
    url_filter,
    warc,
)
from ledgerlake.llm.common import prepare, table


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files of this machine are."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_consensus_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return html_paths.extract(table(spark, sf_dir, "pages"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash_mih.near_duplicates(table(spark, sf_dir, "documents"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return fingerprints.count_near(fingerprints.compare_with_next(table(spark, sf_dir, "documents")))


def op4_url_wildcard_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op5_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return warc.archive(table(spark, sf_dir, "pages"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontamination.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short=True)


def op8_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return repair.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op10_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_byte_bpe_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    prepare(spark)
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_spelling_gram_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spelling.spelling_forms(table(spark, sf_dir, "documents"))


def op13_threshold_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_html_consensus_paths, op2_simhash_near_dedup, op3_document_fingerprints, op4_url_wildcard_filter, op5_hierarchical_packing,
        op6_warc_bundles, op7_benchmark_decontamination, op8_repair_token_files, op9_substring_dedup, op10_quality_neighbours, op11_byte_bpe_matrices,
        op12_spelling_gram_blocks, op13_threshold_hard_negatives)
}

ORACLE_SQL: dict[str, str] = {
    "op4_url_wildcard_filter": r"""
WITH u AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages),
r AS (
    SELECT *, CASE
        WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
    FROM u)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN starts_with(path, '/') AND (starts_with(host, 'spam-') OR contains(host, '.spam-') OR contains(host, 'casino')
                                     OR contains(host, 'cheap-pills')) THEN 'block'
    ELSE 'allow' END AS verdict
FROM r""",
    "op6_warc_bundles": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
m AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY d) END AS last FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN last > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last > page_id THEN last END AS refers_to
FROM m""",
    "op9_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d),
g AS (
    SELECT doc_id, p, w, string_agg(w, ' ') OVER f AS s, count(*) OVER f AS n FROM t
    WINDOW f AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
e AS (SELECT *, n = 20 AND row_number() OVER (PARTITION BY s, n ORDER BY doc_id, p) > 1 AS again FROM g),
c AS (SELECT doc_id, p, w, bool_or(again) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM e),
k AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, string_agg(w, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept
    FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""",
    "op12_spelling_gram_blocks": r"""
WITH RECURSIVE t AS (
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS crc
    FROM range(256) r(i)),
d AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
r AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM d WHERE length(run) >= 6 GROUP BY ALL),
b AS (SELECT *, hex(encode(concat(doc_id, ':', run))) AS bytes FROM r),
h AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_transform(range(length(bytes) // 2), lambda i: CAST('0x' || substr(bytes, 2 * i + 1, 2) AS BIGINT)),
        lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]), 4294967295)) AS h
    FROM b, t),
w AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
x AS (SELECT word, unnest(range(length(word))) AS i FROM w),
cut AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM x),
e AS (
    SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT word, rest FROM cut WHERE rest IN (SELECT word FROM w)
    UNION SELECT rest, word FROM cut WHERE rest IN (SELECT word FROM w)),
m AS (
    SELECT e.word, count(*) AS n_near, arg_min(struct_pack(near := v.word, n := v.n), struct_pack(less := -v.n, near := encode(v.word))) AS best
    FROM e JOIN w v ON v.word = e.near GROUP BY e.word),
f AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 5 * w.n THEN best.near END AS form,
           CASE WHEN best.n >= 5 * w.n THEN best.n END AS form_n
    FROM w LEFT JOIN m USING (word)),
c AS (
    SELECT word, word AS root, 0 AS steps FROM f
    UNION ALL SELECT c.word, f.form, steps + 1 FROM c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n
FROM f JOIN (SELECT word, arg_max(root, steps) AS root FROM c GROUP BY word) USING (word)""",
    "op13_threshold_hard_negatives": """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 10""",
}
