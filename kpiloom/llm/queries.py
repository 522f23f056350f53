"""The registered queries of the pipeline operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kpiloom.llm import (
    ann, bpe, classifier, cross_align, jaccard_join, mixing, periodic, quality_rules, simhash, substring_dedup,
    suffix_tree, url_filter, warc,
)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


# the contract's rules: host, path, verdict
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op7_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark, _read(spark, sf_dir, "embeddings"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, URL_RULES)) + " AS t(host, path, verdict)")
    return url_filter.url_filter(_read(spark, sf_dir, "pages"), rules)


def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.corpus_scores(_read(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removal_counts(_read(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_read(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(_read(spark, sf_dir, "documents"))


def op11_cross_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_align.align(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(_read(spark, sf_dir, "documents"), periodic.planted).drop("collapsed_words")


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components_of(_read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_suffix_tree": op1_suffix_tree,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_bpe": op3_bpe,
    "op4_simhash": op4_simhash,
    "op5_warc": op5_warc,
    "op6_mixing": op6_mixing,
    "op7_classifier": op7_classifier,
    "op8_url_filter": op8_url_filter,
    "op10_ann": op10_ann,
    "op9_quality_rules": op9_quality_rules,
    "op11_cross_align": op11_cross_align,
    "op12_periodic": op12_periodic,
    "op13_jaccard_join": op13_jaccard_join,
}

OP5_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
k AS (SELECT payload, max(page_id) AS keeper FROM p WHERE octet_length(payload) >= 1000 GROUP BY payload)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k USING (payload)
"""

OP8_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
           THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
r(rhost, rpath, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (
  SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
         max_by(verdict, length(rhost || rpath)) AS verdict
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m USING (page_id)
"""

OP6_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         ('0x' || substr(md5('order7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT % 4096 AS bucket,
         ('0x' || substr(md5('round7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT / 4294967296.0 AS u
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM d GROUP BY source),
o AS (
  SELECT *, sum(2.0 * source_size::DOUBLE) OVER f AS capped, sum(weight) OVER f AS used, sum(weight) OVER () AS weights,
         sum(source_size) OVER ()::DOUBLE * 1.5 AS total
  FROM s WINDOW f AS (ORDER BY 2.0 * source_size::DOUBLE / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (  -- the level if the sources up to this one in order of size for weight are full
  SELECT (total - capped + 2.0 * source_size::DOUBLE) / (weights - used + weight) AS level, weight, source_size FROM o),
g AS (
  SELECT source, source_size, weight,
         least(weight * (SELECT min_by(level, 2.0 * source_size / weight) FROM l WHERE weight * level <= 2.0 * source_size::DOUBLE),
               2.0 * source_size::DOUBLE) AS target
  FROM s),
r AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS ratio FROM g),
w AS (SELECT *, floor(ratio) AS whole, (ratio - floor(ratio)) * source_size AS want FROM r),
b AS (
  SELECT source, bucket, sum(size) AS n, sum(sum(size)) OVER (PARTITION BY source ORDER BY bucket) AS upto
  FROM d GROUP BY source, bucket),
c AS (
  SELECT b.source, min(bucket) AS cut, min_by((want - upto + n) / n, bucket) AS part
  FROM b JOIN w ON b.source IS NOT DISTINCT FROM w.source WHERE upto > want GROUP BY b.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(whole * size + floor(CASE WHEN bucket < coalesce(cut, 4096) THEN 1.0
                                      WHEN bucket = cut THEN part ELSE 0.0 END * size + u) AS BIGINT) AS taken
FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source LEFT JOIN c ON d.source IS NOT DISTINCT FROM c.source
"""

OP2_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
n AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM d, LATERAL (SELECT unnest(range(1, len(w) - 48)) AS i)),
f AS (SELECT s, min(doc_id) AS first FROM n GROUP BY s),
g AS (
  SELECT r, list(DISTINCT i + k) AS gone FROM n JOIN f USING (s), LATERAL (SELECT unnest(range(0, 50)) AS k)
  WHERE first < doc_id GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_transform(list_filter(list_zip(w, range(1, len(w) + 1)),
              lambda x: gone IS NULL OR NOT list_contains(gone, x[2])), lambda x: x[1]), ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (r)
"""

OP13_SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
l AS (
  SELECT a.r AS x, b.r AS y FROM s a JOIN s b USING (g) JOIN n p ON p.r = a.r JOIN n q ON q.r = b.r
  GROUP BY a.r, b.r, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
c AS (SELECT x, y FROM l UNION SELECT c.x, l.y FROM c JOIN l ON c.y = l.x),
m AS (SELECT c.x AS r, min(d.doc_id) AS component_id FROM c JOIN d ON d.r = c.y GROUP BY c.x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       CASE WHEN n.n IS NULL THEN d.doc_id ELSE m.component_id END AS component_id
FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)
"""

ORACLES: dict[str, str] = {
    "op2_substring_dedup": OP2_SQL,
    "op13_jaccard_join": OP13_SQL,
    "op5_warc": OP5_SQL,
    "op6_mixing": OP6_SQL,
    "op8_url_filter": OP8_SQL,
}
