"""Registered queries of the text operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm import (decontaminate, divergence, jaccard_join, langid, licenses, minhash, packing,
                        pu_quality, source_audit, substring_dedup, toxicity, warc, whitening)
from corvid.llm.common import table


def op1_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"),
                                        table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op2_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = pu_quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return pu_quality.score_quality(docs, model)


def op3_bbit_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_warc_boundary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_fm_index_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.quality_rules(table(spark, sf_dir, "documents"))


def op8_marginal_unigram_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit_languages(docs))


def op9_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_rank_one_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_adaptive_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op13_pointer_sort_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_winnowing_decontamination": op1_winnowing_decontamination,
    "op2_pu_quality": op2_pu_quality,
    "op3_bbit_minhash_dedup": op3_bbit_minhash_dedup,
    "op4_warc_boundary_chain": op4_warc_boundary_chain,
    "op5_license_scan": op5_license_scan,
    "op6_distribution_divergence": op6_distribution_divergence,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_marginal_unigram_langid": op8_marginal_unigram_langid,
    "op9_noisy_channel_toxicity": op9_noisy_channel_toxicity,
    "op10_fm_index_substring_dedup": op10_fm_index_substring_dedup,
    "op11_rank_one_whitening": op11_rank_one_whitening,
    "op12_adaptive_prefix_join": op12_adaptive_prefix_join,
    "op13_pointer_sort_audit": op13_pointer_sort_audit,
}

OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
  SELECT DISTINCT item, least(13, len(w)) AS n,
         array_to_string(w[s : s + least(13, len(w)) - 1], ' ') AS win
  FROM b, unnest(range(1, greatest(len(w) - 11, 2))) AS t(s) WHERE len(w) > 0),
ns AS (SELECT DISTINCT n FROM bw),
hits AS (
  SELECT d.rid, t.s, ns.n, bw.item
  FROM d CROSS JOIN ns, unnest(range(1, len(d.w) - ns.n + 2)) AS t(s)
  JOIN bw ON bw.n = ns.n AND bw.win = array_to_string(d.w[t.s : t.s + ns.n - 1], ' ')),
places AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT rid, s, n FROM hits), unnest(range(s, s + n)) AS u(p) GROUP BY rid),
its AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (rid) LEFT JOIN its USING (rid)
"""

# words are the runs of anything but space and \t..\r
_LINKED_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[t.i : t.i + 4], ' ') AS g
  FROM w, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= {least} * (x.n + y.n - shared)),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(doc_id, coalesce(low.b, doc_id)) AS component_id{more}
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = doc_id
"""
OP3_SQL = _LINKED_SQL.replace("{least}", "85").replace(
    "{more}", ", doc_id = least(doc_id, coalesce(low.b, doc_id)) AS kept")
OP12_SQL = _LINKED_SQL.replace("{least}", "80").replace("{more}", "")

OP4_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
m AS (SELECT d, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM p LEFT JOIN m USING (d)
"""

OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
win AS (
  SELECT doc_id, t.s AS s, hash(array_to_string(w[t.s : t.s + 49], ' ')) AS h,
         md5(array_to_string(w[t.s : t.s + 49], ' ')) AS m
  FROM d, unnest(range(1, greatest(len(w) - 48, 1))) AS t(s)),
low AS (SELECT h, m, min(doc_id) AS first FROM win GROUP BY h, m),
gone AS (
  SELECT DISTINCT doc_id, p FROM win JOIN low USING (h, m), unnest(range(s, s + 50)) AS u(p)
  WHERE first < doc_id),
places AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, w, coalesce(len(ps), 0) AS n_removed,
         CASE WHEN ps IS NULL THEN w ELSE
           list_filter(w, lambda x, i: NOT list_contains(ps, i)) END AS k
  FROM d LEFT JOIN places USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256
FROM kept
"""

OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT rid) AS docs
      FROM t GROUP BY lang, source, term),
k AS (SELECT lang, term, sum(n) AS total FROM c GROUP BY lang, term HAVING sum(docs) >= 3),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
g AS (
  SELECT d.lang, d.source, coalesce(max(v.v), 0) AS v, coalesce(max(v.n), 0) AS nl
  FROM d LEFT JOIN v ON v.lang = d.lang GROUP BY d.lang, d.source),
s AS (SELECT c.lang, c.source, sum(c.n) AS n FROM c JOIN k USING (lang, term)
      GROUP BY c.lang, c.source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // (coalesce(s.n, 0) + g.v) AS p,
         1 + CAST(1000000000 AS HUGEINT) * (k.total + 1) // (g.nl + g.v) AS q
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""

ORACLES: dict[str, str] = {
    "op1_winnowing_decontamination": OP1_SQL,
    "op3_bbit_minhash_dedup": OP3_SQL,
    "op4_warc_boundary_chain": OP4_SQL,
    "op10_fm_index_substring_dedup": OP10_SQL,
    "op12_adaptive_prefix_join": OP12_SQL,
    "op13_pointer_sort_audit": OP13_SQL,
}
