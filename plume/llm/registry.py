"""Queries of this subpackage, by name: ``(spark, sf_dir) -> DataFrame``, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from plume.llm import (decontam, hardneg, lexical, license, linededup, packing, quality, simhash, suffixlm,
                       tokencount, topk, urlfilter, warc)
from plume.llm.common import table


def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "status")


def op3_topk(spark, sf_dir):
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


#: verdict, host, path
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op4_urlfilter(spark, sf_dir):
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op5_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_license(spark, sf_dir):
    return license.scan(table(spark, sf_dir, "documents"))


def op7_tokencount(spark, sf_dir):
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


def op8_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_linededup(spark, sf_dir):
    return linededup.duplicate_lines(table(spark, sf_dir, "documents"))


def op10_decontam(spark, sf_dir):
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=decontam.EXCERPT)


def op11_lexical(spark, sf_dir):
    return lexical.search(lexical.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op12_suffixlm(spark, sf_dir):
    return suffixlm.score(table(spark, sf_dir, "documents"))


def op13_hardneg(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.expr(
        "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))
    vectors = hardneg.quantised(rows)
    return hardneg.mine(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def queries() -> dict:
    return {f.__name__: f for f in (op1_simhash, op2_warc, op3_topk, op4_urlfilter, op5_packing, op6_license,
                                    op7_tokencount, op8_quality, op9_linededup, op10_decontam, op11_lexical, op12_suffixlm,
                                    op13_hardneg)}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": _WARC_SQL, "op3_topk": _TOPK_SQL, "op4_urlfilter": _URL_SQL, "op11_lexical": _LEXICAL_SQL,
            "op13_hardneg": _HARD_SQL}


_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
     k AS (SELECT h, max(page_id) AS kept FROM p GROUP BY h)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda s:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  (((('0x' || substr(p.h, (g * 5 + 1)::BIGINT, 5))::BIGINT >> s::INTEGER) & 31) + 1)::BIGINT, 1)), '')), '')
           AS payload_digest,
       CASE WHEN page_id = kept OR kept IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = kept THEN NULL ELSE kept END AS refers_to, 'ok' AS status
FROM p JOIN k USING (h)
"""

_TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id,
                  list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

_URL_SQL = """
WITH u AS (SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS mark FROM pages),
     r AS (SELECT page_id, CASE WHEN mark = 0 THEN '' ELSE substr(url, mark + 3) END AS rest FROM u),
     s AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
     p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM s),
     rules(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
         ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
     m AS (SELECT p.page_id, p.host, p.path, rhost || rpath AS rule, verdict,
                  row_number() OVER (PARTITION BY p.page_id, p.host, p.path ORDER BY length(rhost || rpath) DESC NULLS LAST) AS n
           FROM p LEFT JOIN rules ON (p.host = rhost OR suffix(p.host, '.' || rhost)) AND starts_with(p.path, rpath))
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p JOIN m ON m.n = 1 AND m.page_id IS NOT DISTINCT FROM p.page_id AND m.host = p.host AND m.path = p.path
"""

_LEXICAL_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
     n AS (SELECT rid, doc_id, len(t) AS n FROM d WHERE len(t) > 0),
     corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS tokens FROM n),
     tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(t) AS term FROM d) GROUP BY rid, term),
     w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
           FROM tf, corpus GROUP BY term, docs),
     q AS (SELECT row_number() OVER () AS qid, * FROM (SELECT DISTINCT item_id, text FROM benchmark)),
     qt AS (SELECT qid, item_id, term, count(*) AS times FROM (
                SELECT qid, item_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM q) GROUP BY qid, item_id, term),
     s AS (SELECT qid, item_id, rid, doc_id, sum(times * w * ((1000000000 * tf) //
                      (1000 * tf + 12 * (75 + (25 * n * docs) // tokens))))::BIGINT AS score
           FROM qt JOIN w USING (term) JOIN tf USING (term) JOIN n USING (rid), corpus GROUP BY qid, item_id, rid, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST) <= 20
"""

_HARD_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                  list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
           FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
     p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id, positive_score,
       s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score
     AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3
"""
