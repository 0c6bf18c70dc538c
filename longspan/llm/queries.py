"""The dealt operators as queries over the given tables, with their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from longspan.llm import bpe, collocations, decontaminate, langid, licenses, lineruns, negatives, pagediff, passages, quality, simhash, topk, warc
from longspan.llm.register import ORACLES, QUERIES, query, table

#: Vocabulary file of the encoding operator.
TOKENIZER = "word_bpe_49k.json"
_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"



def _vectors(scale: int, more: str = "", where: str = "true") -> str:
    """Rows of ``embeddings`` that take part, their components scaled and floored to whole numbers."""
    return f"""v AS (SELECT row_number() OVER () AS r, vec_id{more}, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND {where})"""


_PRODUCT = "CAST(coalesce(list_sum(list_transform(range(1, least(len(q.e), len(c.e)) + 1), lambda i: q.e[i] * c.e[i])), 0) AS BIGINT)"


@query("op5_benchmark_decontamination", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT row_number() OVER () AS r, item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
place AS (SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT r, item_id, win.n, p FROM place JOIN win ON place.n = win.n AND place.s = win.s),
word AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hit) GROUP BY r),
item AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
  FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN word USING (r) LEFT JOIN item USING (r)""")
def benchmark_decontamination(spark, sf):
    return decontaminate.digest(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op2_language_id")
def language_id(spark, sf):
    return langid.digest(table(spark, sf, "documents"))


@query("op3_bpe")
def byte_pair_encoding(spark, sf):
    return bpe.digest(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))


@query("op1_license_scan")
def license_scan(spark, sf):
    return licenses.digest(table(spark, sf, "documents"))


@query("op4_html_extraction")
def html_extraction(spark, sf):
    return pagediff.extract(table(spark, sf, "pages"))


@query("op6_warc", """
WITH p AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS h, sha256(coalesce(html, '')) AS d FROM pages),
first AS (SELECT d, min(page_id) AS f FROM p WHERE strlen(h) >= 100 GROUP BY d)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, p.d AS payload_digest,
  CASE WHEN first.d IS NULL OR page_id IS NOT DISTINCT FROM f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first.d IS NULL OR page_id IS NOT DISTINCT FROM f THEN NULL ELSE f END AS refers_to
FROM p LEFT JOIN first ON p.d = first.d""")
def web_archive(spark, sf):
    return warc.digest(table(spark, sf, "pages"))


@query("op8_substring_dedup")
def substring_dedup(spark, sf):
    return passages.repeated_passages(table(spark, sf, "documents"))


@query("op9_line_dedup")
def line_dedup(spark, sf):
    return lineruns.repeated_runs(table(spark, sf, "documents"))


@query("op7_quality_rules")
def quality_rules(spark, sf):
    return quality.digest(table(spark, sf, "documents"))


@query("op10_simhash_near_dedup")
def simhash_near_dedup(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query("op11_hard_negatives", f"""
WITH {_vectors(256, ", CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label", "label IS NOT NULL")},
s AS (SELECT q.r, q.vec_id AS anchor_id, c.r AS c, c.vec_id, c.label = q.label AS same, {_PRODUCT} AS score
  FROM v AS q, v AS c WHERE q.vec_id % 50 = 0 AND q.r <> c.r),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, c) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.r, p.c ORDER BY s.score DESC, s.vec_id NULLS LAST, s.c) AS rank
  FROM p JOIN s ON p.r = s.r WHERE NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""")
def hard_negatives(spark, sf):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf, "embeddings"), label=label)


@query("op12_phrase_collocations", f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, {_FOLD} AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w, row_number() OVER () AS piece
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d)),
f AS (SELECT lang, s, m, count(*) AS f FROM (SELECT lang, m, array_to_string(w[k:k + m - 1], ' ') AS s
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM p, (SELECT unnest(range(1, 5)) AS m) WHERE len(w) >= m))
  GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
c AS (SELECT lang, s, m, f AS a, string_split(s, ' ') AS w FROM f WHERE m > 1),
cut AS (SELECT c.lang, c.s, c.a, k, l.f AS l, r.f AS r, CAST((CAST(2000000 AS HUGEINT) * c.a) // (l.f + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c) AS c
  JOIN f AS l ON l.lang = c.lang AND l.s = array_to_string(c.w[1:k], ' ') JOIN f AS r ON r.lang = c.lang AND r.s = array_to_string(c.w[k + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, k) = 1),
inner_ AS (SELECT lang, array_to_string(w[q:q + size - 1], ' ') AS s, max(a) AS longer
  FROM (SELECT *, unnest(range(1, m - size + 2)) AS q FROM (SELECT *, unnest(range(2, m)) AS size FROM c)) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN inner_ USING (lang, s) WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT)),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, s) AS rank FROM kept QUALIFY rank <= 2000)
SELECT lang, rank, s AS phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM top JOIN n USING (lang)""")
def phrase_collocations(spark, sf):
    return collocations.collocations(table(spark, sf, "documents"))


@query("op13_exact_topk", f"""
WITH {_vectors(64)},
s AS (SELECT q.r, q.vec_id AS query_id, c.r AS c, c.vec_id, {_PRODUCT} AS score FROM v AS q, v AS c WHERE q.vec_id % 20 = 0 AND q.r <> c.r)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, c) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, c) <= 20""")
def exact_topk(spark, sf):
    return topk.top_products(table(spark, sf, "embeddings"))


__all__ = ["ORACLES", "QUERIES"]
