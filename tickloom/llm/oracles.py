"""SQL of the corpus queries that DuckDB can express, over the whole tables."""

from __future__ import annotations

from .license_scan import oracle_sql as license_sql

#: Every pair of texts that share a shingle, and what is reachable over links.
NGRAM_JACCARD = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, hash(list_slice(w, i, i + 4)) AS h FROM (SELECT r, w, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [1] ELSE range(1, len(w) - 3) END) AS i FROM d)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS shared FROM s a JOIN s b ON a.h = b.h AND a.r <> b.r GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
c(a, b) AS (SELECT r, r FROM d UNION SELECT c.a, e.b FROM c JOIN e ON e.a = c.b)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id FROM d LEFT JOIN n USING (r) JOIN c ON c.a = d.r JOIN d o ON o.r = c.b GROUP BY d.r, d.doc_id"""

#: Every 200-byte window of every text by its digest.
SUFFIX_ARRAY_DEDUP = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
p AS (SELECT r, unnest(range(octet_length(b) - 199)) AS i, b FROM d WHERE octet_length(b) >= 200),
c AS (SELECT r, i, count(*) OVER (PARTITION BY md5(array_slice(b, i + 1, i + 200))) AS n FROM p),
f AS (SELECT r, i, i + 200 AS e, max(i + 200) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM c WHERE n > 1),
g AS (SELECT r, i, e, sum(CAST(before IS NULL OR i > before AS INT)) OVER (PARTITION BY r ORDER BY i) AS k FROM f),
s AS (SELECT r, k, min(i) AS first, max(e) AS last FROM g GROUP BY ALL),
h AS (SELECT r, count(*) AS n_spans, sum(last - first) AS n_removed, list([first, last] ORDER BY first) AS spans FROM s GROUP BY r),
q AS (SELECT d.*, coalesce(n_spans, 0) AS n_spans, coalesce(n_removed, 0) AS n_removed, hex(b) AS x, [[0, 0]] || coalesce(spans, []) || [[octet_length(b), 0]] AS s FROM d LEFT JOIN h USING (r))
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, n_spans,
       sha256(unhex(list_aggregate(list_transform(range(1, len(s)), lambda k: substr(x, CAST(2 * s[k][2] + 1 AS BIGINT), CAST(2 * (s[k + 1][1] - s[k][2]) AS BIGINT))), 'string_agg', ''))) AS kept_sha256 FROM q"""

#: Base statistics, and the conjunction of all rules.
QUALITY_RULES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
x AS (SELECT r, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) > 7),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, list_slice(w, i, i + 7)) AS c FROM x),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM g, range(8) AS o(k) WHERE c > 1 GROUP BY r),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
ln AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup, count(*) FILTER (regexp_matches(l, '^[\x20\x09-\x0D]*([-*]|•)')) AS n_bullets,
              count(*) FILTER (regexp_matches(l, '(\.\.\.|…)[\x20\x09-\x0D]*$')) AS n_ellipses FROM l WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
s AS (SELECT w.r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda y: length(y))), 0) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
             len(list_filter(w, lambda y: regexp_matches(y, '[A-Za-z]|[^\x00-\x7F]'))) AS n_lettered, coalesce(n_bullets, 0) AS n_bullets, coalesce(n_ellipses, 0) AS n_ellipses
      FROM w LEFT JOIN ln USING (r) LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 10 * n_lettered < 6 * n_words OR 10 * n_bullets > 9 * n_lines OR 10 * n_ellipses > 3 * n_lines) AS kept FROM b"""


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard": NGRAM_JACCARD, "op3_license_scan": license_sql(), "op4_suffix_array_dedup": SUFFIX_ARRAY_DEDUP, "op7_quality_rules": QUALITY_RULES}
