"""DuckDB SQL twins of the training-data queries that SQL can express."""

from __future__ import annotations

from lodgeframe.llm import licenses

OP2_LINE_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), p AS (
  SELECT rid, doc_id, t,
         list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)),
                     lambda x: regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g') <> '') AS l
  FROM d
), win AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM p)
), twice AS (
  SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), rep AS (
  SELECT rid, count(DISTINCT k) AS n
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS k FROM twice) GROUP BY rid
), ln AS (
  SELECT rid, regexp_replace(unnest(l),
         '\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z', '', 'g') AS x FROM p
), lw AS (
  SELECT rid, x, len(regexp_extract_all(x, '[\x20\x09-\x0D]+')) + 1 AS n,
         len(regexp_extract_all(x, '[#*$%&<>]+|!!+')) AS marks FROM ln
), good AS (
  SELECT rid, sum(length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g'))) AS c FROM lw
  WHERE NOT (n < 10 AND NOT regexp_matches(x, '[.!?…。"''”’»)\]:;]\z'))
    AND NOT marks * 100 > n * 20
    AND NOT ((len(regexp_extract_all(x, '[|»•·]')) > 2
        AND len(regexp_extract_all(x, '[|»•·]')) * 100 > n * 4)
      OR len(regexp_extract_all(x, '[{]')) * 100 > n * 5
      OR regexp_matches(x, '(?i)^(home|menu|login|log in|sign in|sign up|register|search|contact|contact us|about|about us|faq|help|sitemap|next|previous|back|top|share|print|read more|more|skip to content|privacy|privacy policy|terms|terms of use)[.!:]?\z'))
    AND NOT (n <= 30 AND regexp_matches(x, '(?i)(lorem ipsum|javascript|enable cookies|use cookies|cookie policy|all rights reserved|terms of use|terms and conditions|privacy policy|click here|subscribe to our newsletter|sign up for our|follow us on|share this|powered by wordpress)'))
  GROUP BY rid
), n AS (
  SELECT p.rid, doc_id, len(w) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, coalesce(good.c, 0) AS kept_chars
  FROM p LEFT JOIN rep USING (rid) LEFT JOIN good USING (rid)
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM n
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT 100 * (word_chars - kept_chars) > 50 * word_chars AS kept
FROM f
"""




# Too slow on whole tables to be registered; the tests run it on a small one.
OP13_SETM_PHRASES = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)
), g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i
        FROM p, (VALUES (1), (2), (3)) s(k))
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase
), c AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10
), cut AS (
  SELECT c.lang, c.phrase, c.k, a, j, x.f AS l, y.f AS r,
         (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM c JOIN (VALUES (1), (2)) s(j) ON j < c.k
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[j + 1:], ' ')
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inner_phrase AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, a
  FROM c, (VALUES (1), (2)) s(i) WHERE k = 3
), left_over AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM inner_phrase q
    WHERE q.lang = b.lang AND q.phrase = b.phrase AND 100 * q.a >= 50 * b.a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM left_over
)
SELECT lang, rank, phrase, a, l, r,
       (SELECT sum(f)::BIGINT FROM f WHERE k = 1 AND f.lang = ranked.lang) AS n,
       score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + str(x).replace("'", "''") + "'" for x in r) + ")"
                     for r in rows)


def _op7_license_rules() -> str:
    rules = [(name, "".join(f"<{s}>" for s in ids)) for name, ids in licenses.RULES]
    return r"""
WITH known(id, sentence) AS (VALUES """ + _values(licenses.SENTENCES.items()) + r"""),
rule(name, ids) AS (VALUES """ + _values(rules) + r"""),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), cut AS (
  SELECT rid, 1 AS way, regexp_split_to_array(t,
    '[.!?;:]+(?:[\x20\x09-\x0D]+|\z)|[\x0A-\x0D]') AS a FROM d
  UNION ALL
  SELECT rid, 2, regexp_split_to_array(t,
    '[.!?;:]+(?:[\x20\x09-\x0D]+|\z)|\x0A[\x20\x09\x0D]*\x0A') FROM d
), s AS (
  SELECT rid, way, i, trim(regexp_replace(a[i], '[^a-z0-9]+', ' ', 'g')) AS x
  FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM cut)
), hit AS (
  SELECT rid, way, i, id FROM s JOIN known ON x = sentence
), seq AS (
  SELECT rid, way, string_agg('<' || id || '>', '' ORDER BY i) AS ids FROM hit GROUP BY rid, way
), lic AS (
  SELECT rid, unnest(regexp_extract_all(ids,
    (SELECT string_agg(ids, '|' ORDER BY length(ids) - length(replace(ids, '<', '')) DESC)
     FROM (SELECT DISTINCT ids FROM rule)))) AS m FROM seq
), names AS (
  SELECT rid, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses
  FROM lic JOIN rule ON m = ids GROUP BY rid
), ids AS (
  SELECT rid, string_agg(DISTINCT id, ',' ORDER BY id) AS sentences FROM hit GROUP BY rid
)
SELECT doc_id, coalesce(sentences, '') AS sentences, coalesce(licenses, '') AS licenses
FROM d LEFT JOIN ids USING (rid) LEFT JOIN names USING (rid)
"""


OP9_LINE_SPREAD = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, text,
         coalesce('s' || source, 'n') AS site, string_split(text, chr(10)) AS a FROM documents
), l AS (
  SELECT rid, doc_id, site, i, regexp_replace(a[i],
         '\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z', '', 'g') AS x
  FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM d)
), n AS (
  SELECT * FROM l WHERE x <> ''
), b AS (
  SELECT x, min({'doc_id': doc_id, 'i': i}) AS first FROM n
  GROUP BY x HAVING count(DISTINCT site) >= 5
), gone AS (
  SELECT rid, list(i) AS g FROM n JOIN b USING (x)
  WHERE {'doc_id': doc_id, 'i': i} <> first GROUP BY rid
), total AS (
  SELECT rid, count(*) AS c FROM n GROUP BY rid
)
SELECT doc_id, coalesce(c, 0)::BIGINT AS lines_total, coalesce(len(g), 0)::BIGINT AS lines_removed,
       CASE WHEN g IS NULL THEN text ELSE coalesce(array_to_string(
         list_filter(a, lambda v, k: NOT list_contains(g, k)), chr(10)), '') END AS text
FROM d LEFT JOIN gone USING (rid) LEFT JOIN total USING (rid)
"""

OP10_BLOCK_MATRIX_ANN = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_rules": OP2_LINE_RULES,
        "op7_license_rules": _op7_license_rules(),
        "op9_line_spread": OP9_LINE_SPREAD,
        "op10_block_matrix_ann": OP10_BLOCK_MATRIX_ANN,
    }
