"""DuckDB twins of the registered queries (the correctness oracle).

Each entry is a self-contained SQL statement over the driver's tables
(``part``, ``customer``, ``lineitem``, ``orders``, ``documents``, ``nation``,
``pages``). The domain views of ``lodgeframe.sources.fixtures`` are spelled
out as CTEs, generated from the same Python constants so both sides stay in
step. Float results are rounded the same way on both sides.
"""

from __future__ import annotations

from lodgeframe.functions.geo import EARTH_RADIUS_M, FOOD_KINDS, INTEREST_KEYS, SHOP_KINDS
from lodgeframe.functions.parse import AMENITY_PHRASES, TENURE_AS_OF, WS_CLASS
from lodgeframe.functions.text import AUTOMATED_MARKER
from lodgeframe.operators import polarity as polarity_ops
from lodgeframe.operators import text as text_ops
from lodgeframe.operators.geo import FEATURE_SPECS
from lodgeframe.operators.model import (CATEGORICAL, CV_FOLDS, CV_REG_PARAMS, GLM_REG_PARAM,
                                        NUMERIC_FEATURES)
from lodgeframe.sources.fixtures import AMENITY_TEXTS, AUTOMATED_NOTICE, BATH_TEXTS

PUNCT_RE = r"[!-/:-@\[-`{-~]"
NUMERIC_WORD_RE = r"^([0-9]+[.]?[0-9]*|[.][0-9]+)$"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(expr: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN {('NULL' if v is None else _q(v))}"
                     for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_q(v) if isinstance(v, str) else repr(float(v))
                                     for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({', '.join(cols)}))"


def _in_list(values) -> str:
    return ", ".join(_q(v) for v in values)


def _strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^{WS_CLASS}+|{WS_CLASS}+$', '', 'g')"


def _tokens_list(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS_CLASS}+'), lambda w: w <> '')"


RAD = "(pi() / 180.0::DOUBLE)"


def _hav(lat1, lon1, lat2, lon2) -> str:
    p1, p2 = f"({lat1} * {RAD})", f"({lat2} * {RAD})"
    s1 = f"sin(({p1} - {p2}) / 2.0::DOUBLE)"
    s2 = f"sin((({lon1} * {RAD}) - ({lon2} * {RAD})) / 2.0::DOUBLE)"
    a = f"({s1} * {s1} + cos({p1}) * cos({p2}) * {s2} * {s2})"
    a = f"least(greatest({a}, 0.0::DOUBLE), 1.0::DOUBLE)"
    return f"({repr(2.0 * EARTH_RADIUS_M)}::DOUBLE * atan2(sqrt({a}), sqrt(1.0::DOUBLE - {a})))"


# ---------------------------------------------------------------------------
# Fixture CTEs
# ---------------------------------------------------------------------------

LISTINGS = f"""listings AS (
  SELECT p.p_partkey AS id,
    49.0::DOUBLE + CAST((p.p_partkey * 37) % 500 AS DOUBLE) / 1000.0::DOUBLE
      + CAST((p.p_partkey * 7919) % 9973 AS DOUBLE) / 10000000.0::DOUBLE AS latitude,
    -123.5::DOUBLE + CAST((p.p_partkey * 91) % 1500 AS DOUBLE) / 1000.0::DOUBLE
      + CAST((p.p_partkey * 7919) % 9973 AS DOUBLE) / 10000000.0::DOUBLE AS longitude,
    CASE WHEN p.p_partkey % 17 = 0 THEN NULL
         ELSE CAST(DATE '2010-01-01' + CAST(p.p_partkey % 4000 AS INTEGER) AS VARCHAR) END
      AS host_since,
    n.n_name AS neighbourhood_cleansed,
    p.p_type AS room_type,
    CAST(1 + p.p_size % 8 AS VARCHAR) AS accommodates,
    {_case('p.p_size % 9', BATH_TEXTS)} AS bathrooms_text,
    CASE WHEN p.p_size % 7 = 0 THEN NULL ELSE CAST(1 + p.p_size % 4 AS VARCHAR) END AS beds,
    {_case('p.p_size % 6', AMENITY_TEXTS)} AS amenities,
    '$' || format('{{:,.2f}}', p.p_retailprice * (1 + p.p_size % 3)) AS price,
    CAST(p.p_size % 31 AS VARCHAR) AS availability_30
  FROM part p LEFT JOIN nation n ON p.p_size % 24 = n.n_nationkey)"""

PRICE_DROP_FIRST = "TRY_CAST(substr(replace({x}, ',', ''), 2) AS FLOAT)"


def _bath(x: str) -> str:
    t = _strip_ws(x)
    first, second = f"split_part({t}, ' ', 1)", f"split_part({t}, ' ', 2)"
    num = (f"(CASE WHEN regexp_matches({first}, '{NUMERIC_WORD_RE}') "
           f"THEN TRY_CAST({first} AS DOUBLE) ELSE 1.0::DOUBLE END)")
    factor = f"(CASE WHEN strpos({second}, 'shared') > 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END)"
    return f"CAST(CASE WHEN {x} IS NULL THEN 1.0::DOUBLE ELSE {num} * {factor} END AS FLOAT)"


AMENITY_SCORE = " + ".join(
    f"CAST(strpos(lower(amenities), {_q(p)}) > 0 AS INTEGER)" for p in AMENITY_PHRASES)

TYPED = f"""typed AS (
  SELECT id, TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude,
    neighbourhood_cleansed, room_type,
    TRY_CAST(accommodates AS INTEGER) AS accommodates,
    {_bath('bathrooms_text')} AS baths,
    CASE WHEN beds IS NULL THEN CAST(ceil(TRY_CAST(accommodates AS INTEGER) / 2) AS INTEGER)
         ELSE TRY_CAST(beds AS INTEGER) END AS beds,
    CASE WHEN host_since IS NULL THEN 0
         ELSE CAST(date_diff('day', TRY_CAST(host_since AS DATE), DATE '{TENURE_AS_OF}')
                   AS INTEGER) END AS days,
    {AMENITY_SCORE} AS amenities,
    {PRICE_DROP_FIRST.format(x='price')} AS price,
    CAST(round((30 - TRY_CAST(availability_30 AS INTEGER)) / 30.0::DOUBLE, 3) AS FLOAT)
      AS future_occupancy
  FROM listings)"""

OSM_NODES = f"""osm_nodes AS (
  SELECT c_custkey AS id,
    '2021-11-06T00:00:' || lpad(CAST(c_custkey % 60 AS VARCHAR), 2, '0') || 'Z' AS timestamp,
    49.0::DOUBLE + CAST((c_custkey * 53) % 520 AS DOUBLE) / 1000.0::DOUBLE
      + CAST((c_custkey * 7919) % 9973 AS DOUBLE) / 10000000.0::DOUBLE AS lat,
    -123.5::DOUBLE + CAST((c_custkey * 71) % 1500 AS DOUBLE) / 1000.0::DOUBLE
      + CAST((c_custkey * 7919) % 9973 AS DOUBLE) / 10000000.0::DOUBLE AS lon,
    CASE WHEN c_custkey % 8 = 0 THEN MAP {{'public_transport': 'station', 'subway': 'yes',
                                          'name': c_name}}
         WHEN c_custkey % 8 = 1 THEN MAP {{'public_transport': 'platform', 'bus': 'yes',
                                          'name': c_name}}
         WHEN c_custkey % 8 = 2 THEN MAP {{'shop': CASE c_custkey % 3 WHEN 0 THEN 'mall'
              WHEN 1 THEN 'convenience' ELSE 'supermarket' END, 'name': c_name}}
         WHEN c_custkey % 8 = 3 THEN MAP {{'amenity': CASE c_custkey % 3 WHEN 0 THEN 'restaurant'
              WHEN 1 THEN 'fast_food' ELSE 'food_court' END, 'name': c_name}}
         WHEN c_custkey % 8 = 4 THEN MAP {{'public_transport': 'station', 'bus': 'yes'}}
         WHEN c_custkey % 8 = 5 THEN MAP {{'shop': 'mall', 'amenity': 'restaurant'}}
         WHEN c_custkey % 8 = 6 THEN MAP {{'building': 'yes', 'amenity': 'bench'}}
         WHEN c_custkey % 16 = 7 THEN MAP {{}}::MAP(VARCHAR, VARCHAR)
         ELSE MAP {{'highway': 'crossing'}} END AS tags
  FROM customer)"""

NODES_KEPT = f"""nodes_kept AS (
  SELECT * FROM osm_nodes
  WHERE lat BETWEEN 49.0 AND 49.5 AND lon BETWEEN -123.5 AND -122.0
    AND list_has_any(map_keys(tags), [{_in_list(INTEREST_KEYS)}]))"""

POIS = f"""pois AS (
  SELECT osm_id, lat, lon, category, name FROM (
    SELECT id AS osm_id, lat, lon,
      CASE WHEN tags['public_transport'] = 'station' AND tags['subway'] = 'yes' THEN 'subway'
           WHEN tags['public_transport'] = 'platform' AND tags['bus'] = 'yes' THEN 'bus'
           WHEN tags['shop'] IN ({_in_list(SHOP_KINDS)}) THEN 'shopping'
           WHEN tags['amenity'] IN ({_in_list(FOOD_KINDS)}) THEN 'restaurant' END AS category,
      tags['name'] AS name
    FROM nodes_kept) WHERE category IS NOT NULL)"""

LOCS = """locs AS (SELECT id AS listing_id, TRY_CAST(latitude AS DOUBLE) AS lat,
                      TRY_CAST(longitude AS DOUBLE) AS lon FROM listings)"""

PAIRS = f"""pairs AS (
  SELECT l.listing_id, p.osm_id, p.category, {_hav('l.lat', 'l.lon', 'p.lat', 'p.lon')} AS d
  FROM locs l CROSS JOIN pois p)"""

_MAX_R = max(s[2] for s in FEATURE_SPECS)
_COUNT_COLS = ",\n    ".join(
    f"CAST(count_if(category = {_q(c)} AND d <= {r!r}) AS BIGINT) AS {n}"
    for n, c, r in FEATURE_SPECS)

FEATS_INNER = f"""feats AS (
  SELECT listing_id, {_COUNT_COLS},
    min(CASE WHEN category = 'shopping' THEN d END) AS nearest_shop_m
  FROM pairs WHERE d <= {_MAX_R!r} GROUP BY listing_id)"""

FEATURES_INNER = f"""features AS (
  SELECT listing_id, num_bus_2km, num_subway_2km, num_shop_2km, nearest_shop_m,
         num_restaurant_2km FROM feats
  WHERE num_bus_2km > 0 AND num_subway_2km > 0 AND num_shop_2km > 0
    AND num_restaurant_2km > 0)"""

FEATURES_ALL = """features_all AS (
  SELECT l.listing_id,
    coalesce(f.num_bus_2km, 0) AS num_bus_2km, coalesce(f.num_subway_2km, 0) AS num_subway_2km,
    coalesce(f.num_shop_2km, 0) AS num_shop_2km, n.nearest AS nearest_shop_m,
    coalesce(f.num_restaurant_2km, 0) AS num_restaurant_2km
  FROM (SELECT DISTINCT listing_id FROM locs) l
  LEFT JOIN feats f ON l.listing_id = f.listing_id
  LEFT JOIN (SELECT listing_id, min(d) AS nearest FROM pairs WHERE category = 'shopping'
             GROUP BY listing_id) n ON l.listing_id = n.listing_id)"""

CLEANED = """cleaned AS (
  SELECT t.id, t.latitude, t.longitude, f.num_bus_2km, f.num_subway_2km, f.num_shop_2km,
    f.nearest_shop_m, f.num_restaurant_2km, t.neighbourhood_cleansed, t.room_type,
    t.accommodates, t.baths, t.beds, t.days, t.amenities, t.price, t.future_occupancy
  FROM typed t JOIN features f ON t.id = f.listing_id)"""

CALENDAR = """calendar AS (
  SELECT l_partkey AS listing_id, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date,
    CASE WHEN l_linenumber = 7 THEN NULL
         ELSE '$' || format('{:,.2f}', l_extendedprice) END AS price
  FROM lineitem)"""

WEATHER = """weather_daily AS (
  SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL
         ELSE CAST((o_orderkey % 300) // 10 AS VARCHAR) || '.' || CAST(o_orderkey % 10 AS VARCHAR)
    END AS avg_temperature,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL
         ELSE CAST((o_orderkey % 90) // 10 AS VARCHAR) || '.' || CAST(o_orderkey % 10 AS VARCHAR)
    END AS rain
  FROM orders)"""

REVIEWS = f"""reviews AS (
  SELECT doc_id AS id, doc_id % 53 + (doc_id // 2000) * 1000 AS listing_id,
    doc_id % 101 + (doc_id // 2000) * 1000 + 600000000000000000 AS reviewer_id,
    CASE WHEN doc_id % 31 = 0 THEN NULL
         WHEN doc_id % 29 = 0 THEN {_q(AUTOMATED_NOTICE)}
         WHEN doc_id % 10 = 0 THEN 'Great<br/>stay ' || text
         ELSE text END AS comments,
    lang
  FROM documents)"""

PREPARED = f"""prepared AS (
  SELECT id, reviewer_id, listing_id, lang, c AS comments FROM (
    SELECT id, reviewer_id, listing_id, lang, lower(replace(comments, '<br/>', '')) AS c
    FROM reviews WHERE comments IS NOT NULL)
  WHERE NOT contains(c, {_q(AUTOMATED_MARKER)}))"""

STOP_WORDS = f"stop_words AS {_values([(w,) for w in text_ops.ENGLISH_STOP_WORDS], ['word'])}"


def _spread(steps: int) -> tuple[str, ...]:
    """CTEs of the lexicon spread over neighbouring words: ``lexicon`` (word, polarity, seed)."""
    ctes = [f"""seeds AS (
  SELECT word, ((length(word) * 7 + (length(word) - length(replace(word, 'e', ''))) * 5) % 21 - 10)
    / 10.0::DOUBLE AS polarity FROM (
    SELECT DISTINCT regexp_replace(unnest({_tokens_list('lower(text)')}), '{PUNCT_RE}', '', 'g')
      AS word FROM documents) WHERE length(word) % 3 = 1)""", f"""lists AS (
  SELECT list_filter(list_transform({_tokens_list('lower(text)')},
      lambda x: regexp_replace(x, '{PUNCT_RE}', '', 'g')),
    lambda x: x <> '' AND x NOT IN ({', '.join(map(_q, text_ops.ENGLISH_STOP_WORDS))})) AS w
  FROM documents WHERE lang = 'en')""", """pairs AS (
  SELECT unnest(w[:-2]) AS a, unnest(w[2:]) AS b FROM lists WHERE len(w) > 1)""", """edges AS (
  SELECT word, other, count(*) AS n FROM (SELECT a AS word, b AS other FROM pairs WHERE a <> b
    UNION ALL SELECT b, a FROM pairs WHERE a <> b) GROUP BY word, other)""", """free AS (
  SELECT word, sum(n) AS total FROM edges WHERE word NOT IN (SELECT word FROM seeds)
  GROUP BY word)""", "step0 AS (SELECT word, 0.0::DOUBLE AS polarity FROM free)"]
    for k in range(1, steps + 1):
        known = "(SELECT * FROM seeds" + (f" UNION ALL SELECT * FROM step{k - 1})" if k > 1 else ")")
        ctes.append(f"""step{k} AS (
  SELECT f.word, round(coalesce(s, 0.0::DOUBLE) / total, 12) AS polarity FROM free f LEFT JOIN (
    SELECT e.word, sum(n * polarity) AS s FROM edges e JOIN {known} k ON k.word = e.other
    GROUP BY e.word) t ON t.word = f.word)""")
    return (*ctes, f"""lexicon AS (SELECT word, polarity, true AS seed FROM seeds
  UNION ALL SELECT word, polarity, false FROM step{steps})""")


def _forms(nouns: str) -> str:
    """Plural forms of the rows of ``nouns`` (word) that are no noun themselves."""
    return f"""SELECT form AS word, min(word) AS lemma FROM (
  SELECT word, word || 's' AS form FROM {nouns}
  UNION ALL SELECT word, word || 'es' FROM {nouns} WHERE regexp_matches(word, '(s|x|z|ch|sh)$')
  UNION ALL SELECT word, left(word, -1) || 'ies' FROM {nouns}
    WHERE regexp_matches(word, '[^aeiou]y$')
  UNION ALL SELECT word, left(word, -3) || 'men' FROM {nouns} WHERE suffix(word, 'man'))
WHERE form NOT IN (SELECT word FROM {nouns}) GROUP BY form"""


LEMMAS = f"""nouns AS {_values([(w,) for w in text_ops.DEFAULT_NOUNS], ['word'])},
exceptions AS {_values(text_ops.DEFAULT_LEMMAS, ['word', 'lemma'])},
lemmas AS (SELECT * FROM exceptions UNION ALL SELECT * FROM ({_forms('nouns')})
  WHERE word NOT IN (SELECT word FROM exceptions))"""
LEXICON = f"lexicon AS {_values(text_ops.DEFAULT_LEXICON, ['word', 'polarity'])}"
LANG_WORDS = "lang_words AS " + _values(
    [(lang, w) for lang, ws in text_ops.DEFAULT_LANG_WORDS.items() for w in ws],
    ["lang", "word"])

EN_REVIEWS = "en_reviews AS (SELECT * FROM prepared WHERE lang = 'en')"

RAW_TOKENS = f"""raw_tokens AS (
  SELECT id, unnest(toks) AS token, CAST(generate_subscripts(toks, 1) - 1 AS INTEGER) AS pos
  FROM (SELECT id, {_tokens_list('comments')} AS toks FROM en_reviews))"""

CLEAN_TOKENS = f"""clean_tokens AS (
  SELECT s.id, s.pos, coalesce(l.lemma, s.token) AS token FROM (
    SELECT id, pos, regexp_replace(token, '{PUNCT_RE}', '', 'g') AS token
    FROM raw_tokens WHERE token NOT IN (SELECT word FROM stop_words)) s
  LEFT JOIN lemmas l ON s.token = l.word
  WHERE s.token <> '')"""

SCORES = """scores AS (
  SELECT r.id, r.listing_id, r.reviewer_id, r.comments,
    (CAST(coalesce(p.polarity, 0.0::DOUBLE) AS DECIMAL(32,18)) + 1) * 2.5::DOUBLE AS score
  FROM en_reviews r LEFT JOIN (
    SELECT t.id, avg(x.polarity) AS polarity FROM clean_tokens t JOIN lexicon x
      ON t.token = x.word GROUP BY t.id) p ON r.id = p.id)"""

HOSTS = """hosts AS (
  SELECT p_partkey AS host_id,
    4.0::DOUBLE + CAST(p_partkey % 200 AS DOUBLE) / 100.0::DOUBLE AS intercept,
    1.2::DOUBLE AS slope
  FROM part)"""

PREDICTED = """pp AS (
  SELECT host_id, TRY_CAST(trunc(exp(intercept - slope * (CAST(k AS DOUBLE) / 1000.0::DOUBLE)))
                           AS INTEGER) AS price, k AS occ_k
  FROM hosts CROSS JOIN range(1, 1001) g(k))"""

CURVE = """curve AS (
  SELECT host_id, price, CAST(sum(occ_k) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 1000.0::DOUBLE
    AS future_occupancy
  FROM (SELECT host_id, price, occ_k FROM pp WHERE price IS NOT NULL
        UNION ALL
        SELECT host_id, unnest(range(0, m + 1)) AS price, 1000 AS occ_k
        FROM (SELECT host_id, min(price) AS m FROM pp WHERE price IS NOT NULL GROUP BY host_id))
  GROUP BY host_id, price)"""


BEST = """SELECT host_id,
  CAST(price AS INTEGER) AS price, future_occupancy, profit FROM (
  SELECT host_id, price, future_occupancy, price * future_occupancy * 30 AS profit,
    rank() OVER (PARTITION BY host_id ORDER BY price * future_occupancy * 30 DESC) AS r
  FROM curve) WHERE r = 1"""

XY = """xy AS (
  SELECT CAST(future_occupancy AS DOUBLE) AS x, ln(price) AS y,
    CASE WHEN (id % 100 * 48271 + 5) % 100 < 80 THEN 0 ELSE 1 END AS part,
    ((id % 1009) * 31 + 7) % 5 AS fold
  FROM typed WHERE price > 0 AND future_occupancy IS NOT NULL)"""


def _words(source: str, key: str, text: str) -> str:
    return f"""SELECT {key} AS key, unnest(string_split(trim(regexp_replace(lower({text}),
      '[^\\p{{L}}\\p{{M}}]+', ' ', 'g')), ' ')) AS w FROM {source}"""


def _grams(name: str, source: str, key: str, text: str) -> str:
    """CTE (key, gram, n) of the character trigrams inside words."""
    return f"""{name} AS (
  SELECT key, gram, CAST(sum(n) AS DOUBLE) AS n FROM (
    SELECT key, n, unnest(list_transform(range(1, len(c) - 1),
      lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram FROM (
      SELECT key, string_split(' ' || w || ' ', '') AS c, count(*) AS n
      FROM ({_words(source, key, text)}) WHERE w <> '' GROUP BY key, w))
  GROUP BY key, gram)"""


def _language_ctes(train: str, docs: str, key: str, text: str) -> tuple[str, ...]:
    """CTEs of the trigram model of ``train``; ``found`` (key, lang) of the texts of ``docs``."""
    return (_grams("seen", f"(SELECT * FROM {train} WHERE lang IS NOT NULL)", "lang", "text"),
            _grams("asked", docs, key, text), f"""kinds AS (
  SELECT s.key AS lang, sum(n) AS grams, (SELECT count(DISTINCT gram) FROM seen) AS v,
    ln((SELECT count(*) FROM {train} t WHERE t.lang = s.key)::DOUBLE
       / (SELECT count(lang) FROM {train})) AS prior FROM seen s GROUP BY s.key)""", """ranked AS (
  SELECT key, lang, row_number() OVER (PARTITION BY key ORDER BY round(score, 9) DESC, lang) AS rn
  FROM (SELECT a.key, k.lang, max(k.prior) + sum(a.n * ln((coalesce(s.n, 0) + 0.5::DOUBLE)
      / (k.grams + 0.5::DOUBLE * k.v))) AS score
    FROM asked a CROSS JOIN kinds k LEFT JOIN seen s ON s.gram = a.gram AND s.key = k.lang
    GROUP BY a.key, k.lang))""",
            "found AS (SELECT key, lang FROM ranked WHERE rn = 1)")


PARADIGMS = ("""vocabulary AS (
  SELECT DISTINCT w AS word FROM (
    SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM documents WHERE lang = 'en')
  WHERE w <> '')""", """attested AS (
  SELECT v.word, form || '>' || ending_of_lemma AS rule, lemma, right(lemma, 2) AS ending,
    EXISTS (SELECT 1 FROM vocabulary k WHERE k.word = lemma) AS seen
  FROM (SELECT word, form, ending_of_lemma,
      left(word, length(word) - length(form)) || ending_of_lemma AS lemma
    FROM vocabulary JOIN (VALUES ('s', ''), ('es', ''), ('ies', 'y'), ('ves', 'f'), ('ves', 'fe'),
      ('men', 'man')) r(form, ending_of_lemma) ON word LIKE '%' || form) v
  WHERE length(lemma) >= 3)""", """paradigms AS (
  SELECT rule, ending, count(*) AS tries, count_if(seen)::BIGINT AS support
  FROM attested GROUP BY rule, ending)""")

MODEL_ALL = """cleaned_all AS (
  SELECT t.*, f.* EXCLUDE (listing_id) FROM typed t JOIN features_all f ON t.id = f.listing_id)"""


def _glm(variants, grid, folds: int = 5) -> tuple[str, ...]:
    """CTEs of ridge fits over all model features: ``coef`` (k, reg, j, b, mu) and ``base``.

    Variant k leaves fold k out of the training part (-1: none); label indexes follow the
    variant's own counts. The normal equations of standardised columns are solved by
    Gauss-Jordan elimination, one pivot a recursion step.
    """
    numeric = ", ".join(f"CAST({f} AS DOUBLE)" for f in NUMERIC_FEATURES)
    p, last = len(NUMERIC_FEATURES) + len(CATEGORICAL), len(NUMERIC_FEATURES) + len(CATEGORICAL) + 1
    null_free = " AND ".join(f"{f} IS NOT NULL" for f in NUMERIC_FEATURES)
    labels = [f"""lab{n} AS (
  SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY n DESC, v) - 1 AS i,
    count(*) OVER (PARTITION BY k) AS size FROM (
    SELECT k, {source} AS v, count(*) AS n FROM base, variants
    WHERE part = 0 AND fold <> k AND {source} IS NOT NULL GROUP BY k, {source}))"""
              for n, (source, _) in enumerate(CATEGORICAL)]
    index = ", ".join(f"""CAST(coalesce(l{n}.i, (SELECT max(size) FROM lab{n} s WHERE s.k = a.k), 0)
      AS DOUBLE)""" for n in range(len(CATEGORICAL)))
    joins = " ".join(f"LEFT JOIN lab{n} l{n} ON l{n}.k = a.k AND l{n}.v = a.{source}"
                     for n, (source, _) in enumerate(CATEGORICAL))
    return (MODEL_ALL, f"""base AS (
  SELECT *, row_number() OVER () AS rid, ln(price) AS y,
    CASE WHEN (id % 100 * 48271 + 5) % 100 < 80 THEN 0 ELSE 1 END AS part,
    ((id % 1009) * 31 + 7) % {folds} AS fold
  FROM cleaned_all WHERE price > 0 AND {null_free})""",
            f"variants AS (SELECT unnest({list(variants)}) AS k)", *labels, f"""vec AS (
  SELECT a.k, a.rid, a.part, a.fold, [{numeric}, {index}, y] AS x
  FROM (SELECT * FROM base, variants) a {joins})""", f"""cells AS (
  SELECT k, rid, part, fold, unnest(range(1, {last + 1})) AS j, unnest(x) AS x FROM vec)""",
            """train AS (SELECT * FROM cells WHERE part = 0 AND fold <> k)""", """spread AS (
  SELECT k, j, avg(x) AS mu, stddev_pop(x) AS sd FROM train GROUP BY k, j)""", """cor AS (
  SELECT a.k, a.j AS i, b.j AS j, covar_pop(a.x, b.x) AS c FROM train a JOIN train b
  ON a.k = b.k AND a.rid = b.rid GROUP BY a.k, a.j, b.j)""", f"""grid AS (
  SELECT CAST(unnest({[repr(float(g)) for g in grid]}) AS DOUBLE) AS reg)""", f"""cell AS (
  SELECT k, reg, i, cor.j AS j, CASE WHEN i = cor.j THEN 1.0::DOUBLE + CASE WHEN a.sd > 0 THEN reg / y.sd
      ELSE 0 END WHEN a.sd > 0 AND b.sd > 0 THEN c / (a.sd * b.sd) ELSE 0 END AS v
  FROM cor JOIN spread a USING (k) JOIN spread b USING (k) JOIN spread y USING (k), grid
  WHERE a.j = i AND b.j = cor.j AND y.j = {last} AND i <= {p})""", """lines AS (
  SELECT k, reg, i, list(v ORDER BY j) AS l FROM cell GROUP BY k, reg, i)""", """elim AS (
  SELECT k, reg, 1 AS p, list(l ORDER BY i) AS m FROM lines GROUP BY k, reg
  UNION ALL
  SELECT k, reg, p + 1, list_transform(m, lambda w, r: CASE WHEN r = p
    THEN list_transform(w, lambda v: v / w[p])
    ELSE list_transform(w, lambda v, c: v - w[p] * m[p][c] / m[p][p]) END)
  FROM elim WHERE p <= """ + f"{p})", f"""solved AS (
  SELECT k, reg, unnest(range(1, {p + 1})) AS j, list_transform(m, lambda w: w[{last}]) AS b
  FROM elim WHERE p = {p + 1})""", f"""coef AS (
  SELECT s.k, s.reg, s.j, CASE WHEN x.sd > 0 THEN s.b[s.j] * y.sd / x.sd ELSE 0 END AS b, x.mu
  FROM solved s JOIN spread x ON x.k = s.k AND x.j = s.j
  JOIN spread y ON y.k = s.k AND y.j = {last})""", f"""intercepts AS (
  SELECT c.k, c.reg, max(y.mu) - sum(c.b * c.mu) AS b0 FROM coef c
  JOIN spread y ON y.k = c.k AND y.j = {last} GROUP BY c.k, c.reg)""", f"""fitted AS (
  SELECT v.k, c.reg, v.rid, v.part, v.fold, max(v.x[{last}]) AS y,
    sum(v.x[c.j] * c.b) + max(i.b0) AS prediction
  FROM vec v JOIN coef c ON c.k = v.k JOIN intercepts i ON i.k = c.k AND i.reg = c.reg
  GROUP BY v.k, c.reg, v.rid, v.part, v.fold)""")


def _slope(reg: str) -> str:
    """Ridge slope of y on x: a Gaussian GLM with standardised feature and label."""
    return f"regr_slope(y, x) / (1.0::DOUBLE + CAST({reg} AS DOUBLE) / stddev_pop(y))"


def _with(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------

def _price_by(dim: str) -> str:
    return _with(LISTINGS) + f"""SELECT {dim}, count(price) AS count, round(avg(price), 6) AS price
FROM (SELECT {dim}, {PRICE_DROP_FIRST.format(x='price')} AS price FROM listings) GROUP BY {dim}"""


def _price_by_baths() -> str:
    return _with(LISTINGS) + f"""SELECT baths, count(price) AS count, round(avg(price), 6) AS price
FROM (SELECT {_bath('bathrooms_text')} AS baths, {PRICE_DROP_FIRST.format(x='price')} AS price
      FROM listings) GROUP BY baths"""


def _all_dims() -> str:
    parts = []
    for d in ("room_type", "accommodates", "beds", "baths", "neighbourhood_cleansed"):
        parts.append(f"SELECT {_q(d)} AS dimension, CAST({d} AS VARCHAR) AS value, "
                     f"count(price) AS count, round(avg(price), 6) AS price FROM chart "
                     f"GROUP BY CAST({d} AS VARCHAR)")
    chart = (f"chart AS (SELECT room_type, accommodates, beds, neighbourhood_cleansed, "
             f"{_bath('bathrooms_text')} AS baths, {PRICE_DROP_FIRST.format(x='price')} AS price "
             f"FROM listings)")
    return _with(LISTINGS, chart) + "\nUNION ALL\n".join(parts)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    q["listing_typed"] = _with(LISTINGS, TYPED) + "SELECT * FROM typed"
    q["price_parse"] = _with(CALENDAR) + f"""SELECT listing_id, date,
  {PRICE_DROP_FIRST.format(x='price')} AS price,
  TRY_CAST(replace(replace(price, '$', ''), ',', '') AS DOUBLE) AS price_value
FROM calendar"""
    q["amenity_values"] = _with(LISTINGS) + """SELECT id,
  CAST(len(string_split(replace(replace(amenities, '[', ''), ']', ''), ', ')) AS INTEGER)
    AS amenities_value,
  TRY_CAST(replace(replace(price, '$', ''), ',', '') AS DOUBLE) AS price_value
FROM listings"""
    q["amenity_frequency"] = _with(LISTINGS) + """SELECT item, count(*) AS count FROM (
  SELECT unnest(string_split(replace(replace(lower(amenities), '[', ''), ']', ''), ', ')) AS item
  FROM listings) GROUP BY item"""
    q["amenity_terms"] = _with(LISTINGS) + r"""SELECT word, count FROM (
  SELECT word, count(*) AS count FROM (
    SELECT unnest(regexp_extract_all(lower(amenities), '[\p{L}\p{N}_][\p{L}\p{N}_'']+')) AS word
    FROM listings) GROUP BY word)"""
    q["amenity_price_corr"] = _with(LISTINGS) + """SELECT round(corr(v, p), 8) AS r FROM (
  SELECT CAST(len(string_split(replace(replace(amenities, '[', ''), ']', ''), ', ')) AS DOUBLE) AS v,
         TRY_CAST(replace(replace(price, '$', ''), ',', '') AS DOUBLE) AS p FROM listings)
WHERE p < 1000.0"""
    q["price_by_room_type"] = _price_by("room_type")
    q["price_by_accommodates"] = _price_by("accommodates")
    q["price_by_beds"] = _price_by("beds")
    q["price_by_baths"] = _price_by_baths()
    q["price_by_neighbourhood"] = _price_by("neighbourhood_cleansed")
    q["price_by_all_dims"] = _all_dims()
    q["monthly_price"] = _with(CALENDAR) + f"""SELECT month, round(avg(id_price), 6) AS price FROM (
  SELECT month, listing_id, avg(price) AS id_price FROM (
    SELECT listing_id, CAST(month(TRY_CAST(date AS DATE)) AS INTEGER) AS month,
           {PRICE_DROP_FIRST.format(x='price')} AS price FROM calendar)
  WHERE month IS NOT NULL GROUP BY month, listing_id) GROUP BY month"""
    q["monthly_weather"] = _with(WEATHER) + """SELECT month,
  round(sum(rain) / count(tem), 1) AS rain, round(sum(tem) / count(tem), 1) AS temp
FROM (SELECT CAST(month(TRY_CAST(date AS DATE)) AS INTEGER) AS month,
             TRY_CAST(avg_temperature AS FLOAT) AS tem, TRY_CAST(rain AS FLOAT) AS rain
      FROM weather_daily) GROUP BY month"""
    q["poi_nodes"] = _with(OSM_NODES, NODES_KEPT) + \
        "SELECT id, timestamp, lat, lon, CAST(len(map_keys(tags)) AS INTEGER) AS n_tags " \
        "FROM nodes_kept"
    q["poi_category"] = _with(OSM_NODES, NODES_KEPT, POIS) + "SELECT * FROM pois"
    q["radius_pairs"] = _with(LISTINGS, OSM_NODES, NODES_KEPT, POIS, LOCS, PAIRS) + \
        "SELECT listing_id, osm_id, category, round(d, 3) AS dist FROM pairs WHERE d <= 2000.0"
    q["listing_poi_features"] = _with(LISTINGS, OSM_NODES, NODES_KEPT, POIS, LOCS, PAIRS,
                                      FEATS_INNER, FEATURES_INNER) + \
        """SELECT listing_id, num_bus_2km, num_subway_2km, num_shop_2km,
  round(nearest_shop_m, 3) AS nearest_shop_m, num_restaurant_2km FROM features"""
    q["listing_poi_features_all"] = _with(LISTINGS, OSM_NODES, NODES_KEPT, POIS, LOCS, PAIRS,
                                          FEATS_INNER, FEATURES_ALL) + \
        "SELECT * REPLACE (round(nearest_shop_m, 3) AS nearest_shop_m) FROM features_all"
    q["listing_poi_features_cells"] = q["listing_poi_features_all"]
    q["nearest_shop"] = _with(LISTINGS, OSM_NODES, NODES_KEPT, POIS, LOCS, PAIRS) + \
        """SELECT listing_id, round(min(d), 3) AS nearest_m FROM pairs
WHERE category = 'shopping' GROUP BY listing_id"""
    cleaned_ctes = (LISTINGS, TYPED, OSM_NODES, NODES_KEPT, POIS, LOCS, PAIRS, FEATS_INNER,
                    FEATURES_INNER, CLEANED)
    q["cleaned_listing"] = _with(*cleaned_ctes) + \
        "SELECT * REPLACE (round(nearest_shop_m, 3) AS nearest_shop_m) FROM cleaned"
    q["cleaned_listing_all"] = _with(LISTINGS, TYPED, OSM_NODES, NODES_KEPT, POIS, LOCS, PAIRS,
                                     FEATS_INNER, FEATURES_ALL) + """SELECT t.id, t.latitude,
  t.longitude, f.num_bus_2km, f.num_subway_2km, f.num_shop_2km,
  round(f.nearest_shop_m, 3) AS nearest_shop_m, f.num_restaurant_2km, t.neighbourhood_cleansed,
  t.room_type, t.accommodates, t.baths, t.beds, t.days, t.amenities, t.price, t.future_occupancy
FROM typed t JOIN features_all f ON t.id = f.listing_id"""
    q["neighbourhood_prices"] = _with(*cleaned_ctes) + \
        """SELECT n.n_name AS neighbourhood_cleansed, round(a.price, 6) AS price
FROM nation n LEFT JOIN (SELECT neighbourhood_cleansed, avg(price) AS price FROM cleaned
                         GROUP BY neighbourhood_cleansed) a
  ON n.n_name = a.neighbourhood_cleansed"""

    text_ctes = (REVIEWS, PREPARED, EN_REVIEWS, STOP_WORDS, LEMMAS, RAW_TOKENS, CLEAN_TOKENS)
    q["review_tokens"] = _with(*text_ctes) + "SELECT id, pos, token FROM raw_tokens"
    q["review_clean_tokens"] = _with(*text_ctes) + "SELECT id, pos, token FROM clean_tokens"
    q["review_joined"] = _with(*text_ctes) + \
        "SELECT id, string_agg(token, ' ' ORDER BY pos) AS text FROM clean_tokens GROUP BY id"
    q["review_language"] = _with(REVIEWS, PREPARED, LANG_WORDS) + f"""SELECT p.id,
  coalesce(v.lang, 'und') AS lang FROM prepared p LEFT JOIN (
  SELECT id, lang, row_number() OVER (PARTITION BY id ORDER BY n DESC, lang) AS rn FROM (
    SELECT t.id, w.lang, count(*) AS n FROM (
      SELECT id, regexp_replace(unnest({_tokens_list('lower(comments)')}), '{PUNCT_RE}', '', 'g')
        AS token FROM prepared) t
    JOIN lang_words w ON t.token = w.word GROUP BY t.id, w.lang)) v ON p.id = v.id AND v.rn = 1"""
    q["review_language_model"] = _with(REVIEWS, PREPARED, *_language_ctes(
        "documents", "prepared", "id", "comments")) + """SELECT p.id,
  coalesce(f.lang, 'und') AS lang FROM prepared p LEFT JOIN found f ON f.key = p.id"""
    part = "CASE WHEN (doc_id % 100 * 48271 + 5) % 100 < 80 THEN 0 ELSE 1 END"
    q["language_held_out"] = _with(f"train_docs AS (SELECT * FROM documents WHERE {part} = 0)",
        f"held AS (SELECT * FROM documents WHERE {part} = 1)",
        *_language_ctes("train_docs", "held", "doc_id", "text")) + """SELECT h.lang AS truth,
  coalesce(f.lang, 'und') AS found, count(*) AS n
FROM held h LEFT JOIN found f ON f.key = h.doc_id GROUP BY ALL"""
    q["review_score"] = _with(*text_ctes, LEXICON, SCORES) + \
        "SELECT id, listing_id, reviewer_id, comments, round(score, 6) AS score FROM scores"
    q["review_score_corpus"] = _with(REVIEWS, PREPARED, EN_REVIEWS, STOP_WORDS, LEMMAS, f"""lexicon AS (
  SELECT word, ((length(word) * 7 + (length(word) - length(replace(word, 'e', ''))) * 5) % 21 - 10)
    / 10.0::DOUBLE AS polarity FROM (
    SELECT DISTINCT regexp_replace(unnest({_tokens_list('lower(text)')}), '{PUNCT_RE}', '', 'g')
      AS word FROM documents) WHERE length(word) % 3 = 1)""", f"""toks AS (
  SELECT id, unnest(range(1, len(w) + 1)) AS i, w FROM (
    SELECT id, {_tokens_list('comments')} AS w FROM en_reviews))""", f"""cleaned AS (
  SELECT id, regexp_replace(w[i], '{PUNCT_RE}', '', 'g') AS token,
    coalesce(regexp_replace(CASE WHEN i > 1 THEN w[i - 1] END, '{PUNCT_RE}', '', 'g') IN ('not',
      'no', 'never', 'without', 'cannot', 'isnt', 'wasnt', 'dont', 'didnt'), false) AS negated
  FROM toks WHERE w[i] NOT IN (SELECT word FROM stop_words))""", """pol AS (
  SELECT c.id, avg(x.polarity * CASE WHEN negated THEN -0.5 ELSE 1.0 END) AS polarity
  FROM cleaned c LEFT JOIN lemmas l ON c.token = l.word
  JOIN lexicon x ON x.word = coalesce(l.lemma, c.token) WHERE c.token <> '' GROUP BY c.id)""") + \
        """SELECT r.id, r.reviewer_id, round((CAST(coalesce(p.polarity, 0.0::DOUBLE)
  AS DECIMAL(32,18)) + 1) * 2.5::DOUBLE, 6) AS score FROM en_reviews r LEFT JOIN pol p ON r.id = p.id"""
    q["lemma_forms"] = _with("""names AS (
  SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part)""") + _forms("names")
    q["lemma_paradigms"] = _with(*PARADIGMS) + "SELECT * FROM paradigms"
    q["induced_lemmas"] = _with(*PARADIGMS) + """SELECT word, lemma, rule, seen FROM (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY seen DESC, support DESC,
    length(lemma) DESC, lemma, rule) AS rn
  FROM attested JOIN paradigms USING (rule, ending)
  WHERE support >= 3 AND ((seen AND support * 100 >= tries * 20) OR support * 100 >= tries * 80))
WHERE rn = 1"""
    q["lexicon_spread"] = _with(*_spread(3)) + \
        "SELECT word, round(polarity::DECIMAL(20, 12), 6)::DOUBLE AS polarity, seed FROM lexicon"
    degrees = _values(polarity_ops.DEGREES, ["word", "degree"])
    negators = _values([(w,) for w in text_ops.NEGATORS], ["word"])
    q["review_polarity_scoped"] = _with(
        *_spread(3), REVIEWS, PREPARED, f"degrees AS {degrees}",
        f"negators AS {negators}", f"""said AS (
  SELECT id, unnest(w) AS token, unnest([''] || w) AS b1, unnest(['', ''] || w) AS b2 FROM (
    SELECT id, list_filter(list_transform({_tokens_list('comments')},
      lambda x: regexp_replace(x, '{PUNCT_RE}', '', 'g')), lambda x: x <> '') AS w FROM prepared))""") + \
        """SELECT id, round(avg(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, polarity * CASE
    WHEN b1 IN (SELECT word FROM negators) THEN -0.5::DOUBLE
    WHEN d.degree IS NULL THEN 1.0::DOUBLE
    WHEN b2 IN (SELECT word FROM negators) THEN -0.5::DOUBLE / d.degree
    ELSE d.degree * coalesce(e.degree, 1.0::DOUBLE) END))), 6) AS polarity, count(*) AS words
FROM said JOIN lexicon x ON x.word = token LEFT JOIN degrees d ON d.word = b1
  LEFT JOIN degrees e ON e.word = b2 GROUP BY id"""
    q["topk_per_reviewer"] = _with(*text_ctes, LEXICON, SCORES) + """SELECT reviewer_id,
  listing_id, id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT reviewer_id, listing_id, id, round(score, 6) AS score,
    row_number() OVER (PARTITION BY reviewer_id ORDER BY round(score, 6) DESC, listing_id, id)
      AS rank
  FROM scores) WHERE rank <= 3"""

    q["link_catalogue"] = r"""SELECT page_id, pos, link,
  trim(regexp_replace(text, '<[^>]*>', '', 'g')) AS text,
  string_split(link, '/')[-3] AS segment FROM (
  SELECT page_id, unnest(regexp_extract_all(html, p, 1)) AS link,
    unnest(regexp_extract_all(html, p, 2)) AS text,
    CAST(generate_subscripts(regexp_extract_all(html, p, 1), 1) - 1 AS INTEGER) AS pos
  FROM pages, (SELECT '(?s)<a\s[^>]*?href=["'']([^"'']*)["''][^>]*>(.*?)</a>' AS p))"""
    q["catalogue_rows"] = """SELECT page_id, 'day ' || page_id AS date_compiled,
  'City ' || page_id AS country_city,
  'City ' || page_id || '_2021-' || page_id || '_' || f AS file_name,
  'Data of ' || url AS description,
  'http://data.example.com/canada/bc/2021-' || page_id || '/data/' || f AS link
FROM pages, (VALUES ('listings.csv'), ('reviews.csv')) AS t(f)"""
    q["availability"] = """SELECT l_partkey AS listing_id,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date,
  CASE WHEN l_linenumber <> 6 AND l_linestatus = 'O' THEN 1 ELSE 0 END AS taken FROM lineitem"""
    q["type_flags"] = _with(LISTINGS) + """SELECT id,
  CAST(contains(room_type, 'ECONOMY') AS INTEGER) AS economy,
  CAST(contains(bathrooms_text, 'shared') AS INTEGER) AS shared_bath FROM listings"""

    q["label_index"] = _with(LISTINGS, TYPED) + """SELECT 'neighbourhood_cleansed' AS column_name,
  neighbourhood_cleansed AS value,
  CAST(row_number() OVER (ORDER BY count(*) DESC, neighbourhood_cleansed) - 1 AS INTEGER) AS index
FROM typed WHERE neighbourhood_cleansed IS NOT NULL GROUP BY neighbourhood_cleansed
UNION ALL
SELECT 'room_type', room_type,
  CAST(row_number() OVER (ORDER BY count(*) DESC, room_type) - 1 AS INTEGER)
FROM typed WHERE room_type IS NOT NULL GROUP BY room_type"""
    q["hash_split"] = _with(LISTINGS) + """SELECT id,
  CASE WHEN (((id * 48271 + 5) % 100) + 100) % 100 < 80 THEN 0 ELSE 1 END AS part FROM listings"""
    q["price_ridge_1f"] = _with(LISTINGS, TYPED) + """SELECT round(slope, 8) AS slope,
  round(my - slope * mx, 8) AS intercept FROM (
  SELECT regr_slope(y, x) / (1.0::DOUBLE + 0.01::DOUBLE / stddev_pop(y)) AS slope,
         avg(y) AS my, avg(x) AS mx
  FROM (SELECT CAST(future_occupancy AS DOUBLE) AS x, ln(price) AS y FROM typed
        WHERE price > 0 AND future_occupancy IS NOT NULL))"""
    q["price_rmse_1f"] = _with(LISTINGS, TYPED, XY) + f"""SELECT round(sqrt(avg(
  (y - (my - slope * mx) - slope * x) ** 2)), 8) AS rmse
FROM (SELECT * FROM xy WHERE part = 1), (
  SELECT {_slope('0.01')} AS slope, avg(y) AS my, avg(x) AS mx FROM xy WHERE part = 0)"""
    q["price_cv_1f"] = _with(LISTINGS, TYPED, XY, f"""grid AS (
  SELECT CAST(r AS DOUBLE) AS reg_param, i FROM (VALUES (1e-5, 0), (1e-4, 1), (1e-3, 2), (1e-2, 3),
    (0.1, 4), (0.15, 5), (0.2, 6), (0.3, 7)) AS t(r, i))""", f"""folds AS (
  SELECT g.reg_param, g.i, f.f, {_slope('reg_param')} AS slope, avg(y) AS my, avg(x) AS mx
  FROM grid g, (SELECT DISTINCT fold AS f FROM xy) f, xy
  WHERE part = 0 AND fold <> f.f GROUP BY g.reg_param, g.i, f.f)""", """cv AS (
  SELECT reg_param, i, avg(e) AS cv_rmse FROM (
    SELECT k.reg_param, k.i, k.f, sqrt(avg((y - (my - slope * mx) - slope * x) ** 2)) AS e
    FROM folds k JOIN xy ON part = 0 AND fold = k.f GROUP BY k.reg_param, k.i, k.f)
  GROUP BY reg_param, i)""", "best AS (SELECT * FROM cv ORDER BY cv_rmse, i LIMIT 1)",
        f"""fit AS (
  SELECT b.i, {_slope('reg_param')} AS slope, avg(y) AS my, avg(x) AS mx
  FROM best b, xy WHERE part = 0 GROUP BY b.i, b.reg_param)""", """err AS (
  SELECT i, part, round(sqrt(avg((y - (my - slope * mx) - slope * x) ** 2)), 8) AS e
  FROM fit, xy GROUP BY i, part)""") + """SELECT cv.reg_param, cv.i = best.i AS is_best,
  round(cv.cv_rmse, 8) AS cv_rmse, t.e AS train_rmse, v.e AS validation_rmse
FROM cv CROSS JOIN best LEFT JOIN err t ON cv.i = t.i AND t.part = 0
LEFT JOIN err v ON cv.i = v.i AND v.part = 1"""
    q["price_glm_2f"] = _with(LISTINGS, TYPED) + """, m AS (
  SELECT 1.0::DOUBLE + 0.01::DOUBLE / stddev_pop(y) AS k, corr(x, y) AS rx, corr(z, y) AS rz,
    corr(x, z) AS r, stddev_pop(x) AS sx, stddev_pop(z) AS sz, stddev_pop(y) AS sy,
    avg(x) AS mx, avg(z) AS mz, avg(y) AS my
  FROM (SELECT CAST(future_occupancy AS DOUBLE) AS x, CAST(accommodates AS DOUBLE) AS z,
          ln(price) AS y FROM typed
        WHERE price > 0 AND future_occupancy IS NOT NULL AND accommodates IS NOT NULL)
), b AS (
  SELECT *, (k * rx - r * rz) / (k * k - r * r) * sy / sx AS bx,
    (k * rz - r * rx) / (k * k - r * r) * sy / sz AS bz FROM m)
SELECT 'x' AS feature, round(bx, 8) AS value FROM b
UNION ALL SELECT 'z', round(bz, 8) FROM b
UNION ALL SELECT 'intercept', round(my - bx * mx - bz * mz, 8) FROM b"""
    features_all = (LISTINGS, TYPED, OSM_NODES, NODES_KEPT, POIS, LOCS, PAIRS, FEATS_INNER,
                    FEATURES_ALL)
    one_fit = (*features_all, *_glm([-1], [GLM_REG_PARAM]))
    q["price_glm_predict"] = _with(*one_fit, recursive=True) + """SELECT b.id,
  round(f.y, 6) AS label, round(f.prediction, 6) AS prediction
FROM fitted f JOIN base b USING (rid) WHERE f.part = 1"""
    q["price_glm_rmse"] = _with(*one_fit, recursive=True) + """SELECT
  round(sqrt(avg((y - prediction) ** 2)), 8) AS rmse FROM fitted WHERE part = 1"""
    occupancy = NUMERIC_FEATURES.index("future_occupancy") + 1
    q["price_glm_profit"] = _with(*one_fit, f"""hosts AS (
  SELECT b.id AS host_id, f.prediction - c.b * v.x[{occupancy}] AS intercept, -c.b AS slope
  FROM fitted f JOIN base b USING (rid) JOIN vec v USING (rid), coef c
  WHERE f.part = 1 AND c.j = {occupancy})""", PREDICTED, CURVE, recursive=True) + BEST
    q["price_glm_cv"] = _with(*features_all, *_glm(range(-1, CV_FOLDS), CV_REG_PARAMS), """cv AS (
  SELECT reg, avg(e) AS cv_rmse FROM (
    SELECT k, reg, sqrt(avg((y - prediction) ** 2)) AS e FROM fitted
    WHERE part = 0 AND fold = k GROUP BY k, reg) GROUP BY reg)""",
        "best AS (SELECT reg FROM cv ORDER BY cv_rmse, reg LIMIT 1)", """err AS (
  SELECT reg, part, round(sqrt(avg((y - prediction) ** 2)), 8) AS e FROM fitted JOIN best USING (reg)
  WHERE k = -1 GROUP BY reg, part)""", recursive=True) + """SELECT cv.reg AS reg_param,
  cv.reg = best.reg AS is_best, round(cv_rmse, 8) AS cv_rmse, t.e AS train_rmse,
  v.e AS validation_rmse
FROM cv CROSS JOIN best LEFT JOIN err t ON t.reg = cv.reg AND t.part = 0
LEFT JOIN err v ON v.reg = cv.reg AND v.part = 1"""
    als_ctes = (*text_ctes, LEXICON, SCORES, """parts AS (
  SELECT reviewer_id, listing_id,
    CASE WHEN h < 60 THEN 0 WHEN h < 80 THEN 1 ELSE 2 END AS part FROM (
    SELECT *, ((id % 2147483647) % 100 * 48271 + 5) % 100 AS h FROM scores))""")
    q["als_split"] = _with(*als_ctes) + """SELECT CAST(p AS INTEGER) AS part,
  count(part) AS n, count(DISTINCT reviewer_id) AS reviewers
FROM range(0, 3) t(p) LEFT JOIN parts ON part = p GROUP BY p"""
    facts = """SELECT reviewer_id, least(10, items) AS n, least(10, items) AS listings,
  0::BIGINT AS unseen, 0::BIGINT AS negative
FROM (SELECT DISTINCT reviewer_id FROM parts WHERE part = 0),
     (SELECT count(DISTINCT listing_id) AS items FROM parts WHERE part = 0)"""
    q["als_recommend_facts"] = _with(*als_ctes) + facts
    q["als_recommend_users"] = _with(*als_ctes) + facts + \
        " WHERE reviewer_id IN (SELECT reviewer_id FROM reviews WHERE lang = 'fr')"
    q["optimise"] = _with(LISTINGS, OSM_NODES, NODES_KEPT, POIS, LOCS, PAIRS, FEATS_INNER,
                          FEATURES_INNER, """hosts AS (
  SELECT listing_id AS host_id, 4.0::DOUBLE
    + CAST(least(num_shop_2km, 100) AS DOUBLE) / 100.0::DOUBLE
    + CAST(least(num_restaurant_2km, 50) AS DOUBLE) / 100.0::DOUBLE AS intercept,
    1.2::DOUBLE AS slope FROM features)""", PREDICTED, CURVE) + BEST
    q["profit_curve"] = _with(HOSTS, PREDICTED, CURVE) + """SELECT host_id,
  CAST(price AS INTEGER) AS price,
  future_occupancy, price * future_occupancy * 30 AS profit FROM curve"""
    q["best_price"] = _with(HOSTS, PREDICTED, CURVE) + BEST
    return q

