"""Review text pipeline: language vote, tokens, stop words, lemmas, polarity score.

Dictionaries (stop words, lemmas, polarity lexicon, language word lists) are
DataFrames. Tokens are exploded per review and looked up with joins; Catalyst
and AQE choose a broadcast or a shuffle for a dictionary from its measured
bytes, and building a plan starts no job. Reviews are hash-partitioned by id
once, before their tokens are exploded: every later aggregate and join by
review id reuses that partitioning, so the text moves once.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.functions import text as T
from lodgeframe.functions.parse import polarity_to_rating

# The standard English stop-word list (179 words) removed from
# raw tokens before punctuation is stripped.
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've",
    "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he", "him", "his",
    "himself", "she", "she's", "her", "hers", "herself", "it", "it's", "its", "itself",
    "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this",
    "that", "that'll", "these", "those", "am", "is", "are", "was", "were", "be", "been",
    "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an", "the",
    "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for",
    "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "don't", "should", "should've", "now", "d", "ll", "m", "o", "re", "ve", "y", "ain",
    "aren", "aren't", "couldn", "couldn't", "didn", "didn't", "doesn", "doesn't", "hadn",
    "hadn't", "hasn", "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn",
    "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't", "shouldn",
    "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
)

# Exceptions of the noun lemma table (word, lemma); they go before the suffix rules.
DEFAULT_LEMMAS = (
    ("was", "wa"), ("as", "a"), ("has", "ha"), ("does", "doe"), ("is", "is"),
    ("people", "people"), ("children", "child"), ("feet", "foot"), ("teeth", "tooth"),
    ("knives", "knife"), ("shelves", "shelf"), ("dishes", "dish"),
)

# Default noun vocabulary of this engine: the suffix rules only yield these lemmas.
DEFAULT_NOUNS = (
    "room", "host", "stay", "bed", "night", "day", "place", "apartment", "thing", "word",
    "year", "time", "way", "view", "kitchen", "towel", "bath", "beach", "bus", "city",
    "family", "man", "woman", "house", "minute", "shop", "restaurant", "window", "door",
    "neighbour", "neighbourhood", "pillow", "sheet", "glass", "fridge", "box", "party",
    "balcony", "lobby", "key", "bathroom", "bedroom", "street", "walk", "week", "guest",
)

# Words that turn the polarity of the next word, and by how much.
NEGATORS = ("not", "no", "never", "without", "cannot", "isnt", "wasnt", "dont", "didnt")
NEGATION_FACTOR = -0.5

# Default polarity lexicon (word, polarity in -1..1) of this engine.
DEFAULT_LEXICON = (
    ("best", 1.0), ("excellent", 1.0), ("perfect", 1.0), ("wonderful", 1.0),
    ("amazing", 0.6), ("great", 0.8), ("lovely", 0.5), ("good", 0.7), ("nice", 0.6),
    ("clean", 0.35), ("comfortable", 0.4), ("friendly", 0.4), ("helpful", 0.5),
    ("quiet", 0.25), ("fine", 0.4), ("happy", 0.8), ("pleasant", 0.7), ("beautiful", 0.85),
    ("bad", -0.7), ("poor", -0.4), ("dirty", -0.6), ("noisy", -0.3), ("rude", -0.3),
    ("terrible", -1.0), ("awful", -1.0), ("horrible", -1.0), ("worst", -1.0),
    ("useless", -0.5), ("broken", -0.4), ("worthless", -0.8), ("disappointing", -0.6),
)

# Default language word lists (lang, word) for the language vote.
UNDETERMINED = "und"
DEFAULT_LANG_WORDS = {
    "en": ("the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "was", "on",
           "with", "be", "as", "by", "this", "are", "at", "from"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "pour",
           "est", "qui", "dans", "par", "pas", "au", "sur", "avec"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "sich", "mit", "auf", "des",
           "für", "ist", "nicht", "im", "dem", "ein", "eine", "als"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "por", "un", "no",
           "con", "su", "una", "es", "para", "al", "lo"),
}


# ---------------------------------------------------------------------------
# Dictionary tables
# ---------------------------------------------------------------------------

def _table(spark: SparkSession, rows, **types) -> DataFrame:
    """A dictionary as a local relation: its true size is known to the optimiser."""
    schema = pa.schema(list(types.items()))
    columns = list(zip(*rows)) or [[] for _ in types]
    return spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(columns, schema.types)],
                                          schema=schema))


def stop_words_table(spark: SparkSession, words=ENGLISH_STOP_WORDS) -> DataFrame:
    return _table(spark, [(w,) for w in words], word=pa.string())


def noun_forms(nouns: DataFrame) -> DataFrame:
    """(word, lemma) for the plural forms of a vocabulary table (word).

    The suffix rules -s, -es, -ies and -men read backwards: a form maps to a lemma
    only if the lemma is in the vocabulary. A form that is a noun itself stays.
    """
    w = F.col("word")
    forms = F.filter(F.array(
        F.concat(w, F.lit("s")),
        F.when(w.rlike("(s|x|z|ch|sh)$"), F.concat(w, F.lit("es"))),
        F.when(w.rlike("[^aeiou]y$"), F.regexp_replace(w, "y$", "ies")),
        F.when(w.rlike("man$"), F.regexp_replace(w, "man$", "men"))), lambda x: x.isNotNull())
    pairs = nouns.select(F.explode(forms).alias("form"), w.alias("lemma"))
    return pairs.join(nouns, F.col("form") == w, "left_anti").groupBy(
        F.col("form").alias("word")).agg(F.min("lemma").alias("lemma"))


def lemma_table(spark: SparkSession, exceptions=DEFAULT_LEMMAS, nouns=DEFAULT_NOUNS) -> DataFrame:
    """(word, lemma): the exceptions, and the plural forms of the vocabulary."""
    first = _table(spark, list(exceptions), word=pa.string(), lemma=pa.string())
    forms = noun_forms(_table(spark, [(n,) for n in nouns], word=pa.string()))
    return first.unionByName(forms.join(first, "word", "left_anti"))


def lexicon_table(spark: SparkSession, pairs=DEFAULT_LEXICON) -> DataFrame:
    return _table(spark, list(pairs), word=pa.string(), polarity=pa.float64())


def lang_words_table(spark: SparkSession, lists=None) -> DataFrame:
    lists = lists or DEFAULT_LANG_WORDS
    return _table(spark, [(lang, w) for lang, words in lists.items() for w in words],
                  lang=pa.string(), word=pa.string())


def by_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows hash-partitioned by review id, in as many tasks as any other shuffle."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, id_col)


# ---------------------------------------------------------------------------
# Review preparation
# ---------------------------------------------------------------------------

def prepare_reviews(reviews: DataFrame) -> DataFrame:
    """Drop NULL comments, remove ``<br/>``, lower-case, drop automated postings."""
    cols = [c for c in ("id", "reviewer_id", "listing_id", "lang") if c in reviews.columns]
    base = reviews.where(F.col("comments").isNotNull())
    lowered = base.select(*cols, F.lower(T.remove_line_breaks("comments")).alias("comments"))
    return lowered.where(T.not_automated("comments"))


# ---------------------------------------------------------------------------
# Tokens (N2 - N5)
# ---------------------------------------------------------------------------

def tokens(docs: DataFrame, id_col: str = "id", text_col: str = "comments",
           negation: bool = False) -> DataFrame:
    """(id, pos, token) whitespace tokens of the whole text (pos from 0).

    With ``negation`` also ``negated``: the token before, without punctuation, is a negator.
    """
    if not negation:
        return docs.select(
            id_col, F.posexplode(T.whitespace_tokens(text_col)).alias("pos", "token"))
    toks = docs.select(id_col, T.whitespace_tokens(text_col).alias("_ts"))
    pairs = F.arrays_zip(F.col("_ts").alias("token"), F.concat(
        F.array(F.lit("")), F.col("_ts")).alias("before"))
    out = toks.select(id_col, F.posexplode(F.slice(pairs, F.lit(1), F.greatest(
        F.size("_ts"), F.lit(0)))).alias("pos", "_p"))
    return out.select(id_col, "pos", F.col("_p.token").alias("token"),
                      T.strip_punctuation("_p.before").isin(*NEGATORS).alias("negated"))


def remove_stop_words(toks: DataFrame, stop_words: DataFrame) -> DataFrame:
    """Anti-join raw tokens with the stop-word table (``the,`` survives)."""
    sw = stop_words.select(F.col("word").alias("token"))
    return toks.join(sw, "token", "left_anti")


def strip_tokens(toks: DataFrame) -> DataFrame:
    """Tokens without ASCII punctuation; ones that become empty stay, as empty tokens."""
    cols = [c for c in toks.columns if c != "token"]
    return toks.select(*cols, T.strip_punctuation("token").alias("token"))


def strip_token_punctuation(toks: DataFrame) -> DataFrame:
    """Strip ASCII punctuation inside tokens and drop empty tokens."""
    cols = [c for c in toks.columns if c != "token"]
    return (toks.select(*cols, T.strip_punctuation("token").alias("token"))
            .where(F.col("token") != F.lit("")))


def lemmatize(toks: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Replace a token by its lemma when the table has one."""
    lt = lemmas.select(F.col("word").alias("token"), "lemma")
    cols = [c for c in toks.columns if c != "token"]
    return (toks.join(lt, "token", "left")
            .select(*cols, F.coalesce("lemma", "token").alias("token")))


def clean_tokens(docs: DataFrame, stop_words: DataFrame, lemmas: DataFrame,
                 id_col: str = "id", text_col: str = "comments",
                 negation: bool = False) -> DataFrame:
    """N2 -> N4 -> N3 -> N5: (id, pos, token[, negated]) of the cleaned review text."""
    t = tokens(docs, id_col, text_col, negation)
    return lemmatize(strip_token_punctuation(remove_stop_words(t, stop_words)), lemmas)


def joined_tokens(toks: DataFrame, id_col: str = "id") -> DataFrame:
    """The cleaned tokens of each review joined by single spaces, in order."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "token")))
    return toks.groupBy(id_col).agg(
        F.array_join(F.transform(ordered, lambda x: x["token"]), " ").alias("text"))


# ---------------------------------------------------------------------------
# Language (N1)
# ---------------------------------------------------------------------------

def detect_language(docs: DataFrame, lang_words: DataFrame, id_col: str = "id",
                    text_col: str = "comments") -> DataFrame:
    """(id, lang) by word vote; most hits wins, ties go to the smaller language code.

    Tokens are lower-cased and punctuation-stripped before the lookup. A
    document without any hit, or without any token, is ``und``.
    """
    t = by_id(docs.select(id_col, F.lower(F.col(text_col)).alias("_t")), id_col).select(
        id_col, F.explode_outer(T.whitespace_tokens("_t")).alias("token"))
    words = lang_words.select("lang", F.col("word").alias("token"))
    # A left join keeps documents without any hit; both aggregates reuse the id partitioning.
    hits = strip_tokens(t).join(words, "token", "left")
    votes = hits.groupBy(id_col, "lang").agg(F.count(F.lit(1)).alias("_n"))
    best = F.min_by("lang", F.struct(F.col("lang").isNull(), (-F.col("_n")).alias("n"), "lang"))
    return votes.groupBy(id_col).agg(F.coalesce(best, F.lit(UNDETERMINED)).alias("lang"))


# ---------------------------------------------------------------------------
# Polarity and score
# ---------------------------------------------------------------------------

def polarity(toks: DataFrame, lexicon: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, polarity) mean lexicon polarity of the matched tokens (reviews with a match).

    A token marked as negated counts with its polarity times ``NEGATION_FACTOR``.
    """
    lx = lexicon.select(F.col("word").alias("token"), "polarity")
    value = F.col("polarity")
    if "negated" in toks.columns:
        value = F.when(F.col("negated"), value * F.lit(NEGATION_FACTOR)).otherwise(value)
    return toks.join(lx, "token", "inner").groupBy(id_col).agg(F.avg(value).alias("polarity"))


def review_scores(reviews: DataFrame, stop_words: DataFrame, lemmas: DataFrame,
                  lexicon: DataFrame, lang_words: DataFrame | None = None,
                  language: str = "en", negation: bool = False) -> DataFrame:
    """(id, listing_id, reviewer_id, comments, score) for reviews in ``language``.

    Uses the review's ``lang`` column when there is one, else the word vote.
    ``comments`` is the cleaned lower-case text; ``score = (polarity + 1) * 2.5``
    with polarity 0 when no lexicon word matches.
    """
    prepared = by_id(prepare_reviews(reviews))
    if "lang" in prepared.columns:
        kept = prepared.where(F.col("lang") == F.lit(language)).drop("lang")
    else:
        if lang_words is None:
            raise ValueError("reviews have no lang column; pass lang_words")
        langs = detect_language(prepared, lang_words)
        kept = prepared.join(langs.where(F.col("lang") == F.lit(language)).select("id"), "id",
                             "left_semi")
    toks = clean_tokens(kept.select("id", "comments"), stop_words, lemmas, negation=negation)
    pol = polarity(toks, lexicon)
    scored = kept.join(pol, "id", "left")
    p = F.coalesce(F.col("polarity"), F.lit(0.0)).cast("decimal(32,18)")
    return scored.select("id", "listing_id", "reviewer_id", "comments",
                         polarity_to_rating(p).alias("score"))
