"""Language identification by character n-grams (N1): naive Bayes counted and scored with joins.

Training counts the n-grams of labelled texts per language. A gram that a language lacks
costs that language its default, so scoring adds up only what training saw: one join on the
gram, whose row holds its gain in each language, and one sum per text. The model rows of
the empty gram hold each language's prior and default. Grams are taken inside words, so no array is longer than a
word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.operators.text import UNDETERMINED, by_id
from lodgeframe.operators.util import materialize

GRAM = 3
SMOOTHING = 0.5
# The gram that stands for all grams of a text.
EVERY = ""


def _word_grams(word: Column, size: int) -> Column:
    """The n-grams of one word between blanks; a word too short for one gives none."""
    # A character is consumed and the gram from it on looked ahead at: one pass a word.
    return F.regexp_extract_all(F.concat(F.lit(" "), word, F.lit(" ")),
                                F.lit(rf"(?s)(?=(.{{{size}}}))."), F.lit(1))


def _cut_words(docs: DataFrame, key: str, text_col: str, size: int) -> DataFrame:
    """(key, _n, _g): the distinct words of a key with their count and their n-grams.

    Outer explodes, here and on the grams: the optimiser would cut every text and word a
    second time for a filter before an inner one.
    """
    letters = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"[\p{L}\p{M}]++"), F.lit(0))
    words = docs.select(key, F.explode_outer(letters).alias("_word")) \
        .where(F.col("_word").isNotNull()).groupBy(key, "_word").agg(F.count(F.lit(1)).alias("_n"))
    return words.select(key, "_n", _word_grams(F.col("_word"), size).alias("_g"))


def gram_counts(docs: DataFrame, key: str, text_col: str, size: int = GRAM) -> DataFrame:
    """(key, gram, n): n-grams of the words (runs of letters and marks, lower-cased).

    The empty gram has the number of all. Words are counted before they are cut, so a
    frequent word is cut once a key; keys without a gram have no row.
    """
    cut = _cut_words(docs, key, text_col, size)
    grams = cut.select(key, "_n", F.size("_g").alias("_size"), F.explode_outer(
        F.concat("_g", F.array(F.lit(EVERY)))).alias("gram"))
    n = F.when(F.col("gram") == EVERY, F.col("_n") * F.col("_size")).otherwise(F.col("_n"))
    return grams.where((F.col("gram") != EVERY) | (F.col("_size") > 0)) \
        .groupBy(key, "gram").agg(F.sum(n).alias("n"))


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
          size: int = GRAM, smoothing: float = SMOOTHING) -> DataFrame:
    """The model (gram, lang, base, gain): ``n`` such grams add ``base + n * gain``.

    Rows without a label are left out; a language without a single gram is not in the
    model. The table is written: it is as large as the alphabets make it, not the corpus.
    """
    known = labelled.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("_text"))
    counts = materialize(gram_counts(known, "lang", "_text", size))
    texts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("_texts"))
    vocabulary = counts.where(F.col("gram") != EVERY).agg(F.countDistinct("gram")).first()[0]
    every = texts.agg(F.sum("_texts")).first()[0] or 0
    alpha, whole = F.lit(float(smoothing)), F.col("gram") == EVERY
    return materialize(counts.join(texts, "lang").select(
        "gram", "lang",
        F.when(whole, F.log(F.col("_texts") / F.lit(float(every)))).otherwise(0.0).alias("base"),
        F.when(whole, F.log(alpha / (F.col("n") + alpha * F.lit(float(vocabulary)))))
        .otherwise(F.log((F.col("n") + alpha) / alpha)).alias("gain")))


def scores(docs: DataFrame, model: DataFrame, id_col: str = "id", text_col: str = "comments",
           size: int = GRAM) -> DataFrame:
    """(id, lang, score): log prior and likelihood of every text with a gram, per language."""
    # A row a language: the priors and defaults.
    langs = model.where(F.col("gram") == EVERY).orderBy("lang").collect()
    # One row a gram holds its gain in each language, so a text's gram meets one row and
    # sums need no gram as their key.
    gains = model.where(F.col("gram") != EVERY).groupBy(F.col("gram").alias("_gram")).agg(*[
        F.sum(F.when(F.col("lang") == r["lang"], F.col("gain"))).alias(f"_l{i}")
        for i, r in enumerate(langs)] or [F.lit(0.0).alias("_none")])
    grams = _cut_words(by_id(docs.select(id_col, text_col), id_col), id_col, text_col, size) \
        .select(id_col, "_n", F.explode_outer("_g").alias("_gram")).where(F.col("_gram").isNotNull())
    sums = grams.join(gains, "_gram", "left").groupBy(id_col).agg(
        F.sum("_n").alias("_all"),
        *[F.coalesce(F.sum(F.col("_n") * F.col(f"_l{i}")), F.lit(0.0)).alias(f"_l{i}")
          for i in range(len(langs))])
    each = [F.struct(F.lit(r["lang"]).alias("lang"), (
        F.lit(r["base"]) + F.col("_all") * F.lit(r["gain"]) + F.col(f"_l{i}")).alias("score"))
        for i, r in enumerate(langs)]
    return sums.select(id_col, F.inline(
        F.array(*each) if each else F.array().cast("array<struct<lang:string,score:double>>")))


def identify(docs: DataFrame, model: DataFrame, id_col: str = "id", text_col: str = "comments",
             size: int = GRAM) -> DataFrame:
    """(id, lang), one row per id; the likeliest language, ties to the smaller code.

    Texts that are NULL or without a gram, and all texts under an empty model, are ``und``;
    rows that share an id (or have none) count as one text.
    """
    best = scores(docs, model, id_col, text_col, size).groupBy(id_col).agg(
        F.min_by("lang", F.struct(-F.round("score", 9), F.col("lang"))).alias("lang"))
    ids = docs.select(F.col(id_col).alias("_id")).distinct()
    return ids.join(best, F.col("_id").eqNullSafe(F.col(id_col)), "left").select(
        F.col("_id").alias(id_col), F.coalesce("lang", F.lit(UNDETERMINED)).alias("lang"))
