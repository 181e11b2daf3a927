"""Noun lemmas induced from a corpus: suffix paradigms counted over its vocabulary.

A rule turns the ending of a form into the ending of its lemma (``ies`` -> ``y``). A
paradigm is a rule together with the last letters of the lemma. Its *tries* are the
words of the vocabulary that the rule can be read into; its *support* is how many of
these have their lemma in the vocabulary, too. A form is accepted where its paradigm has
enough support, in number and as a share of the tries, so that chance pairs of words
(``his`` / ``hi``) stay out without a list of nouns. Where the share is high, the rule is
productive, and a form whose lemma the corpus never shows is accepted as well.

All counts are over distinct words: one aggregate, one join on the lemma and one on the
paradigm (at most a few thousand rows). Ratios are compared in whole numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Endings of English plural forms and of their lemmas.
RULES = (("s", ""), ("es", ""), ("ies", "y"), ("ves", "f"), ("ves", "fe"), ("men", "man"))
ENDING = 2            # letters of the lemma's end that tell paradigms of a rule apart
SHORTEST = 3          # letters of a lemma
MIN_SUPPORT = 3
MIN_SHARE = 20        # percent
PRODUCTIVE = 80       # percent: lemmas that the corpus lacks are accepted, too


def vocabulary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): the words of letters a to z in lower-cased whole texts, and their counts."""
    return docs.select(F.explode(F.split(F.lower(F.col(text_col)), "[^a-z]+", -1)).alias("word")) \
        .where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def readings(words: DataFrame, rules=RULES, ending: int = ENDING,
             shortest: int = SHORTEST) -> DataFrame:
    """(word, rule, lemma, ending): every rule that a word can be read by."""
    w = F.col("word")
    made = F.array(*[
        F.when(w.endswith(form), F.struct(
            F.lit(f"{form}>{lemma}").alias("rule"),
            F.concat(F.substring(w, F.lit(1), F.length(w) - len(form)), F.lit(lemma)).alias("lemma")))
        for form, lemma in rules])
    return words.select("word", F.explode(F.filter(made, lambda x: x.isNotNull())).alias("r")) \
        .select("word", "r.rule", "r.lemma").where(F.length("lemma") >= shortest) \
        .withColumn("ending", F.right("lemma", F.lit(ending)))


def attested(words: DataFrame, **form) -> DataFrame:
    """``readings`` with ``seen``: whether the lemma is a word itself."""
    known = words.select(F.col("word").alias("lemma")).distinct().withColumn("seen", F.lit(True))
    return readings(words.select("word").where("word IS NOT NULL").distinct(), **form).join(
        known, "lemma", "left").withColumn("seen", F.coalesce("seen", F.lit(False)))


def paradigms(words: DataFrame, **form) -> DataFrame:
    """(rule, ending, tries, support) of every paradigm of a vocabulary (word)."""
    return _counted(attested(words, **form))


def _counted(read: DataFrame) -> DataFrame:
    return read.groupBy("rule", "ending").agg(F.count(F.lit(1)).alias("tries"),
                                              F.count_if("seen").alias("support"))


def induced_lemmas(words: DataFrame, min_support: int = MIN_SUPPORT, min_share: int = MIN_SHARE,
                   productive: int = PRODUCTIVE, **form) -> DataFrame:
    """(word, lemma, rule, seen): one lemma for every form that a paradigm accepts.

    ``words`` is a vocabulary (word); repeated and null words do not count. Of several
    accepted readings a seen lemma goes first, then the best supported paradigm, then the
    longer lemma, then the lemma that sorts first. An empty vocabulary gives no rows.
    """
    read = attested(words, **form)
    judged = read.join(_counted(read), ["rule", "ending"])
    share = F.col("support") * 100
    kept = judged.where((F.col("support") >= min_support) & (
        (F.col("seen") & (share >= F.col("tries") * min_share))
        | (share >= F.col("tries") * productive)))
    order = W.partitionBy("word").orderBy(F.desc("seen"), F.desc("support"),
                                          F.desc(F.length("lemma")), "lemma", "rule")
    return kept.withColumn("_r", F.row_number().over(order)).where("_r = 1").select(
        "word", "lemma", "rule", "seen")
