"""Polarity beyond a fixed word list (N7): a lexicon spread over a corpus, and phrase scopes.

Spreading. Words that stand next to each other in a text (stop words left out) are
neighbours, weighted by how often they do. Seeds keep their polarity; in each step every
other word takes the weighted mean of its neighbours' values of the step before (0 where
unknown). Pairs are counted with one aggregate inside the scan's tasks; a step is one join and
one aggregate over distinct pairs, written once, so its lineage stays short.

Scopes. A word's polarity is scaled by the words right before it: an intensifier or a
diminisher multiplies it, two in a row both do, and a negator before the word or
before one such word turns it ("not very good" is weaker than "not good").
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions import text as T
from lodgeframe.operators.text import ENGLISH_STOP_WORDS, NEGATION_FACTOR, NEGATORS
from lodgeframe.operators.util import materialize

STEPS = 3
# Words that strengthen or weaken the word behind them, and by how much.
DEGREES = (("very", 1.3), ("really", 1.2), ("extremely", 1.5), ("so", 1.2), ("too", 1.1),
           ("absolutely", 1.4), ("incredibly", 1.5), ("quite", 1.1), ("super", 1.3),
           ("fairly", 0.8), ("rather", 0.8), ("somewhat", 0.7), ("slightly", 0.5),
           ("barely", 0.4), ("hardly", 0.4))


def _tokens(text_col: str) -> Column:
    """Lower-cased tokens of a whole text without punctuation, empty ones dropped.

    Punctuation is no space, so it goes from the whole text in one pass before the split.
    """
    return T.whitespace_tokens(T.without_punctuation(F.lower(F.col(text_col))))


def neighbours(docs: DataFrame, text_col: str = "text",
               stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS) -> DataFrame:
    """(word, other, n): how often two different words stand next to each other, both ways."""
    words = F.filter(_tokens(text_col), lambda w: ~w.isin(*stop_words))
    texts = docs.select(words.alias("w")).where(F.size("w") > 1)
    pairs = texts.select(F.explode(F.arrays_zip(
        F.slice("w", F.lit(1), F.size("w") - 1).alias("a"), F.slice(
            "w", F.lit(2), F.size("w") - 1).alias("b"))).alias("p"))
    counted = pairs.where(F.col("p.a") != F.col("p.b")).groupBy(
        F.least("p.a", "p.b").alias("a"), F.greatest("p.a", "p.b").alias("b")).agg(
        F.count(F.lit(1)).alias("n"))
    return counted.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other")))).alias("p"), "n").select(
        "p.word", "p.other", "n")


def spread(edges: DataFrame, seeds: DataFrame, steps: int = STEPS) -> DataFrame:
    """(word, polarity, seed) after ``steps`` steps from ``seeds`` (word, polarity).

    ``edges`` is (word, other, n) as ``neighbours`` gives it. Seeds stay whether or not the
    corpus has them (of a repeated seed the mean counts; null ones do not); every other word
    with a neighbour gets a row. No seeds leave all words at 0, no edges the seeds alone.
    """
    edges = materialize(edges)
    fixed = materialize(seeds.where("word IS NOT NULL AND polarity IS NOT NULL").groupBy("word")
                        .agg(F.avg(F.col("polarity").cast("double")).alias("polarity")))
    free = materialize(edges.groupBy("word").agg(F.sum("n").alias("total")).join(
        fixed, "word", "left_anti"))
    known = fixed
    moved = free.select("word", F.lit(0.0).alias("polarity"))
    for _ in range(steps):
        told = edges.join(known.withColumnRenamed("word", "other"), "other").groupBy("word").agg(
            F.sum(F.col("n") * F.col("polarity")).alias("s"))
        moved = materialize(free.join(told, "word", "left").select("word", F.round(
            F.coalesce(F.col("s"), F.lit(0.0)) / F.col("total"), 12).alias("polarity")))
        known = fixed.unionByName(moved)
    return fixed.select("word", "polarity", F.lit(True).alias("seed")).unionByName(
        moved.select("word", "polarity", F.lit(False).alias("seed")))


def scoped_tokens(docs: DataFrame, id_col: str = "id", text_col: str = "comments",
                  degrees=DEGREES, negators=NEGATORS) -> DataFrame:
    """(id, pos, token, factor): tokens with the factor that the two words before them set."""
    words = docs.select(id_col, _tokens(text_col).alias("w"))

    def degree(c: Column) -> Column:
        return reduce(lambda e, d: e.when(c == d[0], F.lit(float(d[1]))), degrees,
                      F.when(F.lit(False), F.lit(1.0)))

    pad = F.array(F.lit(""), F.lit(""))
    t = words.select(id_col, F.posexplode(F.filter(F.arrays_zip(
        F.col("w").alias("token"), F.concat(F.slice(pad, 1, 1), "w").alias("before"),
        F.concat(pad, "w").alias("second")), lambda x: x["token"].isNotNull())).alias("pos", "x"))
    t = t.select(id_col, "pos", F.col("x.token").alias("token"),
                 degree(F.col("x.before")).alias("_d1"), degree(F.col("x.second")).alias("_d2"),
                 F.col("x.before").isin(*negators).alias("_n1"),
                 F.col("x.second").isin(*negators).alias("_n2"))
    factor = F.when(F.col("_n1"), F.lit(NEGATION_FACTOR)).when(
        F.col("_d1").isNull(), F.lit(1.0)).when(
        F.col("_n2"), F.lit(NEGATION_FACTOR) / F.col("_d1")).otherwise(
        F.col("_d1") * F.coalesce("_d2", F.lit(1.0)))
    return t.select(id_col, "pos", "token", factor.alias("factor"))


def scoped_polarity(toks: DataFrame, lexicon: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, polarity, words): mean of polarity times factor, each within -1 and 1, over the
    tokens that the lexicon knows (reviews without one have no row)."""
    value = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("polarity") * F.col("factor")))
    return toks.join(lexicon.select(F.col("word").alias("token"), "polarity"), "token") \
        .groupBy(id_col).agg(F.avg(value).alias("polarity"), F.count(F.lit(1)).alias("words"))
