"""Language identification by n-grams: brute force, held-out accuracy, odd input."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from lodgeframe.operators import language as LM
from lodgeframe.operators import model as M


def _grams(text, size=3):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    return Counter(f" {w} "[i:i + size] for w in words for i in range(len(w) + 3 - size))


def _brute(train, text, size=3, alpha=0.5):
    per, texts = {}, Counter()
    for lang, t in train:
        if lang is not None:
            per.setdefault(lang, Counter()).update(_grams(t, size))
            texts[lang] += 1
    vocabulary = {g for c in per.values() for g in c}
    return {lang: math.log(texts[lang] / sum(texts.values())) + sum(
        n * math.log((c[g] + alpha) / (sum(c.values()) + alpha * len(vocabulary)))
        for g, n in _grams(text, size).items()) for lang, c in per.items() if c}


TRAIN = [("en", "The host was kind, and the room was clean!"), ("en", "a b c"),
         ("fr", "La chambre était très propre et l'hôte gentil."), ("fr", None),
         ("de", "Das Zimmer war sauber 123 _ groß"), (None, "kein Etikett"), ("xx", "... 42")]


@pytest.mark.parametrize("size", [2, 3, 4])
def test_scores_equal_brute_force(spark, size):
    model = LM.train(spark.createDataFrame(TRAIN, "lang string, text string"), size=size)
    texts = ["the clean room", "Très gentil", "GROẞ sauber", "zzz qqq", "the the the THE", "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, comments string")
    got = {}
    for r in LM.scores(docs, model, size=size).collect():
        got.setdefault(r["id"], {})[r["lang"]] = r["score"]
    for i, t in enumerate(texts):
        want = _brute(TRAIN, t, size) if _grams(t, size) else None
        assert got.get(i) == (None if want is None else pytest.approx(want, rel=1e-9))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    train, held = M.hash_split(docs.select("doc_id", "lang", "text"), "doc_id")
    found = LM.identify(held, LM.train(train), "doc_id", "text")
    right = held.join(found.withColumnRenamed("lang", "found"), "doc_id") \
        .agg(F.avg((F.col("lang") == F.col("found")).cast("double"))).first()[0]
    assert right > 0.99


def test_nulls_blanks_ties_and_repeated_ids(spark):
    model = LM.train(spark.createDataFrame(TRAIN, "lang string, text string"))
    rows = [(1, None), (2, ""), (3, " 12 ... _"), (4, "the room"), (4, "the room"), (None, "propre"),
            (2 ** 60 + 1, "sauber")]
    got = {r["id"]: r["lang"] for r in LM.identify(
        spark.createDataFrame(rows, "id long, comments string"), model).collect()}
    assert got == {1: "und", 2: "und", 3: "und", 4: "en", None: "fr", 2 ** 60 + 1: "de"}
    even = LM.train(spark.createDataFrame([("b", "same"), ("a", "same")], "lang string, text string"))
    tie = LM.identify(spark.createDataFrame([(1, "same")], "id long, comments string"), even)
    assert tie.first()["lang"] == "a"


def test_empty_tables_and_long_texts(spark):
    labelled = spark.createDataFrame(TRAIN, "lang string, text string")
    docs = spark.createDataFrame([(1, "the room " * 200_000), (2, "é" * 300_000)],
                                 "id long, comments string")
    model = LM.train(labelled)
    assert LM.identify(docs.limit(0), model).count() == 0
    assert {r["id"]: r["lang"] for r in LM.identify(docs, model).collect()}[1] == "en"
    none = LM.train(labelled.limit(0))
    assert {r["lang"] for r in LM.identify(docs, none).collect()} == {"und"}


def test_scoring_sums_per_text_without_the_gram_as_key(spark):
    """A text's grams meet one model row each, with the gains of all languages."""
    docs = spark.createDataFrame([(1, "en", "the cat sat"), (2, "fr", "le chat dort")],
                                 "id long, lang string, comments string")
    model = LM.train(docs, "comments")
    plan = LM.scores(docs, model)._jdf.queryExecution().optimizedPlan().toString()
    keys = [x.split("[")[1].split("]")[0] for x in plan.splitlines() if "Aggregate [" in x]
    assert not any("id#" in k and "gram#" in k for k in keys)
    assert plan.count("Join ") == 1


def test_texts_and_words_are_cut_once(spark):
    """No filter before an explode cuts texts or words a second time."""
    docs = spark.createDataFrame([(1, "en", "the cat sat"), (2, "fr", "le chat dort")],
                                 "id long, lang string, comments string")
    model = LM.train(docs, "comments")
    for df in (LM.scores(docs, model), LM.gram_counts(docs, "lang", "comments")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all(lower(") == 1 and plan.count("(?=(") == 1
        assert not any("Filter" in x and ("regexp" in x or "split(" in x) for x in plan.splitlines())


def test_grams_are_code_points_between_blanks(spark):
    docs = spark.createDataFrame([("a", "\U0001d400b, b́ x7x"), ("b", "12 ..."), ("c", None)],
                                 "k string, text string")
    got = {(r["k"], r["gram"]): r["n"] for r in LM.gram_counts(docs, "k", "text").collect()}
    assert got == {("a", " \U0001d400b"): 1, ("a", "\U0001d400b "): 1, ("a", " b́"): 1,
                   ("a", "b́ "): 1, ("a", " x "): 2, ("a", ""): 6}
    wide = LM.gram_counts(docs, "k", "text", 4).collect()
    assert {(r["k"], r["gram"], r["n"]) for r in wide} == {
        ("a", " \U0001d400b ", 1), ("a", " b́ ", 1), ("a", "", 2)}
