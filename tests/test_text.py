"""Review pipeline: stop words before punctuation, lemmas, language vote, score range."""

from lodgeframe.operators import text as TX


def test_stop_word_survives_with_punctuation(spark):
    docs = spark.createDataFrame([(1, "the, dog. the cats")], "id long, comments string")
    toks = TX.clean_tokens(docs, TX.stop_words_table(spark), TX.lemma_table(spark))
    got = [r["token"] for r in toks.orderBy("pos").collect()]
    assert got == ["the", "dog", "cats"]


def test_joined_tokens_in_order(spark):
    docs = spark.createDataFrame([(1, "z y x w v u t s r q p o n m l k")],
                                 "id long, comments string")
    toks = TX.tokens(docs)
    assert TX.joined_tokens(toks).first()["text"] == "z y x w v u t s r q p o n m l k"


def test_language_vote_and_tie(spark):
    docs = spark.createDataFrame([(1, "The cat and the dog"), (2, "der Hund und die Katze"),
                                  (3, "de la"), (4, "zzz")], "id long, comments string")
    got = {r["id"]: r["lang"] for r in
           TX.detect_language(docs, TX.lang_words_table(spark)).collect()}
    assert got == {1: "en", 2: "de", 3: "es", 4: "und"}  # 'de la' ties fr/es -> smaller code


def test_review_scores(spark):
    rev = spark.createDataFrame(
        [(1, 10, 100, "Best stay, worthless host", "en"), (2, 10, 101, None, "en"),
         (3, 11, 100, "This is an automated posting.", "en"), (4, 12, 102, "best", "fr"),
         (5, 12, 103, "Great<br/>stay nothing", "en")],
        "id long, listing_id long, reviewer_id long, comments string, lang string")
    out = {r["id"]: r for r in TX.review_scores(rev, TX.stop_words_table(spark),
                                                 TX.lemma_table(spark),
                                                 TX.lexicon_table(spark)).collect()}
    assert set(out) == {1, 5}
    assert abs(out[1]["score"] - 2.75) < 1e-12  # mean of best (1.0) and worthless (-0.8)
    assert out[5]["score"] == 2.5 and out[5]["comments"] == "greatstay nothing"
    assert all(0.0 <= r["score"] <= 5.0 for r in out.values())


def test_user_dictionary_goes_through_size_check(spark):
    rev = spark.createDataFrame([(1, 10, 100, "lovely calm flat", "en")],
                                "id long, listing_id long, reviewer_id long, comments string, "
                                "lang string")
    lexicon = spark.createDataFrame([("calm", 0.6), ("flat", -0.2)],
                                    "word string, polarity double")
    assert getattr(lexicon, "_known_rows", None) is None
    out = TX.review_scores(rev, TX.stop_words_table(spark), TX.lemma_table(spark),
                           lexicon).first()
    assert abs(out["score"] - (0.2 + 1) * 2.5) < 1e-12


def test_noun_forms_follow_the_vocabulary(spark):
    nouns = spark.createDataFrame([(w,) for w in ("city", "day", "man", "box", "bus", "bu", "s")],
                                  "word string")
    got = {r["word"]: r["lemma"] for r in TX.noun_forms(nouns).collect()}
    assert got == {"citys": "city", "cities": "city", "days": "day", "mans": "man", "men": "man",
                   "boxs": "box", "boxes": "box", "buss": "bus", "buses": "bus", "ss": "s",
                   "ses": "s"}
    table = {r["word"]: r["lemma"] for r in TX.lemma_table(spark).collect()}
    assert table["rooms"] == "room" and table["families"] == "family" and table["women"] == "woman"
    assert table["was"] == "wa" and "glas" not in table


def test_negation_turns_the_next_word(spark):
    rev = spark.createDataFrame([(1, 1, 1, "good", "en"), (2, 1, 1, "not, good", "en"),
                                 (3, 1, 1, "not a good", "en"), (4, 1, 1, "never dirty good", "en")],
                                "id long, listing_id long, reviewer_id long, comments string, lang string")

    def run(negation):
        out = TX.review_scores(rev, TX.stop_words_table(spark), TX.lemma_table(spark),
                               TX.lexicon_table(spark), negation=negation)
        return {r["id"]: round(r["score"], 6) for r in out.collect()}
    plain, turned = run(False), run(True)
    assert plain[1] == plain[2] == plain[3] == turned[1] == turned[3] == 4.25
    assert turned[2] == 2.5 * (1 - 0.35) and turned[4] == round(2.5 * (1 + (0.3 + 0.7) / 2), 6)


def test_building_a_review_plan_needs_no_rows(spark):
    empty = spark.createDataFrame([], "id long, comments string")
    assert TX.detect_language(empty, TX.lang_words_table(spark)).count() == 0
    blank = spark.createDataFrame([(1, "  "), (2, "...")], "id long, comments string")
    got = {r["id"]: r["lang"] for r in TX.detect_language(blank, TX.lang_words_table(spark)).collect()}
    assert got == {1: "und", 2: "und"}
