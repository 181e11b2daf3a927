"""Induced noun lemmas: counts by hand, held-out words, chance pairs, odd input."""

from lodgeframe.operators import paradigms as P

# Nouns with their plurals.
NOUNS = {
    "room": "rooms", "bedroom": "bedrooms", "bathroom": "bathrooms", "mushroom": "mushrooms",
    "key": "keys", "monkey": "monkeys", "donkey": "donkeys", "turkey": "turkeys",
    "window": "windows", "pillow": "pillows", "meadow": "meadows", "shadow": "shadows",
    "city": "cities", "party": "parties", "beauty": "beauties", "charity": "charities",
    "deputy": "deputies", "county": "counties", "property": "properties",
    "beach": "beaches", "coach": "coaches", "peach": "peaches", "match": "matches", "church": "churches",
    "glass": "glasses", "dress": "dresses", "boss": "bosses", "class": "classes", "address": "addresses",
    "walk": "walks", "desk": "desks", "task": "tasks", "risk": "risks", "mask": "masks",
    "woman": "women", "fireman": "firemen", "postman": "postmen", "human": "humans",
    "dish": "dishes", "wish": "wishes", "fish": "fishes",
    "knife": "knives", "wife": "wives", "life": "lives", "midwife": "midwives",
}
# Words that end like plurals and are none.
OTHERS = ("this", "his", "hi", "was", "bus", "gas", "thus", "perhaps", "always", "less", "us", "is",
          "plus", "focus", "virus", "bonus", "men", "omen", "yes", "series", "the", "and", "very")


def _words(spark, words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def _lemmas(spark, words, **kw):
    return {r["word"]: r["lemma"] for r in P.induced_lemmas(_words(spark, words), **kw).collect()}


def test_lemmas_without_a_list(spark):
    got = _lemmas(spark, [*NOUNS, *NOUNS.values(), *OTHERS])
    right = {p: s for s, p in NOUNS.items()}
    wrong = {w: x for w, x in got.items() if right.get(w) != x}
    assert not wrong
    assert len(got) >= 0.9 * len(right)
    assert {got["cities"], got["beaches"], got["women"], got["knives"]} == {
        "city", "beach", "woman", "knife"}


def test_held_out_lemmas_by_productive_paradigms(spark):
    held_out = {"mushroom", "donkey", "meadow", "beauty", "property", "peach", "address", "mask"}
    got = _lemmas(spark, [*(set(NOUNS) - held_out), *NOUNS.values(), *OTHERS], productive=60)
    found = {NOUNS[w]: w for w in held_out if NOUNS[w] in got}
    assert all(got[p] == w for p, w in found.items()) and len(found) >= 6
    seen = {r["word"]: r["seen"] for r in P.induced_lemmas(
        _words(spark, [*(set(NOUNS) - held_out), *NOUNS.values()]), productive=60).collect()}
    assert not any(seen[p] for p in found) and seen["rooms"]
    strict = _lemmas(spark, [*(set(NOUNS) - held_out), *NOUNS.values()], productive=101)
    assert not set(found) & set(strict)


def test_paradigm_counts(spark):
    rows = P.paradigms(_words(spark, ["room", "rooms", "rooms", None, "broom", "brooms", "dooms"])).collect()
    assert {(r["rule"], r["ending"]): (r["tries"], r["support"]) for r in rows} == {
        ("s>", "om"): (3, 2)}


def test_vocabulary_reads_whole_texts(spark):
    docs = spark.createDataFrame([("Rooms, rooms! x2 été",), (None,), ("",), ("word " * 50_000 + "Last",)],
                                 "text string")
    got = {r["word"]: r["n"] for r in P.vocabulary(docs).collect()}
    assert got == {"rooms": 2, "x": 1, "t": 1, "word": 50_000, "last": 1}


def test_empty_vocabulary(spark):
    assert _lemmas(spark, []) == {} and _lemmas(spark, [None, "", "s", "es"]) == {}
