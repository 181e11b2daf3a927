"""Spread lexicon against brute force and its fixed point; scopes of degree words by hand."""

from collections import Counter

import numpy as np
import pytest

from lodgeframe.operators import polarity as P

TEXTS = ["Lovely room, lovely view!", "the room was dirty and noisy", "noisy street; dirty street",
         "sunny view sunny balcony", "view of street", None, "", "alone", "...", "room room room"]
SEEDS = [("lovely", 0.5), ("dirty", -0.6), ("absent", 0.3), (None, 1.0), ("gap", None)]


def _edges():
    stops = set(P.ENGLISH_STOP_WORDS)
    out = Counter()
    for t in TEXTS:
        w = ["".join(c for c in x if c.isalnum()) for x in (t or "").lower().split()]
        w = [x for x in w if x and x not in stops]
        for a, b in zip(w, w[1:]):
            if a != b:
                out[a, b] += 1
                out[b, a] += 1
    return out


@pytest.fixture(scope="module")
def edges(spark):
    return P.neighbours(spark.createDataFrame([(t,) for t in TEXTS], "text string"))


def _seeds(spark, rows=SEEDS):
    return spark.createDataFrame(rows, "word string, polarity double")


def _brute(steps):
    e, fixed = _edges(), {"lovely": 0.5, "dirty": -0.6, "absent": 0.3}
    known = dict(fixed)
    for _ in range(steps):
        step = {}
        for w in {a for a, _ in e} - set(fixed):
            near = [(b, n) for (a, b), n in e.items() if a == w]
            step[w] = sum(n * known.get(b, 0.0) for b, n in near) / sum(n for _, n in near)
        known = {**fixed, **step}
    return known


def test_neighbours(edges):
    assert {(r["word"], r["other"]): r["n"] for r in edges.collect()} == dict(_edges())


@pytest.mark.parametrize("steps", [1, 3])
def test_spread_equals_brute_force(spark, edges, steps):
    got = {r["word"]: (r["polarity"], r["seed"]) for r in P.spread(edges, _seeds(spark), steps).collect()}
    want = _brute(steps)
    assert set(got) == set(want)
    assert all(got[w][0] == pytest.approx(want[w], abs=1e-9) for w in want)
    assert {w for w in got if got[w][1]} == {"lovely", "dirty", "absent"}


def test_spread_comes_to_its_fixed_point(spark, edges):
    got = {r["word"]: r["polarity"] for r in P.spread(edges, _seeds(spark), 40).collect()}
    e, fixed = _edges(), {"lovely": 0.5, "dirty": -0.6}
    free = sorted({a for a, _ in e} - set(fixed))
    at = {w: i for i, w in enumerate(free)}
    m, b = np.eye(len(free)), np.zeros(len(free))
    for w in free:
        total = sum(n for (x, _), n in e.items() if x == w)
        for (x, y), n in e.items():
            if x == w and y in at:
                m[at[w], at[y]] -= n / total
            elif x == w:
                b[at[w]] += n / total * fixed[y]
    exact = np.linalg.solve(m, b)
    assert all(got[w] == pytest.approx(exact[at[w]], abs=1e-3) for w in free)
    assert got["noisy"] < 0 < got["sunny"]


def test_spread_without_seeds_or_edges(spark, edges):
    none = P.spread(edges, _seeds(spark, [])).collect()
    assert none and all(r["polarity"] == 0 and not r["seed"] for r in none)
    alone = P.spread(edges.limit(0), _seeds(spark, [("a", 0.2), ("a", 0.4)])).collect()
    assert [(r["word"], r["polarity"], r["seed"]) for r in alone] == [("a", pytest.approx(0.3), True)]


def test_scopes(spark):
    docs = spark.createDataFrame(list(enumerate([
        "good", "very good", "not good", "not very good", "very very good", "Not, really: good!",
        "slightly bad", "not", None, "", "very", "good very bad", "extremely great extremely great"])),
        "id long, comments string")
    lexicon = spark.createDataFrame([("good", 0.7), ("bad", -0.7), ("great", 0.8)],
                                    "word string, polarity double")
    toks = P.scoped_tokens(docs)
    got = {r["id"]: (round(r["polarity"], 6), r["words"])
           for r in P.scoped_polarity(toks, lexicon).collect()}
    assert got == {0: (0.7, 1), 1: (0.91, 1), 2: (-0.35, 1), 3: (round(-0.35 / 1.3, 6), 1),
                   4: (1.0, 1), 5: (round(-0.35 / 1.2, 6), 1), 6: (-0.35, 1),
                   11: (round((0.7 - 0.91) / 2, 6), 2), 12: (1.0, 2)}
    assert toks.count() == 25


def test_stop_words_are_looked_up_in_a_set(spark):
    """Texts of punctuation between words keep their words; no list is compared word by word."""
    docs = spark.createDataFrame([("A fine--day, - it's [the] `best` day\\^_{|}~!",), (None,), ("--",)],
                                 "text string")
    got = P.neighbours(docs)
    assert sorted((r["word"], r["other"], r["n"]) for r in got.where("word < other").collect()) == [
        ("best", "day", 1), ("best", "fineday", 1)]
    assert "array_contains" not in got._jdf.queryExecution().optimizedPlan().toString().lower()
