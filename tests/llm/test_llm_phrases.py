"""Phrase mining against a plain count over all texts."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from lodgeframe.llm import oracle, phrases
from llm.helpers import DOCS, awkward, doc_frame

SF = "/root/testdata/sf0.001"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, longest=3, least=10, top=2000):
    """rows: (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    upper = {c: c + 32 for c in range(65, 91)}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(upper)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, b in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * b >= 50 * counts[p[i:i + k]]:
                        covered.add(p[i:i + k])
        best = []
        for p, a in cand.items():
            if p not in covered:
                score, _, l, r = min((1_000_000 * a * a // (counts[p[:j]] * counts[p[j:]]), j,
                                      counts[p[:j]], counts[p[j:]]) for j in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def got(df):
    assert df.columns == COLUMNS
    assert {t for c, t in df.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    return sorted(map(tuple, df.collect()))


def texts(seed, n=300):
    rng = random.Random(seed)
    words = ["New", "york", "the", "city", "of", "ÉTÉ", "Zürich", "a-b", "x"] + [f"w{i}" for i in range(40)]
    marks = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "; ", "\n", "\r\n", "!? ", ":", "\x0b", "\x1f "]
    out = []
    for _ in range(n):
        t = ""
        for _ in range(rng.randint(0, 60)):
            t += rng.choice(["New York City", "the city of Zürich", *[rng.choice(words)] * 4])
            t += rng.choice(marks)
        out.append(t)
    return out


@pytest.mark.parametrize("longest,block", [(3, 16_000_000), (3, 200), (2, 16_000_000), (4, 500)])
def test_phrases_match_brute_force(spark, monkeypatch, longest, block):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", block)
    monkeypatch.setattr(phrases, "SENT_ROWS", 50)
    rows = [(random.Random(i).choice(["en", "de", None, "und"]), t) for i, t in enumerate(texts(1))]
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], DOCS)
    want = brute(rows, longest)
    assert len(want) > 20
    assert got(phrases.collocations(docs, longest=longest)) == want


def test_phrases_on_the_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r["lang"], r["text"]) for r in docs.collect()])
    assert got(phrases.collocations(docs)) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    sql = con.sql(oracle.OP13_SETM_PHRASES)
    assert sorted(sql.columns) == sorted(COLUMNS)
    assert sorted(sql.select(*COLUMNS).fetchall()) == want


def test_phrases_keep_the_first_of_each_language(spark):
    rows = [("en", t) for t in texts(2)]
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], DOCS)
    assert got(phrases.collocations(docs, top=7)) == brute(rows, top=7)


def test_phrases_awkward_rows(spark):
    docs = awkward(spark).select("*", F.lit(1).alias("phrase"), F.lit(2).alias("f"),
                                 F.lit(3).alias("block"), F.lit(4).alias("ids"))
    assert got(phrases.collocations(docs)) == brute([("en", r["text"]) for r in docs.collect()])
    assert got(phrases.collocations(spark.createDataFrame([], DOCS))) == []
    one = doc_frame(spark, ["same same " * 200_000, None, "", " . ! "])
    assert got(phrases.collocations(one)) == brute([("en", "same same " * 200_000)])


def test_scores_pass_64_bits(spark):
    big = 3 * 10 ** 12
    found = [spark.createDataFrame([("en", "a", big), ("en", "b", big - 1)], "lang string, phrase string, f long"),
             spark.createDataFrame([("en", "a b", big - 7)], "lang string, phrase string, f long")]
    r = phrases.scored(found).first()
    assert r["score"] == 10 ** 6 * (big - 7) ** 2 // (big * (big - 1))


def test_longer_phrases_learn_their_counts_without_a_join(spark):
    """Rows of frequent phrases get sum and number in one exchange, and no row twice."""
    groups = spark.createDataFrame(
        [(1, 2, 7, 0, 6), (1, 2, 8, 3, 5), (1, 3, 7, 1, 9), (2, 1, 9, 0, 10)],
        "p long, q long, block long, g int, n long")
    found = phrases.frequent_rows(groups, 10)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan
    rows = found.collect()
    assert sorted((r["block"], r["g"]) for r in rows) == [(7, 0), (8, 3), (9, 0)]
    assert len({r["id"] for r in rows}) == 2
    assert len({r["id"] for r in rows if r["block"] < 9}) == 1
    assert sorted((r["p"], r["q"], r["f"]) for r in rows if r["f"] is not None) == [(1, 2, 11), (2, 1, 10)]
