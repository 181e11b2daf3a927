"""Rules, PII, licences, line dedup and mixing against brute force and awkward inputs."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lodgeframe.llm import licenses, lines, mixing, pii, rules
from llm.helpers import DOCS, awkward, doc_frame, words

SF = "/root/testdata/sf0.001"


def brute_counts(t):
    t = t or ""
    w = words(t)
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i:i + 3])].append(i)
    covered = {i + k for p in at.values() if len(p) > 1 for i in p for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered))


def test_rule_counts_match_brute_force(spark):
    texts = ["a b c a b c", "x x x x x", "a b\na b\n\na b", "# $ | <p>", "", None, "a",
             "a b c d a b c e b c d", "\x0b\x0c one\rtwo", "é ü ß 𝒳"]
    got = rules.apply_rules(doc_frame(spark, texts)).orderBy("doc_id").collect()
    for t, r in zip(texts, got):
        assert brute_counts(t) == (r["n_words"], r["word_chars"], r["n_symbols"],
                                   r["n_dup_lines"], r["n_repeat_words"]), t


def test_lines_fail_on_their_own_and_documents_on_loss(spark):
    good = " ".join(f"word{i}" for i in range(60)) + "."
    nav = "Home | About | Contact | Login"
    last = " ".join(f"other{i}" for i in range(60)) + "!"
    texts = ["\n".join([good, nav, "privacy policy", "short line without stop", last]),
             "\n".join([nav + " | " + " ".join(f"v{i}" for i in range(80))] * 1 + ["Fine words."])]
    one, two = rules.apply_rules(doc_frame(spark, texts)).orderBy("doc_id").collect()
    assert one["kept"] and one["clean_text"] == good + "\n" + last
    assert not two["base_failed"] and not two["kept"] and two["clean_text"] == "Fine words."


def test_rules_on_awkward_rows(spark):
    got = rules.apply_rules(awkward(spark)).collect()
    assert len(got) == 8
    for r in got:
        if r["doc_id"] in (2, 3, 4):
            assert (r["n_words"], r["kept"], r["clean_text"]) == (0, False, "")
    assert rules.apply_rules(spark.createDataFrame([], DOCS)).count() == 0


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(t):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, t or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "card": 13 <= len(d) <= 19 and luhn(d),
                  "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                  "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TRICKY = ["a@b.c_d@e.f x", "a@b c.d@e.f.", "é𝒳 me.you@x-y.co.uk,", "1.2.3.4.5 256.1.1.1 0300.1.2.3",
          "10.0.0.1 and 001.002.003.004", "4111 1111 1111 1111", "4111-1111-1111-1112",
          "12 34 " * 30, "+1 (980) 555-2833 +49.30.123456- +1 2", "x" * 500 + "@" + "y" * 500,
          "a@b..c a@-.- @b.c", "+1234567890123456 +123456789", "5555555555554444 card",
          "1" * 5000, "a." * 3000 + "@b", None, "", "00000000000000"]


def test_navigation_is_judged_by_a_line_s_length(spark):
    prose = " ".join(f"word{i}" for i in range(120))
    texts = [f"{prose} • one • two • three {{x}} end.", "Home | News | Sport | Mail ends here so.",
             "A short line of ten words or more with { a brace.", f"{prose} {'| ' * 9}end."]
    got = rules.apply_rules(doc_frame(spark, texts)).orderBy("doc_id").collect()
    assert [r["clean_text"] != "" for r in got] == [True, False, False, False]


def test_base_spans_match_brute_force(spark):
    got = pii.digest(pii.find(doc_frame(spark, TRICKY))).orderBy("doc_id").collect()
    for t, r in zip(TRICKY, got):
        want = base_spans(t)
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert set(want) <= set(r["spans"].split(","))
        for k in BASE:
            assert r[f"n_{k}"] == sum(x.startswith(k + ":") for x in want)


def test_base_spans_on_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in pii.digest(pii.find(docs)).collect():
        want = base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()


def test_added_spans_need_evidence(spark):
    texts = ["write me: jane [at] site [dot] org"] * 3 + ["call 555-123-4567 today"] * 3 + \
        ["order 555-123-4567x"] * 3 + ["plain words"] * 3
    got = pii.find(doc_frame(spark, texts)).collect()
    kinds = [[s["kind"] for s in r["spans"]] for r in sorted(got, key=lambda r: r["doc_id"])]
    assert kinds[9:] == [[]] * 3 and all("local_phone" not in k for k in kinds[6:9])


def test_em_recovers_reliabilities():
    """Patterns of a group where four labelers agree: the odd voter does not decide."""
    rows = [("phone", (1, 1, 1, 0, 1), 80), ("phone", (-1, -1, -1, 0, -1), 80),
            ("phone", (1, 1, 1, 0, -1), 10), ("phone", (-1, -1, -1, 0, 1), 10)]
    post = pii.reliabilities(rows)
    assert post["phone", (1, 1, 1, 0, -1)] > 0.9 and post["phone", (-1, -1, -1, 0, 1)] < 0.1


def test_added_spans_do_not_depend_on_corpus_size(spark):
    """A mixture and 1,000 times that mixture get the same spans added, cued ones among them."""
    texts = ["+1 212 555 0100"] * 10 + ["call 555-867-5309 today"] * 3 + \
        ["so 555-867-5309 it is"] * 6 + ["jane.doe@site.org"] * 10 + \
        ["write to jane [at] site [dot] org"] * 3 + ["order 555-867-5309x"] * 2 + \
        ["account 998877665544 please"] * 2 + ["the 998877665544 of them"] * 5
    want = {"call": "local_phone:5:17", "write": "spoken_email:9:33", "account": "account:8:20"}
    docs = doc_frame(spark, texts)
    for many in (docs, docs.crossJoin(spark.range(1000).select())):
        got = pii.digest(pii.find(many)).groupBy("doc_id", "spans").count().collect()
        assert len(got) == len(texts)
        for r in got:
            first = texts[r["doc_id"] - 1].split(" ")[0]
            assert first[0] == "+" or "@" in first or r["spans"] == want.get(first, ""), r


def test_a_positive_cue_never_speaks_against_a_span():
    """Spans with a cue are far outnumbered by other spans, and most of them touch a letter."""
    for n in (1, 1000):
        rows = [("local_phone", (0, 0, 0, 1), 3 * n), ("local_phone", (0, 0, 0, 0), 60_000 * n),
                ("local_phone", (-1, 0, 0, 1), 300 * n), ("local_phone", (-1, 0, -1, -1), 9_000 * n)]
        post = pii.reliabilities(rows)
        assert post["local_phone", (0, 0, 0, 1)] > 0.5 > post["local_phone", (0, 0, 0, 0)]
        assert post["local_phone", (-1, 0, 0, 1)] > post["local_phone", (-1, 0, -1, -1)]
    weight, _ = pii.weights([("account", "name=account", 4.0, 6.0), ("account", "cue=1", 0.2, 0.8),
                             ("account", "cue=0", 3.0, 2.0), ("account", "cue=-1", 0.8, 3.2)])
    assert weight["account|cue=1"] >= weight["account|cue=0"] > 0 > weight["account|cue=-1"]


def test_pii_on_awkward_rows(spark):
    assert pii.digest(pii.find(awkward(spark))).count() == 8
    assert pii.digest(pii.find(spark.createDataFrame([], DOCS))).count() == 0


MIT = licenses.SENTENCES


def test_licence_rules_need_order(spark):
    full = ". ".join(MIT[k].capitalize() for k in
                     ("mit_grant", "mit_keep", "mit_warranty", "mit_liability")) + "."
    wrapped = "Redistribution and use in source and binary forms, with or without\nmodification, " \
        "are permitted provided that the following conditions are met:\n"
    texts = [full, ". ".join([MIT["mit_keep"], MIT["mit_grant"]]) + ".", wrapped,
             "Some words.\nReleased under the MIT License.\nMore. Licensed under CC BY-NC 4.0.",
             "This work is licensed under the GNU General Public License, version 3.", None, "",
             "released under the mit license agreement", "license"]
    got = licenses.scan(doc_frame(spark, texts)).orderBy("doc_id").collect()
    assert [r["licenses"] for r in got] == [
        ["MIT"], [], [], ["CC-BY-NC-4.0", "MIT"], ["GPL-3.0"], [], [], [], []]
    assert got[2]["sentences"] == ["bsd_grant"] and got[1]["sentences"] == ["mit_grant", "mit_keep"]


def test_known_sentences_are_found_whatever_parts_their_words(spark):
    assert re.fullmatch("[a-z0-9|]+", licenses.STEMS)
    texts, want = [], []
    for name, text in (("CC0-1.0", "Released into the public domain under CC0 1.0."), ("Unlicense",
                       "This is free and unencumbered software released into the public domain.")):
        parts = text.split(" ")
        for gap in ("\n", "-", "\u00a0", "  ", "\n# "):
            texts += [" ".join(parts[:i]) + gap + " ".join(parts[i:]) for i in range(1, len(parts))]
        want += [[name]] * (len(texts) - len(want))
    got = licenses.scan(doc_frame(spark, texts)).orderBy("doc_id").collect()
    assert [r["licenses"] for r in got] == want


GNU_NOTICE = """{} is free software{} you can redistribute it and/or modify
it under the terms of the GNU {} Public License as published by
the Free Software Foundation{} {}"""
LATER = "either version {} of the License, or\n(at your option) any later version."
STANDARD = [
    (GNU_NOTICE.format("This program", ":", "General", ",", LATER.format(3)), "GPL-3.0-or-later"),
    (GNU_NOTICE.format("Foo", ";", "General", ";", LATER.format(2)), "GPL-2.0-or-later"),
    (GNU_NOTICE.format("This file", ";", "General", ";", "either version 2, or (at your option)\n"
                       "any later version."), "GPL-2.0-or-later"),
    (GNU_NOTICE.format("This program", ":", "General", ",", "version 3."), "GPL-3.0-only"),
    (GNU_NOTICE.format("This program", ";", "General", ";", "version 2 of the License."),
     "GPL-2.0-only"),
    ("This program is free software; you can redistribute it and/or modify it\nunder the terms of "
     "version 2 of the GNU General Public License as\npublished by the Free Software Foundation.",
     "GPL-2.0-only"),
    (GNU_NOTICE.format("This library", ";", "Lesser General", ";", LATER.format("2.1")),
     "LGPL-2.1-or-later"),
    (GNU_NOTICE.format("This library", ";", "Library General", ";", LATER.format("2")),
     "LGPL-2.0-or-later"),
    (GNU_NOTICE.format("This program", ":", "Lesser General", ",", "version 3 of the License."),
     "LGPL-3.0-only"),
    (GNU_NOTICE.format("This program", ":", "Affero General", ",", LATER.format(3)),
     "AGPL-3.0-or-later"),
    ("Licensed under the GNU General Public License v3 or later.", "GPL-3.0-or-later"),
    ("  GNU GENERAL PUBLIC LICENSE\n     Version 2, June 1991\n\n Copyright (C) 1989",
     "GPL-2.0"),
    ("GNU AFFERO GENERAL PUBLIC LICENSE\n  Version 3, 19 November 2007\n\nPreamble", "AGPL-3.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
     "License.", "CC-BY-SA-4.0"),
    ("This work is licensed under the Creative Commons Attribution-NonCommercial-NoDerivs 3.0\n"
     "Unported License.", "CC-BY-NC-ND-3.0"),
    ("Licensed under the Creative Commons Attribution 2.5 License.", "CC-BY-2.5"),
    ("Attribution-NonCommercial-ShareAlike 4.0 International\n\n=====", "CC-BY-NC-SA-4.0"),
    ("Creative Commons Attribution-NoDerivatives 4.0 International Public License\n\nBy",
     "CC-BY-ND-4.0"),
    ("Apache License\n  Version 2.0, January 2004\n  http://www.apache.org/licenses/\n\nTERMS",
     "Apache-2.0"),
    ("Mozilla Public License Version 2.0\n======\n\n1. Definitions", "MPL-2.0"),
]


def test_standard_notices_and_titles_are_known(spark):
    """Plain, behind a comment prefix and after other text; the SQL twin agrees."""
    duckdb = pytest.importorskip("duckdb")
    from lodgeframe.llm.oracle import oracle_sql
    texts = [x for t, _ in STANDARD for x in (
        t, "# " + re.sub(r"(?<!\n)\n(?!\n)", "\n# ", t), f"Some words.\n\n{t}\n\nMore.")]
    got = licenses.scan(doc_frame(spark, texts)).orderBy("doc_id").collect()
    assert [r["licenses"] for r in got] == [[n] for _, n in STANDARD for _ in range(3)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts, 1)))
    assert sorted(con.execute(oracle_sql()["op7_license_rules"]).fetchall()) == [
        (r["doc_id"], ",".join(r["sentences"]), ",".join(r["licenses"])) for r in got]
    assert len(set(licenses.SENTENCES.values())) == len(licenses.SENTENCES)
    assert len({ids for _, ids in licenses.RULES}) == len(set(licenses.RULES))


def test_licence_tables_are_sound(spark):
    for s in licenses.SENTENCES.values():
        assert re.search(licenses.STEMS, s), s
        assert s == re.sub("[^a-z0-9]+", " ", s).strip()
    assert all(i in licenses.SENTENCES for _, ids in licenses.RULES for i in ids)
    assert licenses.scan(awkward(spark)).count() == 8
    assert licenses.scan(spark.createDataFrame([], DOCS)).count() == 0


def brute_lines(rows, min_sites):
    """rows: (doc_id, text, source). Returns the cleaned texts."""
    sites, first = defaultdict(set), {}
    for d, t, s in rows:
        for i, line in enumerate((t or "").split("\n")):
            x = line.strip(" \t\n\x0b\x0c\r")
            if x:
                sites[x].add(s)
                key = (d is not None, d if d is not None else 0, i)
                first[x] = min(first.get(x, key), key)
    out = []
    for d, t, s in rows:
        if t is None:
            out.append(None)
            continue
        kept = []
        for i, line in enumerate(t.split("\n")):
            x = line.strip(" \t\n\x0b\x0c\r")
            if x and len(sites[x]) >= min_sites and \
                    first[x] != (d is not None, d if d is not None else 0, i):
                continue
            kept.append(line)
        out.append("\n".join(kept))
    return out


@pytest.mark.parametrize("min_sites", [1, 2, 3])
def test_line_spread_matches_brute_force(spark, min_sites):
    rows = [(1, "head\n body 1\nfoot", "a"), (2, "head\nbody 2\nfoot", "b"),
            (3, "head\t\nbody 3\n\nfoot\nfoot", "c"), (4, "body 1\nbody 1", None),
            (None, "head\nalone", "d"), (5, None, "e"), (6, "", "a"), (2, "head\nbody 2\nfoot", "b")]
    docs = spark.createDataFrame([(d, t, "en", s, 0, 9) for d, t, s in rows],
                                 DOCS + ", lines_removed int")
    got = lines.dedup_lines(docs, min_sites=min_sites)
    assert got.columns == docs.columns + ["lines_total"]
    key = lambda x: (str(x[0]), str(x[1]))
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=key) == \
        sorted(zip([r[0] for r in rows], brute_lines(rows, min_sites)), key=key)


def test_near_threshold_lines_are_counted_exactly(spark):
    rows = [(i, "wide", f"s{i}") for i in range(300)] + \
        [(1000 + i, "narrow", f"s{i}") for i in range(299)]
    docs = spark.createDataFrame([(d, t, "en", s, 0) for d, t, s in rows], DOCS)
    got = lines.dedup_lines(docs, min_sites=300, lg_k=8, band=0.5)
    removed = {r["doc_id"] for r in got.collect() if r["lines_removed"]}
    assert removed == set(range(1, 300))
    assert lines.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


def brute_targets(sizes, weights, budget, cap):
    """Refill by weight until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = budget * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s] + 1e-9]
        if not over:
            return {**capped, **share}
        capped |= {s: cap * sizes[s] for s in over}


def test_mixing_meets_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r.asDict() for r in mixing.mix(docs).collect()]
    sizes = defaultdict(int)
    taken = defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert sum(c["words"] for c in r["copies"]) == r["taken"]
    want = brute_targets(sizes, (5, 2, 1), 1.5, 2)
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and \
            r["source_size"] == sizes[r["source"]]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    again = {(r["doc_id"], r["taken"], r["position"]) for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {(r["doc_id"], r["taken"], r["position"]) for r in got}
    positions = [r["position"] for r in got if r["position"] is not None]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1


def test_schedule_inverse(spark):
    plan = mixing.Curriculum()
    for k in (0.0, 0.8, -0.8, 1.0, -1.0):
        t = spark.range(11).select((F.col("id") / 10).alias("t"))
        back = t.select("t", plan.when(F.col("t") + k * (F.col("t") * F.col("t") - F.col("t")),
                                       F.lit(k)).alias("b")).collect()
        assert all(abs(r["t"] - r["b"]) < 1e-9 for r in back)


def test_mixing_awkward_rows(spark):
    docs = awkward(spark)
    got = mixing.mix(docs).collect()
    assert len(got) == 8
    null_source = [r for r in got if r["source"] is None]
    assert {r["size"] for r in null_source} == {0, 5}
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns
    assert sum(len(words(r["text"])) for r in copies.collect()) == sum(r["taken"] for r in got)
    empty = spark.createDataFrame([], DOCS)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
