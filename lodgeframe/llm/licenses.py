"""Licence recognition by sentence rules.

A text is cut into sentences, each sentence is normalised (lower case, runs of other
characters to one blank) and mapped to the identifier of a known licence sentence. The
sequence of identifiers is then read from left to right against ordered licence rules,
longest first; unknown sentences between known ones do not matter. Texts are cut twice,
once at line ends too and once with wrapped lines joined, and the licences are united.

Every known sentence holds one of a few stems, each within one word: whatever parts the
words, a text without any stem has no known sentence and is not cut at all. Nothing is
shuffled.

Defined cases: a null, empty or blank text has no sentence and no licence; repeated rows
are judged alike; a sentence that is known but completes no rule is listed among the
sentences only; an empty table gives an empty result; input columns other than id and
text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A run of marks is read once: no match starts inside it.
SENTENCE_END = r"(?<![.!?;:])[.!?;:]++(?:[\x20\x09-\x0D]+|\z)"
BY_LINE = SENTENCE_END + r"|[\x0A-\x0D]"
WRAPPED = SENTENCE_END + r"|\x0A[\x20\x09\x0D]*\x0A"
STEMS = "licen|copyright|warrant|permission|redistribut|liab|unencumbered|cc0|option|attribution"

# Sentences of well-known licences and notices, normalised.
SENTENCES = {
    "mit_notice": "released under the mit license",
    "mit_notice_2": "licensed under the mit license",
    "mit_notice_3": "this project is licensed under the mit license",
    "mit_title": "the mit license mit",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this "
                 "software and associated documentation files the software to deal in the software "
                 "without restriction including without limitation the rights to use copy modify "
                 "merge publish distribute sublicense and or sell copies of the software and to "
                 "permit persons to whom the software is furnished to do so subject to the "
                 "following conditions",
    "mit_keep": "the above copyright notice and this permission notice shall be included in all copies "
                "or substantial portions of the software",
    "mit_warranty": "the software is provided as is without warranty of any kind express or implied "
                    "including but not limited to the warranties of merchantability fitness for a "
                    "particular purpose and noninfringement",
    "mit_liability": "in no event shall the authors or copyright holders be liable for any claim damages "
                     "or other liability whether in an action of contract tort or otherwise arising "
                     "from out of or in connection with the software or the use or other dealings in "
                     "the software",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or "
                 "without fee is hereby granted provided that the above copyright notice and this "
                 "permission notice appear in all copies",
    "isc_warranty": "the software is provided as is and the author disclaims all warranties with regard "
                    "to this software including all implied warranties of merchantability and fitness",
    "bsd_grant": "redistribution and use in source and binary forms with or without modification are "
                 "permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of "
                  "conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of "
                  "conditions and the following disclaimer in the documentation and or other materials "
                  "provided with the distribution",
    "bsd_endorse": "neither the name of the copyright holder nor the names of its contributors may be used "
                   "to endorse or promote products derived from this software without specific prior "
                   "written permission",
    "apache_notice": "licensed under the apache license version 2 0",
    "apache_header": "licensed under the apache license version 2 0 the license",
    "apache_use": "you may not use this file except in compliance with the license",
    "apache_copy": "you may obtain a copy of the license at",
    "apache_basis": "unless required by applicable law or agreed to in writing software distributed under "
                    "the license is distributed on an as is basis without warranties or conditions of any "
                    "kind either express or implied",
    "apache_title": "apache license version 2 0 january 2004",
    "apache_title_2": "apache license version 2 0 january 2004 http www apache org licenses",
    "mpl_notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl_title": "mozilla public license version 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc0_notice": "released into the public domain under cc0 1 0",
    "all_rights": "all rights reserved under copyright",
}
RULES = [
    ("MIT", ("mit_grant", "mit_keep", "mit_warranty", "mit_liability")),
    ("MIT", ("mit_grant", "mit_keep")),
    ("MIT", ("mit_notice",)), ("MIT", ("mit_notice_2",)), ("MIT", ("mit_notice_3",)),
    ("ISC", ("isc_grant", "isc_warranty")), ("ISC", ("isc_grant",)),
    ("BSD-3-Clause", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("Apache-2.0", ("apache_header", "apache_use", "apache_copy", "apache_basis")),
    ("Apache-2.0", ("apache_header", "apache_use")),
    ("Apache-2.0", ("apache_notice",)), ("Apache-2.0", ("apache_header",)),
    ("Apache-2.0", ("apache_title",)), ("Apache-2.0", ("apache_title_2",)),
    ("MPL-2.0", ("mpl_notice",)), ("MPL-2.0", ("mpl_title",)), ("Unlicense", ("unlicense",)), ("CC0-1.0", ("cc0_notice",)),
]


def _families() -> None:
    """Notices of the GNU and Creative Commons families, from their names and versions."""
    for short, name in (("GPL", "general"), ("LGPL", "lesser general"), ("AGPL", "affero general")):
        for v in ("2", "2.1", "3"):
            number = v.replace(".", " ")
            for k, form in enumerate(("this work is licensed under the gnu {} public license version {}",
                                      "licensed under the gnu {} public license version {}",
                                      "released under the gnu {} public license version {}")):
                key = f"{short}_{v}_{k}".lower()
                SENTENCES[key] = form.format(name, number)
                RULES.append((f"{short}-{v if '.' in v else v + '.0'}", (key,)))
    for kind in ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"):
        for v in ("2.0", "2.5", "3.0", "4.0"):
            for k, form in enumerate(("licensed under cc {} {}",
                                      "this work is licensed under cc {} {}")):
                key = f"cc_{kind}_{v}_{k}".replace(" ", "_")
                SENTENCES[key] = form.format(kind, v.replace(".", " "))
                RULES.append((f"CC-{kind.upper().replace(' ', '-')}-{v}", (key,)))


# The GNU licences, by version: name, version and the date of the licence title.
GNU = (("GPL", "general", "2", "june 1991"), ("GPL", "general", "3", "29 june 2007"),
       ("LGPL", "library general", "2", "june 1991"),
       ("LGPL", "lesser general", "2.1", "february 1999"),
       ("LGPL", "lesser general", "3", "29 june 2007"),
       ("AGPL", "affero general", "3", "19 november 2007"))
LATER = ("or at your option any later version", "or any later version", "or later")
CC = {"by": ("",), "by sa": ("sharealike",), "by nd": ("noderivatives", "noderivs"),
      "by nc": ("noncommercial",), "by nc sa": ("noncommercial sharealike",),
      "by nc nd": ("noncommercial noderivatives", "noncommercial noderivs")}
CC_VERSIONS = {"1.0": "generic", "2.0": "generic", "2.5": "generic", "3.0": "unported",
               "4.0": "international"}


def _add(name: str | None, key: str, sentence: str) -> str:
    """Lists a sentence, and a rule of it alone if it names a licence; its key."""
    if sentence in SENTENCES.values():
        return next(k for k, s in SENTENCES.items() if s == sentence)
    SENTENCES[key] = sentence
    if name:
        RULES.append((name, (key,)))
    return key


def _gnu_notices() -> None:
    """Standard notices of the GNU licences (that version only, or any later one) and titles.

    The notice is one sentence after "This program is free software:", or two if a
    semicolon stands before the version.
    """
    body = "you can redistribute it and or modify it under the terms of "
    by = " as published by the free software foundation"
    for short, name, v, date in GNU:
        number = v.replace(".", " ")
        full = f"{short}-{v if '.' in v else v + '.0'}"
        gnu = f"the gnu {name} public license"
        key = f"{short}_{v}".lower()
        terms = _add(None, f"{short}_{name.split()[0]}_terms".lower(), body + gnu + by)
        _add(full, f"{key}_title", f"gnu {name} public license version {number} {date}")
        _add(full, f"{key}_title_2", f"gnu {name} public license version {number}")
        for i, of in enumerate((" of the license", "")):
            for j, later in enumerate(LATER):
                tail = f"either version {number}{of} {later}"
                _add(f"{full}-or-later", f"{key}_later_{i}_{j}", f"{body}{gnu}{by} {tail}")
                if "option" in tail or of:
                    end = _add(None, f"later_{v}_{i}_{j}", tail)
                    RULES.append((f"{full}-or-later", (terms, end)))
            _add(f"{full}-only", f"{key}_only_{i}", f"{body}{gnu}{by} version {number}{of}")
        end = _add(None, f"only_{v}", f"version {number} of the license")
        RULES.append((f"{full}-only", (terms, end)))
        _add(f"{full}-only", f"{key}_only_2", f"{body}version {number} of {gnu}{by}")
        _add(f"{full}-only", f"{key}_only_3", f"{body}{gnu} version {number}{by}")
        for i, head in enumerate(("this work is licensed", "this program is licensed",
                                  "this project is licensed", "licensed", "released")):
            stated = f"{head} under {gnu}"
            for j, written in enumerate((f"version {number}", f"v{number}")):
                _add(full, f"{key}_short_{i}_{j}", f"{stated} {written}")
                _add(f"{full}-only", f"{key}_short_only_{i}_{j}", f"{stated} {written} only")
                for k, later in enumerate(LATER):
                    _add(f"{full}-or-later", f"{key}_short_later_{i}_{j}_{k}",
                         f"{stated} {written} {later}")


def _cc_notices() -> None:
    """Notices of the Creative Commons licences with their names spelled out, and titles."""
    for kind, names in CC.items():
        for v, where in CC_VERSIONS.items():
            full, number = f"CC-{kind.upper().replace(' ', '-')}-{v}", v.replace(".", " ")
            for n, name in enumerate(names):
                key = f"cc_{kind}_{v}_{n}".replace(" ", "_")
                called = " ".join(f"attribution {name} {number}".split())
                titles = [f"{called} {where}", f"creative commons {called} {where}",
                          f"creative commons {called} {where} public license",
                          f"creative commons legal code {called} {where}",
                          f"creative commons legal code {called}"]
                for i, title in enumerate(titles):
                    _add(full, f"{key}_title_{i}", title)
                for i, head in enumerate(("this work is licensed", "licensed")):
                    for j, (the, end) in enumerate((
                            (a, e) for a in ("a ", "the ", "") for e in ("license", ""))):
                        for k, place in enumerate((where, "")):
                            _add(full, f"{key}_{i}_{j}_{k}", " ".join(
                                f"{head} under {the}creative commons {called} {place} {end}".split()))


_families()
_gnu_notices()
_cc_notices()


def rule_pattern() -> str:
    """All rules over "id " sequences, longest first: leftmost, then longest, wins."""
    by_length = sorted(RULES, key=lambda r: -len(r[1]))
    return "|".join("(?:" + "".join(f"<{s}>" for s in ids) + ")" for _, ids in by_length)


def rule_names() -> dict[str, str]:
    return {"".join(f"<{s}>" for s in ids): name for name, ids in RULES}


def _lookup(table: dict[str, str]) -> Column:
    """A constant map, from one literal: the plan holds no expression per entry."""
    return F.str_to_map(F.lit(";".join(f"{k}={v}" for k, v in table.items())), F.lit(";"), F.lit("="))


def known_sentences(text: Column, boundary: str) -> Column:
    """Identifiers of the known sentences of a text, in order.

    A hash set tells known sentences; only these are looked up in the table.
    """
    table = _lookup({v: k for k, v in SENTENCES.items()})
    lowered = F.translate(text, UPPER, UPPER.lower())
    parts = F.transform(F.split(lowered, boundary, -1), lambda x: F.btrim(
        F.regexp_replace(x, "[^a-z0-9]+", " ")))
    return F.transform(F.filter(parts, lambda x: x.isin(*SENTENCES.values())),
                       lambda x: F.try_element_at(table, x))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: id, ``sentences`` and ``licenses`` (arrays; licences sorted, distinct)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    nothing = F.array().cast("array<string>")
    hit = text.rlike(f"(?i)({STEMS})")
    found = docs.select(F.col(id_col).alias(id_col), *[
        F.when(hit, known_sentences(text, b)).otherwise(nothing).alias(n)
        for n, b in (("_line", BY_LINE), ("_wrapped", WRAPPED))])
    names = _lookup(rule_names())

    def licences(ids: Column) -> Column:
        sequence = F.array_join(F.transform(ids, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")
        return F.transform(F.regexp_extract_all(sequence, F.lit(rule_pattern()), F.lit(0)),
                           lambda x: F.try_element_at(names, x))

    return found.select(
        id_col, F.array_sort(F.array_union("_line", "_wrapped")).alias("sentences"),
        F.when((F.size("_line") == 0) & (F.size("_wrapped") == 0), nothing).otherwise(
            F.array_sort(F.array_distinct(F.concat(licences(F.col("_line")),
                                                   licences(F.col("_wrapped"))))))
        .alias("licenses"))
