"""Personal data by weak supervision, in DataFrame functions only.

1. Candidates. Four base patterns give strict spans (email, ip, card, phone); looser
   forms of the same kinds give more candidates (a spelled-out address, an account
   number, a phone number without its country code). Positions come from the texts
   between the matches, so one regex pass finds a kind and its offsets.
2. Labelers vote on each candidate: +1 personal, -1 not, 0 abstain. One regex labeler
   (a letter or digit touches the candidate), two gazetteers (known domains, address
   ranges, issuers and country codes; placeholder values) and one context labeler (cue
   words before it).
3. Expectation-maximisation over the shares of vote patterns (at most 3^4 a kind)
   estimates each labeler's reliability and the share of personal spans, each kind by
   itself. Reliabilities and share keep to fixed bounds: a vote always speaks for its
   side, a candidate without votes stays below one half, one with positive votes alone
   gets above. Only shares count, so n times the corpus is judged like the corpus.
4. The posteriors train the final span classifier, naive Bayes over shape and edge
   features of a candidate, from counts added up over all candidates. No cue weighs
   more than a positive one, none less than a negative one.
5. Strict spans always stay. A looser candidate is added, as a kind of its own, if the
   classifier and the posterior agree and it overlaps no strict span.

Defined cases: a null text counts as empty and has no span; spans are in code points, end
exclusive; repeated rows are judged alike; an empty table gives an empty result; input
columns other than id and text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lodgeframe.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")
ADDED = ("spoken_email", "account", "local_phone")
NAMES = KINDS + ADDED
GROUP = {"spoken_email": "email", "account": "card", "local_phone": "phone"}
LABELERS = ("edges", "gazetteer", "placeholder", "context")
CONTEXT_CHARS = 40

# Bounds of a labeler's reliability and of the personal share of a kind. The
# odds of the least share and of one positive vote of the least reliability make 9 / 7.
RELIABLE = (0.75, 0.99)
SHARE = (0.3, 0.45)

# The base patterns. A run that cannot start a match is skipped whole:
# a match starts after a character outside the run or where the last match ended.
EMAIL_CHAR = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{EMAIL_CHAR}]))[{EMAIL_CHAR}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "spoken_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[(\[]\x20?at\x20?[)\]]\x20?[A-Za-z0-9-]{1,64}+"
                    r"\x20?[(\[]\x20?dot\x20?[)\]]\x20?[A-Za-z]{2,20}+",
    "local_phone": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])",
}

# Gazetteers and cue words.
DOMAINS = ("com", "org", "net", "edu", "gov", "mil", "int", "info", "io", "co", "us", "uk", "de",
           "fr", "es", "it", "nl", "ch", "at", "eu", "ca", "au", "jp", "in", "br", "mx")
COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43",
                 "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "61", "62",
                 "64", "65", "81", "82", "86", "90", "91", "351", "353", "358", "420")
CUES = {
    "email": "mail|e-mail|contact|write|correo|courriel",
    "ip": r"ip|host|server|address|login|adresse",
    "card": "card|visa|mastercard|amex|account|credit|debit|iban|tarjeta|carte|karte|konto",
    "phone": "phone|tel|telephone|call|mobile|cell|fax|contact|dial|telefon|whatsapp|móvil",
}
ANTI_CUES = "version|isbn|issn|doi|section|figure|table|order|build|serial|sku|page|token|hash"


def luhn(digits: Column) -> Column:
    """Luhn check of a digit string."""
    n = F.length(digits)
    total = F.aggregate(
        F.transform(F.split(digits, ""), lambda c, i: F.when(
            (n - i) % 2 == 0, F.get(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                                    c.cast("int"))).otherwise(c.cast("int"))),
        F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return total % 10 == 0


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _matches(text: Column, pattern: str, marker: str | None = None) -> Column:
    """Array of (gap, match, before, after): the text between matches gives the offsets."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<gap:int,match:string,before:string,after:string>>")

    def rows(pair: Column) -> Column:
        return F.transform(pair["m"], lambda m, i: F.struct(
            F.length(F.get(pair["g"], i)).alias("gap"), m.alias("match"),
            F.right(F.get(pair["g"], i), F.lit(CONTEXT_CHARS)).alias("before"),
            F.left(F.get(pair["g"], i + 1), F.lit(1)).alias("after")))

    def cut(m: Column) -> Column:
        pair = F.struct(m.alias("m"), F.split(text, pattern, -1).alias("g"))
        return F.when(F.size(m) == 0, empty).otherwise(
            F.get(F.transform(F.array(pair), rows), F.lit(0)))

    got = F.get(F.transform(F.array(found), cut), F.lit(0))
    return got if marker is None else F.when(text.contains(marker), got).otherwise(empty)


def candidates(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows: rid, doc_id; spans: rid, name, group, start, end, match, before, after)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    need = {"email": "@", "phone": "+", "ip": "."}
    found = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
        *[_matches(text, p, need.get(k)).alias(k) for k, p in PATTERNS.items()]))
    one = found.select("rid", F.explode(F.array(*[
        F.struct(F.lit(k).alias("pattern"), F.col(k).alias("m")) for k in PATTERNS])).alias("z"))
    one = one.where(F.size("z.m") > 0).select(
        "rid", "z.pattern", F.posexplode("z.m").alias("i", "x"))
    w = W.partitionBy("rid", "pattern").orderBy("i")
    before = F.sum(F.col("x.gap") + F.length("x.match")).over(
        w.rowsBetween(W.unboundedPreceding, 0))
    spans = one.select("rid", "pattern", "x.match", "x.before", "x.after", before.alias("end"))
    spans = spans.withColumn("start", F.col("end") - F.length("match"))
    digits = _digits(F.col("match"))
    n = F.length(digits)
    strict = (
        F.when(F.col("pattern") == "email", F.lit(True))
        .when(F.col("pattern") == "ip", F.col("match").rlike(
            r"\A0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
            r"(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}\z"))
        .when(F.col("pattern") == "card", (n >= 13) & (n <= 19) & luhn(digits))
        .when(F.col("pattern") == "phone", (n >= 9) & (n <= 15))
        .otherwise(F.lit(False)))
    loose = F.when(F.col("pattern") == "card", F.when((n >= 10) & (n <= 19), F.lit("account"))
                   ).when(F.col("pattern").isin(*ADDED), F.col("pattern"))
    spans = spans.withColumn("strict", strict).withColumn(
        "name", F.when(F.col("strict"), F.col("pattern")).otherwise(loose)).where("name IS NOT NULL")
    group = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in GROUP.items() for x in p]),
                                        F.col("name")), F.col("name"))
    return found.select("rid", "doc_id"), spans.withColumn("group", group)


def votes(spans: DataFrame) -> DataFrame:
    """Adds one vote column per labeler and the features of the final classifier."""
    digits = _digits(F.col("match"))
    g = F.col("group")
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    edge = r"[A-Za-z0-9]"
    touching = F.right("before", F.lit(1)).rlike(edge) | F.col("after").rlike(edge)
    domain = F.lower(F.regexp_extract("match", r"([A-Za-z]+)\z", 1))
    code = F.regexp_extract("match", r"\A\+([0-9]{1,3})", 1)
    known_code = F.lit(False)
    for size in (1, 2, 3):
        known_code = known_code | F.substring(code, 1, size).isin(
            *[c for c in COUNTRY_CODES if len(c) == size])
    gazetteer = (
        F.when(g == "email", F.when(domain.isin(*DOMAINS), yes).otherwise(no))
        .when(g == "ip", F.when(F.col("match").rlike(
            r"\A0*(?:0|10|127|22[4-9]|2[3-5][0-9])\.|\A192\.168\.|\A169\.254\."), no).otherwise(yes))
        .when(F.col("name") == "card", F.when(
            F.substring(digits, 1, 1).isin("3", "4", "5", "6"), yes).otherwise(no))
        .when(F.col("name") == "phone", F.when(known_code, yes).otherwise(no))
        .otherwise(none))
    placeholder = F.when(
        F.regexp_replace(digits, F.substring(digits, 1, 1), "") == "",
        F.when(F.length(digits) > 0, no).otherwise(none)).when(
        F.lower("match").rlike(r"\A(?:test|example|noreply|no-reply|user|foo)@") |
        digits.rlike(r"\A0*1234567"), no).otherwise(none)
    cue = F.lit(False)
    for k, words in CUES.items():
        cue = cue | ((g == k) & F.col("before").rlike(rf"(?i)\b(?:{words})\b"))
    context = F.when(cue, yes).when(F.col("before").rlike(
        rf"(?i)\b(?:{ANTI_CUES})\b[^A-Za-z]*\z"), no).otherwise(none)
    size = F.when(F.length(digits) == 0, "0").when(F.length(digits) <= 9, "1-9").when(
        F.length(digits) <= 12, "10-12").when(F.length(digits) <= 15, "13-15").otherwise("16+")
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        F.col("match"), "[0-9]+", "9"), "[A-Za-z]+", "a"), r"(.{3})(?:.*)", "$1")
    return spans.withColumns({
        "edges": F.when(touching, no).otherwise(none),
        "gazetteer": gazetteer, "placeholder": placeholder, "context": context,
        "features": F.array(
            F.concat(F.lit("name="), F.col("name")), F.concat(F.lit("digits="), size),
            F.concat(F.lit("shape="), shape),
            F.concat(F.lit("edge="), F.when(touching, "in").otherwise("out")),
            F.concat(F.lit("cue="), context.cast("string"))),
    })


def _within(value: float, bounds: tuple[float, float]) -> float:
    return min(max(value, bounds[0]), bounds[1])


def reliabilities(patterns: list, rounds: int = 50) -> dict[tuple, float]:
    """EM over counted vote patterns: posterior of "personal" by (kind, votes).

    ``patterns``: (kind, votes, count). A labeler that votes is right with a probability of
    its own in each class; whether it votes tells nothing. The bounds fix which class is which.
    """
    post: dict[tuple, float] = {}
    least, most = RELIABLE
    for kind in {p[0] for p in patterns}:
        own = [(v, c) for g, v, c in patterns if g == kind]
        mass = sum(c for _, c in own)
        share, k = sum(SHARE) / 2, len(own[0][0])
        # Probability of +1 among the votes of a labeler, for personal spans and for others.
        plus = {1: [(least + most) / 2] * k, 0: [1 - (least + most) / 2] * k}
        for _ in range(rounds):
            soft = []
            for v, _c in own:
                odds = math.log(share / (1 - share)) + sum(
                    math.log(plus[1][i] / plus[0][i]) if x > 0 else
                    math.log((1 - plus[1][i]) / (1 - plus[0][i])) for i, x in enumerate(v) if x)
                soft.append(1 / (1 + math.exp(-odds)))
            share = _within(sum(p * c for p, (_, c) in zip(soft, own)) / mass, SHARE)
            for y, bounds in ((1, RELIABLE), (0, (1 - most, 1 - least))):
                for i in range(k):
                    n = {x: sum((p if y else 1 - p) * c for p, (v, c) in zip(soft, own)
                                if v[i] == x) for x in (1, -1)}
                    if n[1] + n[-1] > 0:
                        plus[y][i] = _within(n[1] / (n[1] + n[-1]), bounds)
        for p, (v, _c) in zip(soft, own):
            post[kind, tuple(v)] = p
    return post


def _map(table: dict[str, float]) -> Column:
    if not table:
        return F.create_map().cast("map<string,double>")
    return F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(float(v)))])


def weights(stats: list) -> tuple[dict[str, float], dict[str, float]]:
    """Naive Bayes (weight by "kind|feature", bias by kind) from (kind, feature, p, q): the
    sums of the posterior and of its complement."""
    bias = {k: math.log(p / q) for k, f, p, q in stats if f.startswith("name=")}
    weight = {f"{k}|{f}": math.log(p / q) - bias[k] for k, f, p, q in stats}
    for k in bias:
        none = weight.get(f"{k}|cue=0", 0.0)
        for cue, pick in (("1", max), ("-1", min)):
            if (key := f"{k}|cue={cue}") in weight:
                weight[key] = pick(weight[key], none, 0.0)
    return weight, bias


def classify(spans: DataFrame) -> DataFrame:
    """``spans`` (with votes) plus ``posterior`` and ``log_odds`` of the final classifier."""
    key = F.concat_ws("|", "name", *[F.col(x).cast("string") for x in LABELERS])
    counted = spans.groupBy("name", *LABELERS).agg(F.count("*").alias("n")).collect()
    post = reliabilities([(r["name"], tuple(r[x] for x in LABELERS), r["n"]) for r in counted])
    told = spans.withColumn("posterior", F.try_element_at(
        _map({"|".join([k, *map(str, v)]): p for (k, v), p in post.items()}), key))
    # Features take a bounded number of values, so their counts fit in one small table.
    stats = told.select("name", "posterior", F.explode("features").alias("f")).groupBy(
        "name", "f").agg(F.sum("posterior").alias("p"),
                         F.sum(1 - F.col("posterior")).alias("q")).collect()
    weight, bias = weights([(r["name"], r["f"], r["p"], r["q"]) for r in stats])
    log_odds = F.aggregate(
        F.transform("features", lambda f: F.coalesce(F.try_element_at(
            _map(weight), F.concat(F.col("name"), F.lit("|"), f)), F.lit(0.0))),
        F.coalesce(F.try_element_at(_map(bias), F.col("name")), F.lit(0.0)), lambda a, x: a + x)
    return told.withColumn("log_odds", log_odds)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id and ``spans``, an array of (kind, start, end, strict), in order."""
    rows, spans = candidates(docs, id_col, text_col)
    judged = classify(materialize(votes(spans)))
    order = F.array_position(F.array(*[F.lit(x) for x in NAMES]), F.col("name")).cast("int")
    per_row = judged.where(F.col("strict") | ((F.col("posterior") >= 0.5) & (F.col("log_odds") > 0))
                           ).groupBy("rid").agg(F.array_sort(F.collect_list(F.struct(
                               order.alias("o"), F.col("start").cast("long").alias("start"),
                               F.col("end").cast("long").alias("end"),
                               F.col("name").alias("kind"), "strict"))).alias("s"))
    empty = F.array().cast("array<struct<o:int,start:bigint,end:bigint,kind:string,strict:boolean>>")
    out = rows.join(per_row, "rid", "left").withColumn("s", F.coalesce("s", empty))
    return out.select("doc_id", F.filter("s", lambda x: x["strict"] | ~F.exists(
        F.col("s"), lambda y: y["strict"] & (y["start"] < x["end"]) & (x["start"] < y["end"]))
    ).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of strict spans per kind, the hash of their list, and the list of all spans."""
    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    strict = F.filter("spans", lambda x: x["strict"])

    def count(kind: str) -> Column:
        return F.size(F.filter(strict, lambda x: x["kind"] == kind)).cast("long")

    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(listed(strict), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"))
