"""Quality rules, line first: clean each line, then judge what is left of the document.

Every line is tested on its own (punctuation, navigation, boilerplate); failing
lines are removed; a document that loses too much of its text is rejected. All
of it is in-row DataFrame functions, so no text is shuffled.

Defined cases: a null text counts as empty; an empty or blank text has zero in
every count, fails the base rule (fewer than 50 words) and its cleaned text is
empty; repeated rows are judged alike; input columns other than the id and the
text are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.common import WORD_BREAK, let, words

BLANKS = " \t\n\x0b\f\r"
SYMBOL_CLASS = "[#*$%&|<>]"

# Line endings that close a sentence, and phrases of page furniture.
CLOSED = tuple(""".!?…。"'”’»)]:;""")
MARKS = "[#*$%&<>]+|!!+"
SEPARATORS = r"[|»•·]"
MENU = (r"(?i)^(home|menu|login|log in|sign in|sign up|register|search|contact|contact us|"
        r"about|about us|faq|help|sitemap|next|previous|back|top|share|print|read more|"
        r"more|skip to content|privacy|privacy policy|terms|terms of use)[.!:]?\z")
BOILERPLATE = (r"(?i)(lorem ipsum|javascript|enable cookies|use cookies|cookie policy|"
               r"all rights reserved|terms of use|terms and conditions|privacy policy|"
               r"click here|subscribe to our newsletter|sign up for our|follow us on|"
               r"share this|powered by wordpress)")


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    short_line_words: int = 10        # shorter lines must close a sentence
    max_mark_percent: int = 20        # runs of symbols or of "!!" for each 100 words of a line
    max_separators: int = 2           # a line with more of them, and ...
    max_separator_percent: int = 4    # ... with more for each 100 words, is navigation
    max_brace_percent: int = 5        # braces for each 100 words of a line
    max_boilerplate_words: int = 30   # longer lines that mention a phrase are prose
    max_lost_percent: int = 50        # of the characters in words


def symbol_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOL_CLASS)).cast("long")


def word_chars(w: Column) -> Column:
    return F.length(F.array_join(w, "")).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1),
                     lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_words(w: Column) -> Column:
    """Words inside a 3-word window that the text has twice or more.

    Windows are compared by their 64-bit hash. Only a text with an equal pair
    sorts its windows; sorted neighbours give the repeated ones, and the gaps
    between their start positions (3 at most) add up to the covered words.
    """
    n = F.size(w)
    windows = F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
    )).otherwise(F.array().cast("array<bigint>"))

    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.zip_with(starts, F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))),
                       lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))),
            F.lit(0), lambda acc, x: acc + x)

    def starts(by_hash: Column) -> Column:
        def twin(x: Column, k: Column) -> Column:
            before = F.get(by_hash, k - 1)["h"]
            after = F.get(by_hash, k + 1)["h"]
            return F.coalesce(x["h"] == before, F.lit(False)) | \
                F.coalesce(x["h"] == after, F.lit(False))
        return F.array_sort(F.transform(F.filter(by_hash, twin), lambda x: x["i"]))

    def count(h: Column) -> Column:
        by_hash = F.array_sort(F.transform(
            h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(let(by_hash, starts), covered))

    return let(windows, count).cast("long")


def line_fails(line: Column, r: Rules) -> Column:
    """True for a non-blank, trimmed line that a rule removes."""
    def judge(n: Column) -> Column:
        marks = F.regexp_count(line, F.lit(MARKS))
        separators = F.regexp_count(line, F.lit(SEPARATORS))
        punctuation = ((n < r.short_line_words) & ~F.right(line, F.lit(1)).isin(*CLOSED)) | \
            (marks * 100 > n * r.max_mark_percent)
        braces = F.regexp_count(line, F.lit("[{]"))
        navigation = ((separators > r.max_separators)
                      & (separators * 100 > n * r.max_separator_percent)) | \
            (braces * 100 > n * r.max_brace_percent) | line.rlike(MENU)
        boilerplate = (n <= r.max_boilerplate_words) & line.rlike(BOILERPLATE)
        return punctuation | navigation | boilerplate
    return let(F.regexp_count(line, F.lit(WORD_BREAK)) + 1, judge)


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                rules: Rules | None = None) -> DataFrame:
    """One row per input row: id, counts, ``clean_text``, ``kept_chars`` and verdicts."""
    r = rules or Rules()
    base = docs.select(F.col(id_col).alias(id_col),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_t"))

    lines = F.filter(F.transform(F.split(F.col("_t"), "\n", -1),
                                 lambda x: F.btrim(x, F.lit(BLANKS))),
                     lambda x: x != "")
    kept = F.filter(lines, lambda x: ~line_fails(x, r))
    counted = let(words(F.col("_t")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), word_chars(w).alias("word_chars"),
        repeated_words(w).alias("n_repeat_words")))
    out = base.select(
        id_col, counted.alias("_w"),
        symbol_count(F.col("_t")).alias("n_symbols"),
        duplicate_lines(F.col("_t")).alias("n_dup_lines"),
        F.array_join(kept, "\n").alias("clean_text"))
    out = out.select(id_col, "_w.n_words", "_w.word_chars", "n_symbols", "n_dup_lines",
                     "_w.n_repeat_words", "clean_text",
                     F.length(F.regexp_replace("clean_text", WORD_BREAK, "")).cast("long")
                     .alias("kept_chars"))
    failed = (F.col("n_words") < r.min_words) | (
        100 * F.col("n_repeat_words") > r.max_repeat_percent * F.col("n_words"))
    lost = 100 * (F.col("word_chars") - F.col("kept_chars")) > \
        r.max_lost_percent * F.col("word_chars")
    return out.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & ~lost)
