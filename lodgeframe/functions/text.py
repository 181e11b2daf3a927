"""Text expressions used by the review pipeline (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgeframe.functions.common import col_of
from lodgeframe.functions.parse import WS_CLASS

# The 32 ASCII punctuation characters removed inside tokens.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Fixed value: the marker of automated (non-review) posts, matched after lower-casing.
AUTOMATED_MARKER = "this is an automated posting."

LINE_BREAK_TAG = "<br/>"


def remove_line_breaks(c) -> Column:
    """C20: remove ``<br/>`` (neighbouring words fuse)."""
    return F.replace(col_of(c), F.lit(LINE_BREAK_TAG), F.lit(""))


def whitespace_tokens(c) -> Column:
    """Whitespace split of the whole text, no empty tokens (Python ``split()``).

    Leading / trailing whitespace only yields empty edge tokens, which the
    filter drops, so no separate strip pass over the text is needed.
    """
    return F.filter(F.split(col_of(c), f"{WS_CLASS}+", -1), lambda w: w != F.lit(""))


def strip_punctuation(c) -> Column:
    """Delete the 32 ASCII punctuation characters inside a token."""
    return F.translate(col_of(c), PUNCTUATION, "")


def without_punctuation(c) -> Column:
    """N3 for a whole text: the same characters deleted in one pass."""
    return F.regexp_replace(col_of(c), r"[!-/:-@\[-`{-~]+", "")


def not_automated(c) -> Column:
    """text does not contain the automated-posting marker."""
    return ~F.contains(col_of(c), F.lit(AUTOMATED_MARKER))
