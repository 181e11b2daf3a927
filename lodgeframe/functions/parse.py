"""Listing / calendar / weather text parsing as Catalyst expressions.

Every function maps Column -> Column and stays inside whole-stage codegen
(no Python UDF). Bad text yields NULL (``try_cast``) where the original jobs
raised; the cases are listed in the README.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgeframe.functions.common import col_of

# The amenity phrases whose presence is counted (checklist score).
# Each is matched as a substring of the lower-cased amenity text, in this order:
AMENITY_PHRASES = (
    "wifi", "alarm", "kitchen", "essentials", "long term stays allowed",
    "hangers", "hair dryer", "washer", "hot water", "dryer", "iron",
    "shampoo", "dishes", "workspace", "refrigerator", "fire extinguisher",
    "microwave", "coffee", "park", "tv",
)

# Fixed value: the tenure reference day of the listing snapshot.
TENURE_AS_OF = "2021-11-06"

# Whitespace as Python's ``str.strip()`` / ``str.split()`` see it (ASCII
# whitespace, unicode separators, the C0 separators and NEL).  The same text
# works as a Java and an RE2 pattern.
WS_CLASS = r"[\t\n\x{0B}\f\r \p{Z}\x{1C}-\x{1F}\x{85}]"

_NUMERIC_WORD = r"^([0-9]+[.]?[0-9]*|[.][0-9]+)$"


def strip_ws(c) -> Column:
    """Remove leading / trailing whitespace (Python ``strip`` semantics)."""
    return F.regexp_replace(col_of(c), f"^{WS_CLASS}+|{WS_CLASS}+$", "")


def price_drop_first(c) -> Column:
    """Drop commas, drop the first character (the currency sign), parse float32.

    ``$1,234.50`` -> 1234.5, ``1234`` -> 234.0, NULL / ``$`` -> NULL.
    """
    text = F.replace(col_of(c), F.lit(","), F.lit(""))
    return F.substring(text, 2, 2147483647).try_cast("float")


def price_strip(c) -> Column:
    """Remove every ``$`` and ``,`` and parse as double."""
    return F.translate(col_of(c), "$,", "").try_cast("double")


def bath_count(c) -> Column:
    """C4: bathroom text -> float32.

    NULL -> 1.0. The trimmed text is split on single spaces; a first word of
    digits with at most one dot is the count, anything else counts 1.0; the
    count is halved when the second word contains lower-case ``shared``.
    A one-word text keeps factor 1 (the original raised IndexError).
    """
    x = col_of(c)
    t = strip_ws(x)
    first = F.split_part(t, F.lit(" "), F.lit(1))
    second = F.split_part(t, F.lit(" "), F.lit(2))
    num = F.when(first.rlike(_NUMERIC_WORD), first.try_cast("double")).otherwise(F.lit(1.0))
    factor = F.when(F.instr(second, "shared") > 0, F.lit(0.5)).otherwise(F.lit(1.0))
    return F.when(x.isNull(), F.lit(1.0)).otherwise(num * factor).cast("float")


def host_days(c, as_of: str = TENURE_AS_OF) -> Column:
    """Days from ``host_since`` (yyyy-MM-dd) to ``as_of``; NULL -> 0, bad text -> NULL."""
    x = col_of(c)
    end = F.lit(_dt.date.fromisoformat(as_of))
    return F.when(x.isNull(), F.lit(0)).otherwise(F.datediff(end, x.try_cast("date")))


def occupancy(c) -> Column:
    """round((30 - availability_30) / 30, 3) as float32; bad text -> NULL."""
    days = col_of(c).try_cast("int")
    return F.round((F.lit(30) - days) / F.lit(30.0), 3).cast("float")


def beds_imputed(beds, accommodates) -> Column:
    """int(beds), or ceil(accommodates / 2) when beds is NULL."""
    b = col_of(beds)
    acc = col_of(accommodates).try_cast("int")
    return F.when(b.isNull(), F.ceil(acc / F.lit(2)).cast("int")).otherwise(b.try_cast("int"))


def availability_flag(c) -> Column:
    """``'f'`` -> 1, anything else or NULL -> 0."""
    return F.coalesce(col_of(c) == F.lit("f"), F.lit(False)).cast("int")


def contains_flag(text, word) -> Column:
    """C11: 1 when ``word`` occurs in ``text`` else 0 (NULL text -> NULL)."""
    w = word if isinstance(word, Column) else F.lit(word)
    return (F.position(w, col_of(text)) > 0).cast("int")


def amenity_score(c, phrases=AMENITY_PHRASES) -> Column:
    """Number of checklist phrases occurring as substrings of the lower-cased text."""
    low = F.lower(col_of(c))
    total = None
    for phrase in phrases:
        hit = (F.instr(low, phrase) > 0).cast("int")
        total = hit if total is None else total + hit
    return total


def amenity_items(c) -> Column:
    """Items of an amenity list text: brackets removed, split on ``", "``.

    ``[]`` gives one empty item, as the original list code did.
    """
    return F.split(F.translate(col_of(c), "[]", ""), ", ", -1)


def amenity_list_len(c) -> Column:
    """Number of items in an amenity list text (``[]`` -> 1)."""
    return F.size(amenity_items(c))


def month_of(c) -> Column:
    """Month number of a yyyy-MM-dd text (int), bad text -> NULL."""
    return F.month(col_of(c).try_cast("date"))


def month_text(c) -> Column:
    """Month as unpadded text (``'4'``)."""
    return month_of(c).cast("string")


def year_of(c) -> Column:
    """Year of a yyyy-MM-dd text."""
    return F.year(col_of(c).try_cast("date"))


def to_float(c) -> Column:
    """C14: nullable text -> float32 (bad text -> NULL)."""
    return col_of(c).try_cast("float")


def log_label(c) -> Column:
    """C17: natural log; 0 or negative -> NULL."""
    return F.log(col_of(c))


def exp_to_int(c) -> Column:
    """exp(prediction) truncated toward zero to int (overflow -> NULL)."""
    return F.exp(col_of(c)).try_cast("int")


def monthly_profit(price, occ) -> Column:
    """Price * occupancy * 30."""
    return col_of(price) * col_of(occ) * F.lit(30)


def polarity_to_rating(c) -> Column:
    """Polarity -1..1 -> rating 0..5 as double."""
    return (col_of(c) + F.lit(1)) * F.lit(2.5)


def round_half_up(c, places: int) -> Column:
    """Spark's HALF_UP ``round``."""
    return F.round(col_of(c), places)
