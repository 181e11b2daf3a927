"""Summary tables behind the charts: prices by feature, month, weather, amenities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions import parse as P

# The chart dimensions of the price summaries.
PRICE_DIMENSIONS = ("room_type", "accommodates", "beds", "baths", "neighbourhood_cleansed")

# Fixed value: listings at or above this nightly price are left out of the
# amenity / price correlation.
CORR_PRICE_CUTOFF = 1000.0

# Word pattern of the amenity term counts (a letter, digit or underscore,
# then at least one more of those or an apostrophe).
TERM_PATTERN = r"[\p{L}\p{N}_][\p{L}\p{N}_']+"


def chart_frame(listings: DataFrame) -> DataFrame:
    """Columns the price charts group by: text dims kept as text, price / baths parsed."""
    return listings.select(
        "id", "room_type", "accommodates", "beds", "neighbourhood_cleansed",
        P.price_drop_first("price").alias("price"),
        P.bath_count("bathrooms_text").alias("baths"),
    )


def price_by(frame: DataFrame, dim: str) -> DataFrame:
    """A3 + T1: count of non-NULL prices and mean price per dimension value, ordered by it.

    NULL is its own group. Text dimensions order lexically ('1', '10', '2').
    The sort runs on the aggregated rows only (one per group).
    """
    return (frame.groupBy(dim)
            .agg(F.count("price").alias("count"), F.avg("price").alias("price"))
            .orderBy(dim))


def price_by_all_dims(frame: DataFrame, dims=PRICE_DIMENSIONS) -> DataFrame:
    """A3 in one pass: GROUPING SETS over every dimension.

    Output (dimension, value, count, price); ``value`` is the group key as text.
    One scan and one shuffle instead of one per dimension.
    """
    cols = [F.col(d).cast("string").alias(d) for d in dims]
    base = frame.select(*cols, "price")
    grouped = base.groupingSets([[F.col(d)] for d in dims], *[F.col(d) for d in dims]) \
        .agg(F.count("price").alias("count"), F.avg("price").alias("price"),
             F.grouping_id().alias("_gid"))
    n = len(dims)
    dim_name = None
    value = None
    for i, d in enumerate(dims):
        gid = (1 << n) - 1 - (1 << (n - 1 - i))
        cond = F.col("_gid") == F.lit(gid)
        dim_name = F.when(cond, F.lit(d)) if dim_name is None else dim_name.when(cond, F.lit(d))
        value = F.when(cond, F.col(d)) if value is None else value.when(cond, F.col(d))
    return grouped.select(dim_name.alias("dimension"), value.alias("value"), "count", "price")


def monthly_price(calendar: DataFrame, by_year: bool = False) -> DataFrame:
    """A4: per month, the mean over listings of each listing's mean price (all months).

    The year is ignored by default (as in the original, so April of two
    years is one group); ``by_year=True`` adds a ``year`` key. Rows whose
    date does not parse are dropped.
    """
    keys = ["year", "month"] if by_year else ["month"]
    rows = calendar.select(
        "listing_id",
        P.year_of("date").alias("year"),
        P.month_of("date").alias("month"),
        P.price_drop_first("price").alias("price"),
    ).where(F.col("month").isNotNull())
    per_listing = rows.groupBy(*keys, "listing_id").agg(F.avg("price").alias("id_price"))
    return per_listing.groupBy(*keys).agg(F.avg("id_price").alias("price"))


def monthly_weather(weather: DataFrame) -> DataFrame:
    """A5: per month, sum(rain) / count(temperature) and mean temperature, rounded to 1.

    The rain divisor is the count of non-NULL temperatures, as in the original.
    """
    rows = weather.select(
        P.month_of("date").alias("month"),
        P.to_float("avg_temperature").alias("tem"),
        P.to_float("rain").alias("rain"),
    )
    agg = rows.groupBy("month").agg(
        F.count("tem").alias("_n"), F.sum("rain").alias("_rain"), F.sum("tem").alias("_tem"))
    return agg.select(
        "month",
        F.round(F.col("_rain") / F.col("_n"), 1).alias("rain"),
        F.round(F.col("_tem") / F.col("_n"), 1).alias("temp"),
    ).orderBy("month")


def neighbourhood_prices(cleaned: DataFrame, neighbourhoods: DataFrame) -> DataFrame:
    """A6 + J8: mean price per neighbourhood attached to the map's neighbourhood list.

    Every neighbourhood of the map keeps a row (NULL price when it has no
    listing); listings in neighbourhoods missing from the map are not shown.
    """
    avg = cleaned.groupBy("neighbourhood_cleansed").agg(F.avg("price").alias("price"))
    names = neighbourhoods.select(F.col("neighbourhood").alias("neighbourhood_cleansed"))
    return names.join(avg, "neighbourhood_cleansed", "left")


def amenity_frequency(listings: DataFrame) -> DataFrame:
    """Count of each lower-cased amenity item (quotes kept; ``[]`` counts one '')."""
    items = listings.select(
        F.explode(P.amenity_items(F.lower(F.col("amenities")))).alias("item"))
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("count"))


def amenity_terms(listings: DataFrame, k: int | None = None) -> DataFrame:
    """Counts of all words over all amenity items; with ``k``, the k most frequent ones
    (count desc, then word)."""
    words = listings.select(
        F.explode(F.regexp_extract_all(F.lower(F.col("amenities")), F.lit(TERM_PATTERN), 0))
        .alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    if k is None:
        return counts
    return counts.orderBy(F.col("count").desc(), F.col("word")).limit(k)


def amenity_values(listings: DataFrame) -> DataFrame:
    """C3 + C9 per listing: (id, amenities_value, price_value)."""
    return listings.select(
        "id",
        P.amenity_list_len("amenities").alias("amenities_value"),
        P.price_strip("price").alias("price_value"),
    )


def amenity_price_corr(listings: DataFrame, cutoff: float = CORR_PRICE_CUTOFF) -> DataFrame:
    """A8 + F2: Pearson correlation of list length and price, price below ``cutoff``."""
    vals = amenity_values(listings).where(F.col("price_value") < F.lit(cutoff))
    return vals.agg(F.corr("amenities_value", "price_value").alias("r"))
