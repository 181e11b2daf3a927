"""Listing cleaning and the model feature table (``cleaned_listing``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions import parse as P
from lodgeframe.operators import geo

# Column order of the cleaned listing table (kept for export compatibility).
CLEANED_COLUMNS = (
    "id", "latitude", "longitude", "num_bus_2km", "num_subway_2km", "num_shop_2km",
    "nearest_shop_m", "num_restaurant_2km", "neighbourhood_cleansed", "room_type",
    "accommodates", "baths", "beds", "days", "amenities", "price", "future_occupancy",
)


def parse_listings(listings: DataFrame, as_of: str = P.TENURE_AS_OF) -> DataFrame:
    """Typed listing columns from the raw text table."""
    return listings.select(
        F.col("id").try_cast("long").alias("id"),
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
        "neighbourhood_cleansed",
        "room_type",
        F.col("accommodates").try_cast("int").alias("accommodates"),
        P.bath_count("bathrooms_text").alias("baths"),
        P.beds_imputed("beds", "accommodates").alias("beds"),
        P.host_days("host_since", as_of).alias("days"),
        P.amenity_score("amenities").alias("amenities"),
        P.price_drop_first("price").alias("price"),
        P.occupancy("availability_30").alias("future_occupancy"),
    )


def cleaned_listing(listings: DataFrame, pois: DataFrame, *, keep_missing: bool = False,
                    pair_budget: int = geo.DEFAULT_PAIR_BUDGET) -> DataFrame:
    """Parsed listings joined with their POI features on the listing id.

    One inner join on ``id`` (the original joined the coordinates back in a
    second self-join; the typed table already carries them). A listing id
    that occurs k times keeps k rows, each with that id's features.
    """
    typed = parse_listings(listings)
    feats = geo.poi_features(geo.listing_locations(listings), pois,
                             keep_missing=keep_missing, pair_budget=pair_budget)
    joined = typed.join(feats.withColumnRenamed("listing_id", "id").hint("merge"), "id", "inner")
    return joined.select(*CLEANED_COLUMNS)
