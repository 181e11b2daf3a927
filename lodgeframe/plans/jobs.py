"""File-to-file jobs: the original's scripts, each one Spark job from input files to output files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodgeframe.operators import geo, listings, profit, text
from lodgeframe.session import configure
from lodgeframe.sources import catalogue, io


def extract_nodes(spark: SparkSession, osm_xml: str, out: str, box=None) -> None:
    """Map extract (XML) -> nodes of interest inside the box (gzip JSON lines)."""
    io.write_json(geo.extract_nodes(io.read_osm_xml(configure(spark), osm_xml), box), out)


def categorise_nodes(spark: SparkSession, nodes_json: str, out: str) -> None:
    """Nodes of interest -> POI table (gzip JSON lines)."""
    nodes = io.read_json(configure(spark), nodes_json, io.NODE_SCHEMA)
    io.write_json(geo.categorize_nodes(nodes), out)


def clean_listings(spark: SparkSession, listings_csv: str, pois_json: str, out: str,
                   keep_missing: bool = False) -> None:
    """Listing CSV and POI table -> cleaned listing CSV (``io.CLEANED_SCHEMA``)."""
    spark = configure(spark)
    table = listings.cleaned_listing(io.read_text_csv(spark, listings_csv),
                                     io.read_json(spark, pois_json, io.POI_SCHEMA),
                                     keep_missing=keep_missing)
    io.write_csv(table, out, mode="overwrite")


def read_cleaned_listings(spark: SparkSession, path: str) -> DataFrame:
    return io.read_typed_csv(spark, path, io.CLEANED_SCHEMA)


def score_reviews(spark: SparkSession, reviews_csv: str, out: str) -> None:
    """Review CSV -> scored reviews of the wanted language (gzip CSV)."""
    spark = configure(spark)
    reviews = io.read_typed_csv_drop_malformed(spark, reviews_csv, io.REVIEW_SCHEMA)
    scored = text.review_scores(reviews, text.stop_words_table(spark), text.lemma_table(spark),
                                text.lexicon_table(spark), text.lang_words_table(spark))
    io.write_csv(scored, out, mode="overwrite", compression="gzip")


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return io.read_typed_csv_drop_malformed(spark, path, io.SCORE_SCHEMA)


def export_catalogue(pages: DataFrame, city: str, out: str, header: bool = True) -> None:
    """Pages -> catalogue CSV, with or without a header."""
    io.write_csv(catalogue.catalogue_rows(pages, city), out, mode="overwrite", header=header)


def price_requests(requests: DataFrame, pois_json: str, model_path: str, out: str) -> None:
    """Requests, POI table and a saved price model -> best price per request (CSV)."""
    spark = configure(requests.sparkSession)
    model = io.load_model(model_path)
    best = profit.optimise(requests, io.read_json(spark, pois_json, io.POI_SCHEMA),
                           profit.model_log_price(model))
    io.write_csv(best, out, mode="overwrite")
