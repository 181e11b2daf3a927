"""Domain tables derived from the driver's test tables.

The original jobs read listing / calendar / weather / review / map files that
are not available; these views re-create their shapes from the TPC-H-like
tables so every query's work grows with the input. Every expression uses
integer arithmetic on keys and double literals so DuckDB can derive the same
rows (see ``lodgeframe.plans.oracle`` for the SQL twins).

All views are lazy projections of one parquet scan (the listing view adds a
join with the fixed 25-row ``nation`` table), so Catalyst prunes columns and
pushes filters into the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.functions.text import strip_punctuation, whitespace_tokens

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Bathroom texts used by the listing view (by p_size % 9).
BATH_TEXTS = (
    None, "1 bath", "1.5 shared baths", "Shared half-bath", "Private half-bath",
    "2 baths", "Half-bath", "0 shared baths", ".5 bath",
)

# Amenity list texts used by the listing view (by p_size % 6).
AMENITY_TEXTS = (
    "[]",
    '["Wifi", "Kitchen", "Hair dryer"]',
    '["Free parking on premises", "TV", "Washer", "Dryer"]',
    '["Wifi", "Essentials", "Hangers", "Iron", "Shampoo", "Coffee maker"]',
    '["Long term stays allowed", "Smoke alarm", "Fire extinguisher", "Microwave", '
    '"Refrigerator", "Dishes and silverware", "Hot water", "Dedicated workspace"]',
    '["A,B", "Wifi"]',
)

AUTOMATED_NOTICE = ("This is an automated posting. The host canceled this reservation "
                    "before arrival.")


# Reviewer ids start here, beyond 32 bits.
REVIEWER_BASE = 600000000000000000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case_by(key, values):
    expr = None
    for i, v in enumerate(values):
        lit_v = F.lit(v).cast("string")
        expr = F.when(key == i, lit_v) if expr is None else expr.when(key == i, lit_v)
    return expr


def review_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polarity table (word, polarity) over the words of ``documents``: every word whose length
    leaves 1 when divided by 3, with a polarity from its length and its count of the letter e."""
    words = read_table(spark, sf_dir, "documents").select(
        F.explode(whitespace_tokens(F.lower("text"))).alias("w")).select(
        strip_punctuation("w").alias("word")).where(F.length("word") % 3 == 1).distinct()
    n = F.length("word")
    return words.select("word", (((n * 7 + (n - F.length(F.translate("word", "e", ""))) * 5) % 21
                                  - 10) / F.lit(10.0)).alias("polarity"))


def _place(origin, key, step, span):
    """A coordinate on a lattice of thousandths, moved by a key-dependent ten-millionth part
    so that positions are distinct and their number grows with the table."""
    return origin + ((key * step) % span).cast("double") / F.lit(1000.0) \
        + ((key * 7919) % 9973).cast("double") / F.lit(10000000.0)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listing table (text columns as in the listing CSV) from ``part``."""
    part = read_table(spark, sf_dir, "part")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key, size = F.col("p_partkey"), F.col("p_size")
    joined = part.join(F.broadcast(nation), (size % 24) == F.col("n_nationkey"), "left")
    return joined.select(
        key.alias("id"),
        _place(F.lit(49.0), key, 37, 500).alias("latitude"),
        _place(F.lit(-123.5), key, 91, 1500).alias("longitude"),
        F.when(key % 17 == 0, F.lit(None).cast("string"))
        .otherwise(F.date_add(F.lit("2010-01-01").cast("date"), (key % 4000).cast("int"))
                   .cast("string")).alias("host_since"),
        F.col("n_name").alias("neighbourhood_cleansed"),
        F.col("p_type").alias("room_type"),
        (F.lit(1) + size % 8).cast("string").alias("accommodates"),
        _case_by(size % 9, BATH_TEXTS).alias("bathrooms_text"),
        F.when(size % 7 == 0, F.lit(None).cast("string"))
        .otherwise((F.lit(1) + size % 4).cast("string")).alias("beds"),
        _case_by(size % 6, AMENITY_TEXTS).alias("amenities"),
        F.concat(F.lit("$"), F.format_number(F.col("p_retailprice") * (F.lit(1) + size % 3), 2))
        .alias("price"),
        (size % 31).cast("string").alias("availability_30"),
    )


def neighbourhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbourhood dimension (name list of the map) from ``nation``."""
    return read_table(spark, sf_dir, "nation").select(
        F.lit(None).cast("string").alias("neighbourhood_group"),
        F.col("n_name").alias("neighbourhood"),
    )


def osm_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map nodes (id, timestamp, lat, lon, tags) from ``customer``.

    Tags follow ``c_custkey % 8``: each branch of the category rule, near
    misses, a node of no interest and (for ``% 16 == 7``) an empty map. Some
    nodes fall outside the default bounding box (lat up to 49.52).
    """
    cust = read_table(spark, sf_dir, "customer")
    k, name = F.col("c_custkey"), F.col("c_name")
    m = F.create_map
    lit = F.lit
    shop_kind = F.when(k % 3 == 0, lit("mall")).when(k % 3 == 1, lit("convenience")) \
        .otherwise(lit("supermarket"))
    food_kind = F.when(k % 3 == 0, lit("restaurant")).when(k % 3 == 1, lit("fast_food")) \
        .otherwise(lit("food_court"))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    tags = (
        F.when(k % 8 == 0, m(lit("public_transport"), lit("station"), lit("subway"), lit("yes"),
                             lit("name"), name))
        .when(k % 8 == 1, m(lit("public_transport"), lit("platform"), lit("bus"), lit("yes"),
                            lit("name"), name))
        .when(k % 8 == 2, m(lit("shop"), shop_kind, lit("name"), name))
        .when(k % 8 == 3, m(lit("amenity"), food_kind, lit("name"), name))
        .when(k % 8 == 4, m(lit("public_transport"), lit("station"), lit("bus"), lit("yes")))
        .when(k % 8 == 5, m(lit("shop"), lit("mall"), lit("amenity"), lit("restaurant")))
        .when(k % 8 == 6, m(lit("building"), lit("yes"), lit("amenity"), lit("bench")))
        .when(k % 16 == 7, empty)
        .otherwise(m(lit("highway"), lit("crossing")))
    )
    return cust.select(
        k.alias("id"),
        F.concat(lit("2021-11-06T00:00:"), F.lpad((k % 60).cast("string"), 2, "0"), lit("Z"))
        .alias("timestamp"),
        _place(lit(49.0), k, 53, 520).alias("lat"),
        _place(lit(-123.5), k, 71, 1500).alias("lon"),
        tags.alias("tags"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar rows (listing_id, date, price, available; all but the id text) from ``lineitem``."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").alias("listing_id"),
        F.to_date("l_shipdate").cast("string").alias("date"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))).alias("price"),
        F.when(F.col("l_linenumber") == 6, F.lit(None).cast("string"))
        .when(F.col("l_linestatus") == "O", F.lit("f")).otherwise(F.lit("t")).alias("available"),
    )


def _tenths_text(n):
    return F.concat((n / 10).cast("long").cast("string"), F.lit("."), (n % 10).cast("string"))


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather text rows (date, avg_temperature, rain) from ``orders``."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.to_date("o_orderdate").cast("string").alias("date"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(_tenths_text(k % 300))
        .alias("avg_temperature"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(_tenths_text(k % 90))
        .alias("rain"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review rows (id, listing_id, reviewer_id, comments, lang) from ``documents``.

    Reviewers and listings grow with the table: each block of 2,000 documents has 101
    reviewers and 53 listings of its own. Reviewer ids have 18 digits.
    """
    d = read_table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    comments = (
        F.when(k % 31 == 0, F.lit(None).cast("string"))
        .when(k % 29 == 0, F.lit(AUTOMATED_NOTICE))
        .when(k % 10 == 0, F.concat(F.lit("Great<br/>stay "), F.col("text")))
        .otherwise(F.col("text"))
    )
    return d.select(
        k.alias("id"),
        (k % 53 + F.floor(k / 2000) * 1000).alias("listing_id"),
        (k % 101 + F.floor(k / 2000) * 1000 + F.lit(REVIEWER_BASE)).alias("reviewer_id"),
        comments.alias("comments"),
        F.col("lang"),
    )


def catalogue_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset pages (page_id, html), one per row of ``pages``: a table of the wanted city with
    three rows (one of them short), and a table of another city. By page id the tables are
    tidy, in upper case with unquoted links, with comments, scripts and open cells, or
    rows of a table inside a cell of the wanted one.
    """
    p = read_table(spark, sf_dir, "pages")
    k = F.col("page_id").cast("string")

    def row(file, cells=4, tag="td", href='<a class="x > y" href="{}">', close=True):
        link = F.concat(F.lit("http://data.example.com/canada/bc/2021-"), k, F.lit("/data/"),
                        F.lit(file))
        anchor, end = href.split("{}")
        tds = [F.concat(F.lit("day "), k), F.concat(F.lit("City "), k),
               F.concat(F.lit(anchor), link, F.lit(end + " <b>"), F.lit(file), F.lit("</b></a>")),
               F.concat(F.lit("Data of "), F.replace("url", F.lit("&"), F.lit("&amp;")))][:cells]
        tr = "TR" if tag == "TD" else "tr"
        ends = (f"</{tag}>", f"</{tr}>\n") if close else ("\n", "\n")
        return F.concat(F.lit(f"<{tr}>"), *[
            x for t in tds for x in (F.lit(f"<{tag}>"), t, F.lit(ends[0]))], F.lit(ends[1]))

    def table(city, *rows, start="<table class="):
        return F.concat(F.lit(f'{start}"table table-hover table-striped {city}">'),
                        *rows, F.lit("</table>"))

    def page(*rows, **form):
        return F.concat(table("victoria", row("other.csv")), table("vancouver", *rows, **form),
                        table("vancouver", row("later.csv")))

    tidy = page(row("listings.csv"), row("short.csv", 3), row("reviews.csv"))
    upper = {"tag": "TD", "href": "<A HREF={}>"}
    loud = page(row("listings.csv", **upper), row("short.csv", 3, **upper),
                row("reviews.csv", **upper), start="<TABLE\n ID=t CLASS = ")
    ragged = page(F.lit("<!-- </table><tr><td>1<td>2<td>3<td>4 --><tbody>"),
                  row("listings.csv", close=False), row("short.csv", 3, close=False),
                  F.lit("<script>document.write('<tr></table>')</script>"),
                  row("reviews.csv", close=False), F.lit("</tbody>"))
    nested = page(F.lit("<tr><td>files<table>"), row("listings.csv"),
                  F.lit("</table></td></tr>"), row("short.csv", 3), row("reviews.csv"))
    kind = F.col("page_id") % 4
    return p.select("page_id", F.when(kind == 1, loud).when(kind == 2, ragged).when(
        kind == 3, nested).otherwise(tidy).alias("html"))


def price_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host requests with coordinates (host_id, lat, lon, slope), one per ``part`` row."""
    lst = listings(spark, sf_dir)
    return lst.select(F.col("id").alias("host_id"), F.col("latitude").alias("lat"),
                      F.col("longitude").alias("lon"), F.lit(1.2).alias("slope"))


def hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host requests for the price sweep, one per ``part`` row.

    ``intercept`` (4.0 .. 5.99) / ``slope`` describe the closed-form log-price curve
    ``log_price = intercept - slope * occupancy`` used where no fitted model
    is wanted (an oracle exists for it).
    """
    part = read_table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return part.select(
        key.alias("host_id"),
        (F.lit(4.0) + (key % 200).cast("double") / F.lit(100.0)).alias("intercept"),
        F.lit(1.2).alias("slope"),
    )
