"""File-to-file jobs: map extract -> POIs -> cleaned listings -> model -> prices, and reviews."""

import csv

import pytest
from pyspark.sql import functions as F

from lodgeframe.operators import model as M
from lodgeframe.plans import jobs
from lodgeframe.sources import io

KINDS = ['<tag k="public_transport" v="platform"/><tag k="bus" v="yes"/>',
         '<tag k="public_transport" v="station"/><tag k="subway" v="yes"/>',
         '<tag k="shop" v="mall"/>', '<tag k="amenity" v="restaurant"/>', '<tag k="highway" v="x"/>']


@pytest.fixture(scope="module")
def pois(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("map")
    nodes = "\n".join(f'<node id="{i}" lat="{49.2 + i / 10000}" lon="-123.1" timestamp="t">{k}</node>'
                      for i, k in enumerate(KINDS * 3))
    (d / "map.osm").write_text(f"<osm>\n{nodes}\n</osm>")
    jobs.extract_nodes(spark, str(d / "map.osm"), str(d / "nodes"))
    jobs.categorise_nodes(spark, str(d / "nodes"), str(d / "pois"))
    return str(d / "pois")


def _listings(path, n=40):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["id", "latitude", "longitude", "host_since", "neighbourhood_cleansed", "room_type",
                    "accommodates", "bathrooms_text", "beds", "amenities", "price", "availability_30"])
        for i in range(n):
            w.writerow([900000000000000000 + i, 49.2, -123.1, "2015-01-01", f'The "West", end {i % 2}',
                        "Entire\nhome", 2 + i % 3, "1.5 shared baths", "" if i % 4 == 0 else 1 + i % 2,
                        '["Wifi", "TV"]', f"${1000 + 10 * i:,.2f}", i % 31])


def test_map_to_prices(spark, tmp_path, pois):
    assert io.read_json(spark, pois, io.POI_SCHEMA).count() == 12
    _listings(tmp_path / "listings.csv")
    out = str(tmp_path / "cleaned")
    jobs.clean_listings(spark, str(tmp_path / "listings.csv"), pois, out)
    table = spark.read.option("multiLine", "true").option("header", "true").option("escape", '"') \
        .schema(io.CLEANED_SCHEMA).csv(out)
    rows = {r["id"]: r for r in table.collect()}
    assert len(rows) == 40
    first = rows[900000000000000000]
    assert (first["num_bus_2km"], first["num_shop_2km"], first["price"], first["baths"]) == \
        (3, 3, 1000.0, 0.75)
    assert first["neighbourhood_cleansed"] == 'The "West", end 0' and first["room_type"] == "Entire\nhome"
    model = M.price_pipeline(features=("num_shop_2km", "accommodates", "future_occupancy")).fit(
        M.log_label(table))
    io.save_model(model, str(tmp_path / "model"))
    requests = spark.createDataFrame([(1, 49.2, -123.1, 3), (2, 10.0, 10.0, 3)],
                                     "host_id long, lat double, lon double, accommodates int")
    jobs.price_requests(requests, pois, str(tmp_path / "model"), str(tmp_path / "best"))
    best = spark.read.option("header", "true").option("inferSchema", "true").csv(str(tmp_path / "best"))
    got = best.collect()
    assert got and {r["host_id"] for r in got} == {1}
    assert all(r["profit"] == pytest.approx(r["price"] * r["future_occupancy"] * 30) for r in got)


def test_single_line_cleaned_table_round_trip(spark, tmp_path, pois):
    _listings(tmp_path / "listings.csv", 4)
    raw = io.read_text_csv(spark, str(tmp_path / "listings.csv")).withColumn("room_type", F.lit("home"))
    io.write_csv(raw, str(tmp_path / "flat"))
    jobs.clean_listings(spark, str(tmp_path / "flat"), pois, str(tmp_path / "out"))
    assert jobs.read_cleaned_listings(spark, str(tmp_path / "out")).count() == 4


def test_reviews_to_scores(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text(
        "listing_id,id,date,reviewer_id,reviewer_name,comments\n"
        '1,10,2021-01-01,600000000000000001,"Ann, B","The best stay of the year.<br/>And the bed"\n'
        "1,11,2021-01-02,2,Bo,Das ist der Ort und die Lage ist nicht im Haus\n"
        "x,12,2021-01-02,2,Bo,the bad row of the file\n"
        "1,13,2021-01-03,3,Cy,\n")
    jobs.score_reviews(spark, str(tmp_path / "reviews.csv"), str(tmp_path / "scores"))
    got = jobs.read_scores(spark, str(tmp_path / "scores")).collect()
    assert [(r["id"], r["reviewer_id"], float(r["score"])) for r in got] == \
        [(10, 600000000000000001, 5.0)]


@pytest.mark.parametrize("header", [True, False])
def test_catalogue_export(spark, tmp_path, header):
    cell = '<td>d</td><td>Oslo</td><td><a class="x" href=\'http://a/b/c/listings.csv\'>listings.csv</a></td><td>t</td>'
    page = f'<table class="table table-hover table-striped o+slo"><tr>{cell}</tr><tr><td>d</td><td>c</td>' \
        "<td>no link</td><td>t</td></tr></table>"
    pages = spark.createDataFrame([(1, page)], "page_id long, html string")
    jobs.export_catalogue(pages, "O+slo", str(tmp_path / "cat"), header=header)
    back = spark.read.option("header", str(header).lower()).csv(str(tmp_path / "cat")).collect()
    assert len(back) == 2
    assert {r[3] for r in back} == {"Oslo_b_listings.csv", None}
