"""Round trips through the sinks and sources; XML node scan; malformed-row handling."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeframe.operators import geo
from lodgeframe.sources import catalogue
from lodgeframe.sources import io as IO


def test_csv_round_trip_quotes_newlines(spark, tmp_path):
    rows = [("1", 'He said "hi", then\nleft', "$1,234.50"), ("2", None, ""), ("3", "ünï, ok", "x")]
    df = spark.createDataFrame(rows, "id string, comments string, price string")
    path = str(tmp_path / "out")
    IO.write_csv(df, path, single_file=True)
    back = IO.read_text_csv(spark, path, ["id", "comments", "price"])
    got = sorted(tuple(r) for r in back.collect())
    # CSV cannot tell NULL from empty text: both come back as NULL.
    assert got == sorted([("1", 'He said "hi", then\nleft', "$1,234.50"), ("2", None, None),
                          ("3", "ünï, ok", "x")])


def test_drop_malformed_independent_of_projection(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("id,listing_id,score\n1,10,0.5\n2,x,0.7\n3,30\n4,40,0.9\n")
    schema = T.StructType([T.StructField("id", T.LongType()),
                           T.StructField("listing_id", T.LongType()),
                           T.StructField("score", T.DoubleType())])
    df = IO.read_typed_csv_drop_malformed(spark, str(path), schema)
    assert sorted(r["id"] for r in df.collect()) == [1, 4]
    assert df.select("id").count() == 2 and df.count() == 2


def test_json_round_trip_with_map(spark, tmp_path):
    df = spark.createDataFrame([(1, "t", 49.1, -123.1, {"shop": "mall", "name": "A"})],
                               IO.NODE_SCHEMA)
    path = str(tmp_path / "nodes")
    IO.write_json(df, path)
    back = IO.read_json(spark, path, IO.NODE_SCHEMA)
    assert back.first().asDict() == df.first().asDict()


def test_xml_nodes(spark, tmp_path):
    xml = """<osm>
<node id="1" lat="49.2" lon="-123.1" timestamp="t1"><tag k="shop" v="mall"/><tag k="name" v="M"/></node>
<way id="9"><nd ref="1"/></way>
<node id="2" lat="49.3" lon="-123.2" timestamp="t2"/>
<node id="3" lat="49.4" lon="-123.3" timestamp="t3"><tag k="amenity" v="cafe"/><tag k="amenity" v="restaurant"/></node>
</osm>"""
    p = tmp_path / "map.osm"
    p.write_text(xml)
    nodes = IO.read_osm_xml(spark, str(p))
    got = {r["id"]: r["tags"] for r in nodes.collect()}
    assert got == {1: {"shop": "mall", "name": "M"}, 2: {}, 3: {"amenity": "restaurant"}}
    pois = {r["osm_id"]: r["category"] for r in geo.poi_table(nodes).collect()}
    assert pois == {1: "shopping", 3: "restaurant"}


def test_catalogue_rows(spark):
    html = ('<table class="table table-hover table-striped porto"><tr><th>h</th></tr>'
            '<tr><td>06 November, 2021</td><td>Porto</td>'
            '<td><a href="http://x/pt/norte/porto/2021-11-06/data/listings.csv.gz">listings.csv.gz</a></td>'
            '<td>Detailed Listings data</td></tr><tr><td>only</td><td>three</td><td>cells</td></tr>'
            '</table><table class="table table-hover table-striped london"><tr><td>a</td><td>b</td>'
            '<td>c</td><td>d</td></tr></table>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    rows = catalogue.catalogue_rows(pages, "Porto").collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["file_name"] == "Porto_2021-11-06_listings.csv.gz"
    assert r["link"].endswith("listings.csv.gz") and r["description"] == "Detailed Listings data"
    links = catalogue.page_links(pages).collect()
    assert [x["segment"] for x in links] == ["2021-11-06"]


CITY = '<table class="table table-hover table-striped porto">'
CELL = '<td><a href="http://x/a/{0}/b/c">{0}</a></td>'


def _catalogue(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    return sorted(tuple(r) for r in catalogue.catalogue_rows(df, "porto").collect())


def _four(n):
    return f"<td>d{n}</td><td>c{n}</td>{CELL.format(f'f{n}')}<td>t{n}</td>"


def _row(page, n):
    return page, f"d{n}", f"c{n}", f"c{n}_f{n}_f{n}", f"t{n}", f"http://x/a/f{n}/b/c"


def test_catalogue_rows_of_untidy_pages(spark):
    pages = [
        # Any case, unquoted and odd attributes, a class over two lines.
        "<TABLE data-x='<td class=\"q\">' Class='table  table-hover\ntable-striped porto'><Tr>"
        "<TD>d1</TD><TD>c1</TD><TD><A title=\"a > b href=no\" HREF=http://x/a/f1/b/c>f1</A></TD>"
        "<TD>t1</TD></Tr></TABLE>",
        # Cells and rows left open, a table left open, a comment that is never closed.
        CITY + "<tr><td>d2<td>c2" + CELL.format("f2") + "<td>t2<tr><td>a<td>b<td>c<!-- <td>d",
        # Closings of nothing, comments, scripts, styles and a bare sign.
        "</table></td></table>" + CITY + "<!-- </table> <tr> --><script>'</table>'</script>"
        "<style><td></style><tr>" + _four(3) + "</tr></table><tr>" + _four(9) + "</tr>",
        # A table in a cell: its rows count, its row's cells count for the outer row too.
        CITY + "<tr><td><table><tr>" + _four(4) + "</tr></table></td></tr><tr>" + _four(5) +
        "</tr></table>",
        # Only the first table of the class; header cells are no cells; a link elsewhere.
        CITY + "<tr><th>h</th>" + _four(6) + "</tr><tr><td>d<td>c<td>no link<td>"
        "<a href='http://x/y/z'>t</a></tr></table>" + CITY + "<tr>" + _four(7) + "</tr></table>",
        # Named characters in text and link, a sign that opens no tag.
        CITY + "<tr><td> a &lt; b < c </td><td>c&amp;lt;</td><td><a href='/a/s/b?x&amp;y/c'>&nbsp;f"
        "</a></td><td><b>t</b>u</td></tr></table>",
        None, "", "<table>", "<table class=porto><tr>" + _four(8) + "</tr></table>"]
    assert _catalogue(spark, *pages) == [
        _row(0, 1), _row(1, 2), _row(2, 3), _row(3, 4), _row(3, 5),
        (4, "d", "c", None, "t", None), _row(4, 6),
        (5, "a < b < c", "c&lt;", "c&lt;_s_f", "tu", "/a/s/b?x&y/c")]


def test_catalogue_rows_of_repeated_and_long_pages(spark):
    page = CITY + "".join(f"<tr>{_four(i % 7)}</tr>" for i in range(3000)) + "</table>"
    runs = ["<" * 200_000, "<!--" * 50_000, "<td \"" * 50_001, "<a " * 100_000, "</" * 100_000,
            "<table " + "a='1' " * 50_000]
    df = spark.createDataFrame([(1, page), (1, page), (None, page), *((9, r) for r in runs)],
                               "page_id long, html string")
    rows = catalogue.catalogue_rows(df, "porto").groupBy("page_id").count().collect()
    assert {r["page_id"]: r["count"] for r in rows} == {1: 6000, None: 3000}


def test_catalogue_parts_are_not_merged(spark):
    page = CITY + "<tr>" + _four(1) + "</tr></table>" + "<p>text</p>" * 100
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit(page).alias("html"))
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rows = catalogue.catalogue_rows(pages, "porto").groupBy(
            F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert sum(r["count"] for r in rows) == 400
    # Merged to one part, with all events in the memory of one task, before.
    assert len(rows) > 50 and max(r["count"] for r in rows) < 40


def test_model_save_load(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "v string")
    model = Pipeline(stages=[StringIndexer(inputCol="v", outputCol="i")]).fit(df)
    path = os.path.join(str(tmp_path), "m")
    IO.save_model(model, path)
    back = IO.load_model(path)
    assert back.transform(df).select("i").collect() == model.transform(df).select("i").collect()


def test_partitioned_gzip_and_header_csv(spark, tmp_path):
    recs = spark.createDataFrame([(7, 1, 4.5), (7, 2, 4.0), (8, 3, 3.5)],
                                 "reviewer_id int, listing_id int, rating double")
    per_user = str(tmp_path / "recs")
    IO.write_partitioned_csv(recs, per_user, "reviewer_id")
    assert sorted(p.name for p in (tmp_path / "recs").iterdir() if p.is_dir()) == \
        ["reviewer_id=7", "reviewer_id=8"]
    back = spark.read.option("header", "true").csv(per_user)
    assert sorted((int(r["reviewer_id"]), int(r["listing_id"])) for r in back.collect()) == \
        [(7, 1), (7, 2), (8, 3)]

    gz = str(tmp_path / "dist")
    IO.write_csv(recs, gz, mode="overwrite", compression="gzip")
    assert any(p.name.endswith(".csv.gz") for p in (tmp_path / "dist").iterdir())
    by_header = IO.read_text_csv(spark, gz)
    assert by_header.columns == ["reviewer_id", "listing_id", "rating"]
    assert dict(by_header.dtypes) == {c: "string" for c in by_header.columns}
    assert by_header.count() == 3


def test_parquet_sink_partitioned(spark, tmp_path):
    df = spark.createDataFrame([(1, "bus"), (2, "shopping")], "osm_id long, category string")
    path = str(tmp_path / "poi")
    IO.write_parquet(df, path, partition_by=["category"])
    back = spark.read.parquet(path).where("category = 'bus'")
    assert [r["osm_id"] for r in back.collect()] == [1]


def test_typed_csv_and_single_file_json(spark, tmp_path):
    path = tmp_path / "clean.csv"
    path.write_text("id,price,room_type\n1,99.5,Private room\n2,,Shared room\n")
    schema = T.StructType([T.StructField("id", T.LongType()),
                           T.StructField("price", T.FloatType()),
                           T.StructField("room_type", T.StringType())])
    df = IO.read_typed_csv(spark, str(path), schema)
    assert dict(df.dtypes) == {"id": "bigint", "price": "float", "room_type": "string"}
    assert sorted(tuple(r) for r in df.collect()) == [(1, 99.5, "Private room"),
                                                       (2, None, "Shared room")]
    out = str(tmp_path / "one")
    IO.write_json(df.repartition(3), out, single_file=True)
    parts = [p for p in (tmp_path / "one").iterdir() if p.name.startswith("part-")]
    assert len(parts) == 1
    assert IO.read_json(spark, out, schema).count() == 2
