"""Scalar expressions against the edge-case tables (expected values from the original rules)."""

import pytest
from pyspark.sql import functions as F

from lodgeframe.functions import geo as G
from lodgeframe.functions import parse as P
from lodgeframe.functions import text as T


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).first()["y"]


@pytest.mark.parametrize("text,expected", [
    ("$1,234.50", 1234.5), ("$0.00", 0.0), ("1234", 234.0), (None, None), ("$", None)])
def test_price_drop_first(spark, text, expected):
    assert one(spark, P.price_drop_first("x"), text) == expected


@pytest.mark.parametrize("text,expected", [("$1,234.50", 1234.5), ("1234", 1234.0)])
def test_price_strip(spark, text, expected):
    assert one(spark, P.price_strip("x"), text) == expected


@pytest.mark.parametrize("text,expected", [
    (None, 1.0), ("1 bath", 1.0), ("1.5 shared baths", 0.75), ("Shared half-bath", 1.0),
    ("Private half-bath", 1.0), ("0 shared baths", 0.0), (".5 bath", 0.5), ("Half-bath", 1.0),
    ("  2 baths \n", 2.0), ("1. bath", 1.0)])
def test_bath_count(spark, text, expected):
    assert one(spark, P.bath_count("x"), text) == pytest.approx(expected)


@pytest.mark.parametrize("beds,acc,expected", [(None, "3", 2), (None, "2", 1), ("4", "9", 4)])
def test_beds(spark, beds, acc, expected):
    df = spark.createDataFrame([(beds, acc)], "b string, a string")
    assert df.select(P.beds_imputed("b", "a").alias("y")).first()["y"] == expected


@pytest.mark.parametrize("text,expected", [
    (None, 0), ("2021-11-06", 0), ("2021-11-05", 1), ("2021-11-07", -1), ("junk", None)])
def test_host_days(spark, text, expected):
    assert one(spark, P.host_days("x"), text) == expected


@pytest.mark.parametrize("text,expected", [("0", 1.0), ("30", 0.0), ("10", 0.667)])
def test_occupancy(spark, text, expected):
    assert one(spark, P.occupancy("x"), text) == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize("text,expected", [
    ('["Hair dryer"]', 2), ('["Free parking"]', 1), ("[]", 0), (None, None)])
def test_amenity_score(spark, text, expected):
    assert one(spark, P.amenity_score("x"), text) == expected


@pytest.mark.parametrize("text,expected", [("[]", 1), ('["A", "B"]', 2), ('["A,B"]', 1)])
def test_amenity_list_len(spark, text, expected):
    assert one(spark, P.amenity_list_len("x"), text) == expected


def test_flags_and_month(spark):
    assert one(spark, P.availability_flag("x"), "f") == 1
    assert one(spark, P.availability_flag("x"), "t") == 0
    assert one(spark, P.availability_flag("x"), None) == 0
    assert one(spark, P.contains_flag("x", "wifi"), "has wifi") == 1
    assert one(spark, P.contains_flag("x", "tv"), "none") == 0
    assert one(spark, P.month_text("x"), "2021-04-09") == "4"
    assert one(spark, P.year_of("x"), "2021-04-09") == 2021
    assert one(spark, P.to_float("x"), "12.5") == 12.5


def test_numeric_helpers(spark):
    assert one(spark, P.exp_to_int("x"), 2.0, "x double") == 7
    assert one(spark, P.log_label("x"), 0.0, "x double") is None
    assert one(spark, P.polarity_to_rating("x"), -1.0, "x double") == 0.0
    assert one(spark, P.polarity_to_rating("x"), 0.0, "x double") == 2.5
    assert one(spark, P.polarity_to_rating("x"), 1.0, "x double") == 5.0
    f = spark.createDataFrame([(0.25,)], "x double").select(P.round_half_up("x", 1).alias("y"))
    assert f.first()["y"] == 0.3


@pytest.mark.parametrize("tags,expected", [
    ({"public_transport": "station", "subway": "yes"}, "subway"),
    ({"public_transport": "platform", "bus": "yes"}, "bus"),
    ({"public_transport": "station", "bus": "yes"}, None),
    ({"shop": "mall"}, "shopping"),
    ({"shop": "mall", "amenity": "restaurant"}, "shopping"),
    ({"amenity": "fast_food"}, "restaurant"),
    ({}, None)])
def test_poi_category(spark, tags, expected):
    df = spark.createDataFrame([(tags,)], "t map<string,string>")
    t = F.col("t")
    cat = G.poi_category(t["public_transport"], t["bus"], t["subway"], t["shop"], t["amenity"])
    assert df.select(cat.alias("y")).first()["y"] == expected


def test_box_and_keys(spark):
    df = spark.createDataFrame([(49.0, -123.5), (49.5, -122.0), (49.5001, -123.0)],
                               "lat double, lon double")
    assert [r[0] for r in df.select(G.in_box("lat", "lon")).collect()] == [True, True, False]
    m = spark.createDataFrame([({"shop": "x"},), ({"highway": "y"},), ({},)],
                              "t map<string,string>")
    assert [r[0] for r in m.select(G.has_any_key("t")).collect()] == [True, False, False]


def test_haversine(spark):
    df = spark.createDataFrame([(49.0, -123.0, 49.0, -123.0), (49.0, -123.0, 50.0, -123.0)],
                               "a double, b double, c double, d double")
    d = [r[0] for r in df.select(G.haversine_m("a", "b", "c", "d")).collect()]
    assert d[0] == 0.0
    assert d[1] == pytest.approx(111319.49, abs=0.01)


def test_text_helpers(spark):
    assert one(spark, F.lower(T.remove_line_breaks("x")), "Great<br/>stay") == "greatstay"
    toks = one(spark, T.whitespace_tokens("x"), "  the,\tdog.\n\n cat ")
    assert toks == ["the,", "dog.", "cat"]
    assert one(spark, T.whitespace_tokens("x"), "") == []
    assert one(spark, T.strip_punctuation("x"), "dog's.") == "dogs"
    assert one(spark, T.not_automated("x"), "this is an automated posting. bye") is False
