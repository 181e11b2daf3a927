"""Aggregates: mean of means, weather divisor, grouping sets, amenities."""

import pytest

from lodgeframe.operators import summaries as S


def test_mean_of_means(spark):
    cal = spark.createDataFrame(
        [(1, "2021-04-01", "$10.00"), (1, "2021-04-02", "$20.00"), (2, "2021-04-03", "$40.00"),
         (3, "2021-05-01", None), (3, "bad", "$5.00")],
        "listing_id long, date string, price string")
    out = {r["month"]: r["price"] for r in S.monthly_price(cal).collect()}
    assert out[4] == pytest.approx(27.5)
    assert out[5] is None


def test_mean_of_means_by_year(spark):
    cal = spark.createDataFrame(
        [(1, "2021-04-01", "$10.00"), (1, "2022-04-02", "$20.00"), (2, "2022-04-03", "$40.00")],
        "listing_id long, date string, price string")
    plain = {r["month"]: r["price"] for r in S.monthly_price(cal).collect()}
    yearly = {(r["year"], r["month"]): r["price"]
              for r in S.monthly_price(cal, by_year=True).collect()}
    assert plain == {4: pytest.approx(27.5)}
    assert yearly == {(2021, 4): 10.0, (2022, 4): 30.0}


def test_weather_divisor(spark):
    w = spark.createDataFrame([("2021-01-01", "1", "2"), ("2021-01-02", None, "4")],
                              "date string, avg_temperature string, rain string")
    r = S.monthly_weather(w).first()
    assert (r["month"], r["rain"], r["temp"]) == (1, 6.0, 1.0)


def test_all_dims_equals_single(spark):
    lst = spark.createDataFrame(
        [(1, "A", "2", None, "Hood", "$10.00", "1 bath"),
         (2, "A", "10", "3", "Hood", "$20.00", "1.5 shared baths"),
         (3, "B", "2", "3", None, None, None)],
        "id long, room_type string, accommodates string, beds string, "
        "neighbourhood_cleansed string, price string, bathrooms_text string")
    frame = S.chart_frame(lst)
    both = {(r["dimension"], r["value"]): (r["count"], r["price"])
            for r in S.price_by_all_dims(frame).collect()}
    for d in S.PRICE_DIMENSIONS:
        for r in S.price_by(frame, d).collect():
            key = (d, None if r[d] is None else str(r[d]))
            assert both[key] == (r["count"], r["price"])


def test_amenity_frequency_and_corr(spark):
    lst = spark.createDataFrame([(1, '["Wifi", "TV"]', "$100.00"), (2, "[]", "$50.00"),
                                 (3, '["wifi"]', "$2,000.00")],
                                "id long, amenities string, price string")
    freq = {r["item"]: r["count"] for r in S.amenity_frequency(lst).collect()}
    assert freq == {'"wifi"': 2, '"tv"': 1, "": 1}
    r = S.amenity_price_corr(lst).first()["r"]
    assert r == pytest.approx(1.0)
