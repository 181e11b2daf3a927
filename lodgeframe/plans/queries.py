"""Named queries: (spark, sf_dir) -> DataFrame, one per operator group of the survey.

Every query reads the driver's tables (or views Spark derives from them)
in full. Rounding mirrors ``lodgeframe.plans.oracle`` so both sides hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.functions import parse as P
from lodgeframe.operators import geo, gram as G, language as LM, listings as L, model as M, paradigms as PD, polarity as PO, profit, recommend as R
from lodgeframe.operators import summaries as S, text as TX
from lodgeframe.session import configure
from lodgeframe.sources import catalogue, fixtures as FX

Query = Callable[[SparkSession, str], DataFrame]


def _pois(spark, sf_dir):
    return geo.poi_table(FX.osm_nodes(spark, sf_dir))


def _cleaned(spark, sf_dir, keep_missing=False):
    return L.cleaned_listing(FX.listings(spark, sf_dir), _pois(spark, sf_dir),
                             keep_missing=keep_missing)


def _model_input(spark, sf_dir):
    """Model training table: every listing (zero counts kept, unlimited nearest shop).

    The parity table drops listings lacking a POI category nearby and can be
    empty on small inputs, which no model can be fitted on.
    """
    return _cleaned(spark, sf_dir, keep_missing=True)


def _dicts(spark):
    return (TX.stop_words_table(spark), TX.lemma_table(spark), TX.lexicon_table(spark))


def _en_reviews(spark, sf_dir):
    prepared = TX.prepare_reviews(FX.reviews(spark, sf_dir))
    return prepared.where(F.col("lang") == "en").drop("lang")


def _scores(spark, sf_dir):
    sw, lem, lex = _dicts(spark)
    return TX.review_scores(FX.reviews(spark, sf_dir), sw, lem, lex)


# --- listings / summaries ---------------------------------------------------

def q_listing_typed(spark, d):
    return L.parse_listings(FX.listings(spark, d))


def q_price_parse(spark, d):
    cal = FX.calendar(spark, d)
    return cal.select("listing_id", "date", P.price_drop_first("price").alias("price"),
                      P.price_strip("price").alias("price_value"))


def q_amenity_values(spark, d):
    return S.amenity_values(FX.listings(spark, d))


def q_amenity_frequency(spark, d):
    return S.amenity_frequency(FX.listings(spark, d))


def q_amenity_terms(spark, d):
    return S.amenity_terms(FX.listings(spark, d))


def q_amenity_price_corr(spark, d):
    return S.amenity_price_corr(FX.listings(spark, d)).select(F.round("r", 8).alias("r"))


def _price_by(dim):
    def q(spark, d):
        out = S.price_by(S.chart_frame(FX.listings(spark, d)), dim)
        return out.select(dim, "count", F.round("price", 6).alias("price"))
    return q


def q_price_by_all_dims(spark, d):
    out = S.price_by_all_dims(S.chart_frame(FX.listings(spark, d)))
    return out.select("dimension", "value", "count", F.round("price", 6).alias("price"))


def q_monthly_price(spark, d):
    return S.monthly_price(FX.calendar(spark, d)).select(
        "month", F.round("price", 6).alias("price"))


def q_monthly_weather(spark, d):
    return S.monthly_weather(FX.weather_daily(spark, d))


# --- geo ----------------------------------------------------------------------

def q_poi_nodes(spark, d):
    kept = geo.extract_nodes(FX.osm_nodes(spark, d))
    return kept.select("id", "timestamp", "lat", "lon", F.size("tags").alias("n_tags"))


def q_poi_category(spark, d):
    return _pois(spark, d)


def q_radius_pairs(spark, d):
    locs = geo.listing_locations(FX.listings(spark, d))
    pois = _pois(spark, d).select("osm_id", "category", F.col("lat").alias("plat"),
                                  F.col("lon").alias("plon"))
    pairs = geo.radius_join(locs, pois, 2000.0, right_lat="plat", right_lon="plon",
                            left_key="listing_id")
    return pairs.select("listing_id", "osm_id", "category", F.round("dist", 3).alias("dist"))


def _features(keep_missing, by_cells=False):
    def q(spark, d):
        f = geo.poi_features(geo.listing_locations(FX.listings(spark, d)), _pois(spark, d),
                             keep_missing=keep_missing, by_cells=by_cells)
        return f.withColumn("nearest_shop_m", F.round("nearest_shop_m", 3))
    return q


def q_nearest_shop(spark, d):
    locs = geo.listing_locations(FX.listings(spark, d))
    shops = _pois(spark, d).where(F.col("category") == "shopping")
    near = geo.nearest(locs, shops, "listing_id")
    return near.select("listing_id", F.round("nearest_m", 3).alias("nearest_m"))


def q_cleaned_listing(spark, d):
    return _cleaned(spark, d).withColumn("nearest_shop_m", F.round("nearest_shop_m", 3))


def q_cleaned_listing_all(spark, d):
    return _cleaned(spark, d, keep_missing=True) \
        .withColumn("nearest_shop_m", F.round("nearest_shop_m", 3))


def q_neighbourhood_prices(spark, d):
    out = S.neighbourhood_prices(_cleaned(spark, d), FX.neighbourhoods(spark, d))
    return out.select("neighbourhood_cleansed", F.round("price", 6).alias("price"))


# --- text ---------------------------------------------------------------------

def q_review_tokens(spark, d):
    return TX.tokens(_en_reviews(spark, d).select("id", "comments"))


def q_review_clean_tokens(spark, d):
    sw, lem, _ = _dicts(spark)
    return TX.clean_tokens(_en_reviews(spark, d).select("id", "comments"), sw, lem)


def q_review_joined(spark, d):
    sw, lem, _ = _dicts(spark)
    return TX.joined_tokens(TX.clean_tokens(_en_reviews(spark, d).select("id", "comments"),
                                            sw, lem))


def q_review_language_model(spark, d):
    """Languages of all reviews by the n-gram model of the labelled documents."""
    model = LM.train(FX.read_table(spark, d, "documents"))
    return LM.identify(TX.prepare_reviews(FX.reviews(spark, d)), model)


def q_language_held_out(spark, d):
    """Texts of the held-out documents per true and found language, trained on the others."""
    docs = FX.read_table(spark, d, "documents").select("doc_id", "lang", "text")
    train, held = M.hash_split(docs, "doc_id", (0.8, 0.2), 5)
    found = LM.identify(held, LM.train(train), "doc_id", "text")
    return held.select("doc_id", F.col("lang").alias("truth")).join(found, "doc_id") \
        .groupBy("truth", F.col("lang").alias("found")).agg(F.count(F.lit(1)).alias("n"))


def q_review_language(spark, d):
    prepared = TX.prepare_reviews(FX.reviews(spark, d)).drop("lang")
    return TX.detect_language(prepared, TX.lang_words_table(spark))


def q_review_score(spark, d):
    return _scores(spark, d).withColumn("score", F.round("score", 6))


def q_review_score_corpus(spark, d):
    """Scores with a lexicon as large as the corpus vocabulary, and with negation."""
    sw, lem, _ = _dicts(spark)
    out = TX.review_scores(FX.reviews(spark, d), sw, lem, FX.review_lexicon(spark, d),
                           negation=True)
    return out.select("id", "reviewer_id", F.round("score", 6).alias("score"))


def q_lemma_forms(spark, d):
    """Plural forms of a noun table as large as the part names' vocabulary."""
    names = FX.read_table(spark, d, "part").select(
        F.explode(F.split("p_name", " ")).alias("word")).distinct()
    return TX.noun_forms(names)


def _english_words(spark, d):
    return PD.vocabulary(FX.read_table(spark, d, "documents").where(F.col("lang") == "en"))


def q_lemma_paradigms(spark, d):
    """Suffix paradigms of the English documents' vocabulary."""
    return PD.paradigms(_english_words(spark, d))


def q_induced_lemmas(spark, d):
    """Lemmas that these paradigms give to the words of the English documents."""
    return PD.induced_lemmas(_english_words(spark, d))


def _spread_lexicon(spark, d):
    docs = FX.read_table(spark, d, "documents").where(F.col("lang") == "en")
    return PO.spread(PO.neighbours(docs), FX.review_lexicon(spark, d))


def q_lexicon_spread(spark, d):
    """The fixture's lexicon spread over the words of the English documents."""
    return _spread_lexicon(spark, d).select(
        "word", F.round(F.col("polarity").cast("decimal(20,12)"), 6).cast("double").alias("polarity"),
        "seed")


def q_review_polarity_scoped(spark, d):
    """Polarity of every review with the spread lexicon, intensifiers and negators in scope."""
    toks = PO.scoped_tokens(TX.by_id(TX.prepare_reviews(FX.reviews(spark, d))))
    return PO.scoped_polarity(toks, _spread_lexicon(spark, d)).select(
        "id", F.round("polarity", 6).alias("polarity"), "words")


def q_topk_per_reviewer(spark, d):
    s = _scores(spark, d).select("reviewer_id", "listing_id", "id",
                                 F.round("score", 6).alias("score"))
    return R.top_k_per_group(s, "reviewer_id",
                             [F.col("score").desc(), F.col("listing_id"), F.col("id")], 3)


def q_link_catalogue(spark, d):
    return catalogue.page_links(FX.read_table(spark, d, "pages"))


# --- models -------------------------------------------------------------------

def q_label_index(spark, d):
    typed = L.parse_listings(FX.listings(spark, d))
    parts = [M.label_index(typed, c).select(F.lit(c).alias("column_name"), "value", "index")
             for c in ("neighbourhood_cleansed", "room_type")]
    return parts[0].unionByName(parts[1])


def q_hash_split(spark, d):
    lst = FX.listings(spark, d).select("id")
    train, valid = M.hash_split(lst, "id", (0.8, 0.2), seed=5)
    return train.withColumn("part", F.lit(0)).unionByName(valid.withColumn("part", F.lit(1)))


def q_price_ridge_1f(spark, d):
    typed = L.parse_listings(FX.listings(spark, d)).withColumn(
        "x", F.col("future_occupancy").cast("double"))
    fit = M.one_feature_ridge(typed, "x")
    return fit.select(F.round("slope", 8).alias("slope"), F.round("intercept", 8).alias("intercept"))


def q_price_glm_predict(spark, d):
    _, pred = G.fit(_model_input(spark, d))
    return pred.select("id", F.round("label", 6).alias("label"),
                       F.round("prediction", 6).alias("prediction"))


def q_price_glm_rmse(spark, d):
    _, pred = G.fit(_model_input(spark, d))
    return M.rmse(pred).select(F.round("rmse", 8).alias("rmse"))


def q_price_glm_cv(spark, d):
    table = G.tune(_model_input(spark, d))[1]
    return table.select("reg_param", "is_best", *[F.round(c, 8).alias(c) for c in
                                                  ("cv_rmse", "train_rmse", "validation_rmse")])


def _one_feature(spark, d):
    """Typed listings with the single feature x; rows without it cannot be scored."""
    return L.parse_listings(FX.listings(spark, d)).withColumn(
        "x", F.col("future_occupancy").cast("double")).where(F.col("x").isNotNull())


def q_price_rmse_1f(spark, d):
    train, valid = M.hash_split(M.log_label(_one_feature(spark, d)), "id", (0.8, 0.2), 5)
    fit = M.one_feature_ridge(train, "x").first()
    pred = valid.withColumn("prediction", F.lit(fit["intercept"]) + F.lit(fit["slope"]) * F.col("x"))
    return M.rmse(pred).select(F.round("rmse", 8).alias("rmse"))


def q_price_cv_1f(spark, d):
    table = M.tune_price_model(_one_feature(spark, d), features=("x",))[1]
    return table.select("reg_param", "is_best", *[F.round(c, 8).alias(c) for c in
                                                  ("cv_rmse", "train_rmse", "validation_rmse")])


def q_price_glm_2f(spark, d):
    typed = _one_feature(spark, d).withColumn("z", F.col("accommodates").cast("double"))
    return M.coefficients(typed, ("x", "z")).select("feature", F.round("value", 8).alias("value"))


def q_price_glm_profit(spark, d):
    model, valid = G.fit(_model_input(spark, d))
    requests = valid.drop("future_occupancy", *G.INDEXES).withColumnRenamed("id", "host_id")
    return profit.best_price(model.lines(requests), profit.closed_form_log_price())


def q_als_grid(spark, d):
    return R.als_grid(_scores(spark, d))


def q_als_recommend(spark, d):
    return R.recommend(_scores(spark, d))


def q_als_split(spark, d):
    """Rows of the ALS train / validation / test parts."""
    parts = R.split_ratings(R.ratings(_scores(spark, d)))
    out = None
    for i, p in enumerate(parts):
        n = p.agg(F.lit(i).alias("part"), F.count(F.lit(1)).alias("n"),
                  F.countDistinct("reviewer_id").alias("reviewers"))
        out = n if out is None else out.unionByName(n)
    return out


def _recommend_facts(recs, scores):
    """Per reviewer: rows, distinct listings, listings unseen in training, negative ratings."""
    seen = R.split_ratings(R.ratings(scores))[0].select("listing_id").distinct() \
        .withColumn("seen", F.lit(1))
    return recs.join(seen, "listing_id", "left").groupBy("reviewer_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("listing_id").alias("listings"),
        F.count_if(F.col("seen").isNull()).alias("unseen"),
        F.count_if(F.col("rating") < 0).alias("negative"))


def q_als_recommend_facts(spark, d):
    s = _scores(spark, d)
    return _recommend_facts(R.recommend(s), s)


def q_als_recommend_users(spark, d):
    """Recommendations for given users: the reviewers of French reviews."""
    s = _scores(spark, d)
    users = FX.reviews(spark, d).where(F.col("lang") == "fr").select("reviewer_id")
    return _recommend_facts(R.recommend(s, users), s)


def q_optimise(spark, d):
    """Requests with coordinates -> POI features -> sweep -> best price."""
    def predict(grid):
        level = F.lit(4.0) + F.least(F.col("num_shop_2km"), F.lit(100)) / F.lit(100.0) \
            + F.least(F.col("num_restaurant_2km"), F.lit(50)) / F.lit(100.0)
        return grid.withColumn("prediction",
                               level - F.col("slope") * F.col("future_occupancy"))
    return profit.optimise(FX.price_requests(spark, d), _pois(spark, d), predict)


def q_catalogue_rows(spark, d):
    return catalogue.catalogue_rows(FX.catalogue_pages(spark, d), "Vancouver")


def q_availability(spark, d):
    return FX.calendar(spark, d).select("listing_id", "date",
                                        P.availability_flag("available").alias("taken"))


def q_type_flags(spark, d):
    return FX.listings(spark, d).select(
        "id", P.contains_flag("room_type", "ECONOMY").alias("economy"),
        P.contains_flag("bathrooms_text", "shared").alias("shared_bath"))


def q_profit_curve(spark, d):
    return profit.profit_curve(FX.hosts(spark, d), profit.closed_form_log_price())


def q_best_price(spark, d):
    return profit.best_price(FX.hosts(spark, d), profit.closed_form_log_price())


QUERIES: dict[str, Query] = {
    "listing_typed": q_listing_typed,
    "price_parse": q_price_parse,
    "amenity_values": q_amenity_values,
    "amenity_frequency": q_amenity_frequency,
    "amenity_terms": q_amenity_terms,
    "amenity_price_corr": q_amenity_price_corr,
    "price_by_room_type": _price_by("room_type"),
    "price_by_accommodates": _price_by("accommodates"),
    "price_by_beds": _price_by("beds"),
    "price_by_baths": _price_by("baths"),
    "price_by_neighbourhood": _price_by("neighbourhood_cleansed"),
    "price_by_all_dims": q_price_by_all_dims,
    "monthly_price": q_monthly_price,
    "monthly_weather": q_monthly_weather,
    "poi_nodes": q_poi_nodes,
    "poi_category": q_poi_category,
    "radius_pairs": q_radius_pairs,
    "listing_poi_features": _features(False),
    "listing_poi_features_all": _features(True),
    "listing_poi_features_cells": _features(True, by_cells=True),
    "nearest_shop": q_nearest_shop,
    "cleaned_listing": q_cleaned_listing,
    "cleaned_listing_all": q_cleaned_listing_all,
    "neighbourhood_prices": q_neighbourhood_prices,
    "review_tokens": q_review_tokens,
    "review_clean_tokens": q_review_clean_tokens,
    "review_joined": q_review_joined,
    "review_language": q_review_language,
    "review_language_model": q_review_language_model,
    "language_held_out": q_language_held_out,
    "review_score": q_review_score,
    "review_score_corpus": q_review_score_corpus,
    "lemma_forms": q_lemma_forms,
    "lemma_paradigms": q_lemma_paradigms,
    "induced_lemmas": q_induced_lemmas,
    "lexicon_spread": q_lexicon_spread,
    "review_polarity_scoped": q_review_polarity_scoped,
    "topk_per_reviewer": q_topk_per_reviewer,
    "link_catalogue": q_link_catalogue,
    "catalogue_rows": q_catalogue_rows,
    "availability": q_availability,
    "type_flags": q_type_flags,
    "label_index": q_label_index,
    "hash_split": q_hash_split,
    "price_ridge_1f": q_price_ridge_1f,
    "price_rmse_1f": q_price_rmse_1f,
    "price_cv_1f": q_price_cv_1f,
    "price_glm_2f": q_price_glm_2f,
    "price_glm_predict": q_price_glm_predict,
    "price_glm_rmse": q_price_glm_rmse,
    "price_glm_cv": q_price_glm_cv,
    "price_glm_profit": q_price_glm_profit,
    "als_grid": q_als_grid,
    "als_split": q_als_split,
    "als_recommend": q_als_recommend,
    "als_recommend_facts": q_als_recommend_facts,
    "als_recommend_users": q_als_recommend_users,
    "optimise": q_optimise,
    "profit_curve": q_profit_curve,
    "best_price": q_best_price,
}


def queries() -> dict[str, Query]:
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {k: wrap(v) for k, v in QUERIES.items()}
