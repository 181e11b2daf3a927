"""Plan checks: no Python UDF in any registered SQL-checkable query, pushdown reaches scans."""

import pytest

import __spark_entry__ as E
from lodgeframe.plans import oracle as O
from lodgeframe.plans import queries as Q

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Tiles of users meet blocks of items in Arrow batches.
BLOCK_SCORING = {"als_recommend_facts", "als_recommend_users"}


@pytest.mark.parametrize("name", sorted(set(O.oracle_sql()) - BLOCK_SCORING))
def test_no_python_udf(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan


UNLIMITED = {"listing_poi_features_all", "cleaned_listing_all"}
MODEL = {"label_index", "price_ridge_1f", "price_rmse_1f", "price_cv_1f", "price_glm_2f",
         "price_glm_predict", "price_glm_rmse", "price_glm_cv", "price_glm_profit",
         "review_language_model", "language_held_out", "lexicon_spread", "review_polarity_scoped",
         "als_split", "als_recommend_facts", "als_recommend_users"}
TABLES_READ = {"radius_pairs": 3, "listing_poi_features": 3,
               "listing_poi_features_cells": 3, "nearest_shop": 3, "cleaned_listing": 4, "optimise": 5,
               "neighbourhood_prices": 5}


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) & set(O.oracle_sql()) - UNLIMITED - MODEL))
def test_building_a_query_only_reads_schemas(spark, name):
    """One small job per table read, for its schema; nothing runs at plan time."""
    sc = spark.sparkContext
    sc.setJobGroup(f"build {name}", "plan only")
    Q.queries()[name](spark, SF_SMALL)
    jobs = sc.statusTracker().getJobIdsForGroup(f"build {name}")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= TABLES_READ.get(name, 2)


@pytest.mark.parametrize("name", ["profit_curve", "best_price"])
def test_profit_sweep_evaluates_the_grid_once(spark, name):
    plan = _plan(Q.queries()[name](spark, SF_SMALL))
    assert sum("Generate explode" in x and "occ_k" in x for x in plan.splitlines()) == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_review_text_moves_once(spark):
    """The only exchange is the one by review id (the texts, and their ids for the tokens)."""
    plan = _plan(Q.queries()["review_score"](spark, SF_SMALL))
    moved = [x for x in plan.splitlines() if "Exchange" in x and "Broadcast" not in x]
    # The noun table's own exchange, by form, holds a few rows.
    texts = [x for x in moved if "hashpartitioning(form#" not in x]
    assert len(texts) <= 2 and all("hashpartitioning(id#" in x for x in texts)


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(E.queries()["monthly_price"](spark, SF_SMALL))
    read = plan.split("ReadSchema: ")[1].split(",")[0] if "ReadSchema" in plan else plan
    assert "l_partkey" in plan and "l_comment" not in plan and "l_tax" not in plan
    assert "l_discount" not in read
