"""Sides that grow with the documents are not broadcast, however few bytes Spark takes them for."""

from lodgeframe.llm import mixing, simhash
from llm.helpers import doc_frame

TEXTS = [f"{w} one {w} two {w} three {w} four {w} five" for w in ("alpha", "beta", "gamma", "alpha")]


def joins(df, key):
    """Joins on ``key`` of the plan before anything ran."""
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines()
            if "Join" in x and f"{key}#" in x]


def test_signatures_are_not_broadcast(spark, monkeypatch):
    """A fingerprint gives some 64 signatures, of which Spark's estimate knows nothing."""
    written, met = simhash.materialize, []
    monkeypatch.setattr(simhash, "materialize", lambda df: met.extend(joins(df, "mask")) or written(df))
    near = {x ^ 1 << b for x in (0, 0x0f0f << 30) for b in range(40)}
    frame = spark.createDataFrame([(x, i) for i, x in enumerate(sorted(near))], "fp long, least long")
    edges = simhash.links(frame, block_rows=16).collect()
    assert {r["a"] for r in edges} | {r["b"] for r in edges} == near
    assert len(met) > 1 and all("SortMergeJoin" in x for x in met)


def test_fingerprints_are_not_broadcast(spark):
    met = joins(simhash.near_duplicates(doc_frame(spark, TEXTS)), "fp")
    assert met and all("SortMergeJoin" in x for x in met)


def test_pipeline_stages_broadcast_no_row_a_document(spark):
    docs = doc_frame(spark, TEXTS)
    for plan, key in ((simhash.keep_one(docs), "fp"), (mixing.mix(docs), "bucket")):
        met = joins(plan, key)
        assert met and all("SortMergeJoin" in x for x in met), key
        assert plan.count() == (3 if key == "fp" else 4)
