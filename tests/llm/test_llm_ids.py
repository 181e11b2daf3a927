"""Wide ids beside nulls, clashing column names and long runs, in every operator they meet."""

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodgeframe.llm import licenses, lines, lm, mixing, packing, simhash
from llm.helpers import DOCS, doc_frame

A, B = 2 ** 60 + 1, 2 ** 60 + 3
WIDE = [A, None, B]
TEXTS = [f"{w} one {w} two {w} three {w} four {w} five" for w in ("alpha", "beta", "gamma")]
BATCHES = [(WIDE, TEXTS), ([None, None], TEXTS[:2]), ([A, B], TEXTS[:2]), (WIDE, [None, "", "x"]),
           ([A, None, B, None, A - 2], [TEXTS[0], TEXTS[0], TEXTS[1], None, "  "])]


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=str)


@pytest.mark.parametrize("given,texts", BATCHES)
def test_wide_ids_survive_beside_nulls(spark, given, texts):
    docs = doc_frame(spark, texts, ids=given).coalesce(1)
    want = sorted(given, key=str)
    assert ids(simhash.near_duplicates(docs)) == want
    assert ids(lm.score_texts(docs)) == want
    assert ids(mixing.mix(docs)) == want
    assert ids(lines.dedup_lines(docs)) == want
    pieces = packing.pack(docs, packing.default_tokenizer()).collect()
    assert sorted((r["doc_id"] for r in pieces if r["start"] == 0), key=str) == want


def test_keep_one_keeps_wide_ids(spark):
    docs = doc_frame(spark, TEXTS + [TEXTS[0]], ids=[*WIDE, A - 2]).coalesce(1)
    assert ids(simhash.keep_one(docs)) == sorted([A - 2, None, B], key=str)


CLASH = ("n", "row_key", "_c", "_size", "_row_key", "lines_total", "lines_removed", "score",
         "d", "row", "key", "id", "k", "i", "copy", "copies", "size", "taken", "stage_0", "fp", "a.b")


def clashing(docs):
    return docs.select("*", *[F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"),
                                                                 F.lit("none"))).alias(c)
                              for c in CLASH], F.create_map(F.lit("m"), F.lit(1)).alias("tags"))


def test_every_stage_passes_clashing_columns_through(spark, tmp_path):
    docs = clashing(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionAll(
        doc_frame(spark, ["a text without an id " * 30], ids=[None])))
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(
        f"{tmp_path}/labels.parquet")
    given = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *CLASH, "tags"], name
        for r in docs.collect():
            assert [r[c] for c in CLASH] == [given[r["doc_id"]][c] for c in CLASH], name
    assert corpus_pipeline.packing_stage(spark, docs, str(tmp_path)).count() >= docs.count() > 0


def test_near_duplicate_stage_keeps_every_wide_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r["doc_id"] + 2 ** 60 for r in corpus_pipeline.near_duplicate_stage(
        spark, docs, "").collect()}
    wide = docs.withColumn("doc_id", F.col("doc_id") + 2 ** 60).unionAll(
        doc_frame(spark, ["no id " + "here " * 60], ids=[None])).coalesce(1)
    got = corpus_pipeline.near_duplicate_stage(spark, wide, "")
    assert {r["doc_id"] for r in got.collect()} == want | {None}
    mixed = {r["doc_id"] for r in corpus_pipeline.mixing_stage(spark, got, "").collect()}
    assert mixed <= want | {None} and len(mixed) > len(want) // 2


def test_equal_rows_are_dealt_one_after_another(spark):
    docs = doc_frame(spark, ["a b c"] * 5000 + ["d e"] * 300, ids=[7] * 5000 + list(range(100, 400)),
                     sources=["s"] * 5000 + ["t"] * 300)
    got = mixing.mix(docs).collect()
    assert len(got) == 5300
    by = {}
    for r in got:
        by.setdefault(r["source"], []).append(r)
    for rows in by.values():
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 1
    starts = sorted(r["position"] for r in by["s"] if r["taken"])
    assert len(set(starts)) == len(starts)
    assert mixing.mixed_documents(docs).where("doc_id = 7").count() == sum(
        len(r["copies"]) for r in by["s"])


@pytest.mark.parametrize("mark", list(".!?;:"))
def test_long_runs_of_marks_are_read_once(spark, mark):
    n = 1_000_000
    docs = doc_frame(spark, ["license " + mark * n + "x", "Released under the MIT License" +
                             mark * 50_000 + " end", "license " + "\n" * n, "license " + " " * n])
    began = time.time()
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(docs).collect()}
    assert time.time() - began < 20
    assert got == {1: [], 2: ["MIT"], 3: [], 4: []}


def test_a_document_of_many_removed_lines_is_read_once(spark):
    n = 300_000
    docs = spark.createDataFrame([(i, "same line\n" * n + f"own {i}", "en", f"s{i}", 0)
                                  for i in range(3)], DOCS)
    began = time.time()
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(docs, min_sites=3).collect()}
    assert time.time() - began < 60
    assert got[0] == "same line\n" + "own 0" and got[2] == "own 2"
