"""The corpus pipeline: five stages over ``documents``, each on what the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``. ``run`` writes each stage once to the shared checkpoint
folder and reads it back, so a lost executor repeats one stage at most.

1. Quality: documents that the positive-unlabelled classifier scores below 0.3 go.
2. Lines: boilerplate lines on several sites stay in the first document only.
3. Near-duplicates: of each SimHash component the document with the least id stays
   (without an id: the least text hash); documents without words are no copies of
   one another's content and are one component like any other.
4. Mixing: a document appears as often as its source's target takes it; the copy at a
   target's end is cut to the words taken; rows come in training order.
5. Packing: pieces of at most 2048 tokens with their sequence and offset.

Further columns of ``documents`` pass through the first four stages unchanged, whatever
their names. Null, empty, very long, tied and repeated inputs are handled as the operators say; an
empty table passes through as an empty table.
"""

from __future__ import annotations

from itertools import count, islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.llm import lines, mixing, packing, quality, simhash
from lodgeframe.llm.common import materialize, table
from lodgeframe.llm.queries import QUALITY_CUT

PIECE_COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def free_names(docs: DataFrame, n: int) -> list[str]:
    """Names that no column of ``docs`` has, for the columns a stage adds."""
    taken = {c.lower() for c in docs.columns}
    return list(islice((x for i in count() if (x := f"stage_{i}") not in taken), n))


def plain(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    score, = free_names(docs, 1)
    return quality.score(docs, model, score_col=score).where(
        F.col(score) >= QUALITY_CUT).select(*plain(docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    total, removed = free_names(docs, 2)
    clean = lines.dedup_lines(docs, total_col=total, removed_col=removed)
    return clean.withColumn("n_chars", F.when(
        F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(
        docs.schema["n_chars"].dataType)).select(*plain(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.default_tokenizer()).select(*PIECE_COLUMNS)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("packing", packing_stage),
]

# A fitted model, component search and tokenizers: no SQL twin; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
