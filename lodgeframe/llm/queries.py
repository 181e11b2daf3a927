"""Registered queries of the training-data operators: thin digests of the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.llm import (ann, itq, licenses, lines, lm, merkle, mixing, packing, phrases, pii,
                            quality, rules, simhash)
from lodgeframe.llm.common import fold, table


QUALITY_CUT = 0.3


def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


def op2_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rules.apply_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op4_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.default_tokenizer()).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op5_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op6_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


def op7_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentences", ",").alias("sentences"),
                        F.array_join("licenses", ",").alias("licenses"))


def op8_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "position")


def op9_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "lines_total", "lines_removed", "text")


def op10_block_matrix_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, k=20)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


def op12_itq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_setm_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pu_quality": op1_pu_quality,
        "op2_line_rules": op2_line_rules,
        "op3_simhash": op3_simhash,
        "op4_harmonic_packing": op4_harmonic_packing,
        "op5_weak_supervision_pii": op5_weak_supervision_pii,
        "op6_backoff_automaton": op6_backoff_automaton,
        "op7_license_rules": op7_license_rules,
        "op8_curriculum_mix": op8_curriculum_mix,
        "op9_line_spread": op9_line_spread,
        "op10_block_matrix_ann": op10_block_matrix_ann,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_itq_near_dedup": op12_itq_near_dedup,
        "op13_setm_phrases": op13_setm_phrases,
    }
