"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.operators.util import materialize  # noqa: F401

WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def fold(doc_id: Column, n: int = 5) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as the empty text)."""
    raw = F.coalesce(doc_id.cast("string"), F.lit(""))
    return (F.crc32(raw.cast("binary")) % n).cast("int")
