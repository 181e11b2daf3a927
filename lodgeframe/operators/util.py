"""Shared plan helpers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lodgeframe.session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the session's shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes the input once and keeps
    column pruning. The folder is the one named by ``spark.checkpoint.dir``; the table
    is deleted when the driver ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    df.write.parquet(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def prefix_sums(df: DataFrame, order: Sequence[Column], value: Column,
                into: str = "before") -> DataFrame:
    """``df`` with the sum of ``value`` over all rows that precede in ``order``.

    No task holds all rows: they are dealt to ranges and written once, the ranges'
    totals (one row a range) are summed up, and each range sums up its own rows. Rows
    that tie in ``order`` share a range and follow one another in no fixed order.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"_order_{i}" for i in range(len(order))]
    dealt = df.select("*", *[c.alias(k) for c, k in zip(order, keys)], value.alias("_value"))
    dealt = materialize(dealt.repartitionByRange(parts, *keys).withColumn(
        "_range", F.spark_partition_id()))
    totals = dealt.groupBy(F.col("_range").alias("_r")).agg(F.sum("_value").alias("_total"))
    totals = totals.withColumn("_start", F.sum("_total").over(
        W.orderBy("_r").rowsBetween(W.unboundedPreceding, -1)))
    own = F.sum("_value").over(W.partitionBy("_range").orderBy(*keys).rowsBetween(
        W.unboundedPreceding, -1))
    out = dealt.withColumn("_own", own).join(totals, F.col("_range") == F.col("_r"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (
        F.coalesce("_own", F.lit(0)) + F.coalesce("_start", F.lit(0))).alias(into))
