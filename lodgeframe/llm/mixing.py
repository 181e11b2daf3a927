"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time [0, 1]. Its integral is the
source's cumulative token demand; the documents of a source, in hash order,
fill that demand from its start, and the inverse of the integral gives each
document its training position. Sorting by position is a range partitioning.

Targets: the sources share ``budget`` (a multiple of all tokens) by weight; a
target stops at ``max_repeats`` times the source, and what is left over is
shared again by weight among the others.

The running total inside a source is computed in three steps, so a source with a
third of all rows is no single task: equal rows are one row with a count, rows fall
into hash buckets and buckets into runs; runs are accumulated per source, buckets
inside a run, rows inside a bucket.

Defined cases: a null text has size 0; a null source is a source of its own and
sorts last; documents of size 0 take 0 words and have no position; a source
without tokens has target 0; rows that repeat are separate documents that follow one
another; an empty table gives an empty result. ``mix`` reads the id, text and source
only; ``mixed_documents`` passes all columns through, whatever their names, and sets
the text (and ``n_chars``, where present) of cut copies.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lodgeframe.llm.common import materialize, word_count, words

ROWS_PER_BUCKET = 128
BUCKETS_PER_RUN = 1024
CHUNK = 4096                # equal rows made from one row at once


@dataclass(frozen=True)
class Curriculum:
    """Weights by source rank (repeating) and the slopes of their schedules.

    Schedule of a source with slope k: weight * (1 + k (2 t - 1)), -1 <= k <= 1. Its
    integral is weight * R(t) with R(t) = t + k (t^2 - t), and R(1) = 1, so the
    slope moves tokens in time without changing the total.
    """
    weights: Sequence[float] = (5.0, 2.0, 1.0)
    slopes: Sequence[float] = (0.0, 0.8, -0.8)
    budget: float = 1.5
    max_repeats: float = 2.0

    def when(self, share: Column, slope: Column) -> Column:
        """The t with R(t) = share: k t^2 + (1 - k) t - share = 0."""
        p = 1 - slope
        root = F.sqrt(F.greatest(p * p + 4 * slope * share, F.lit(0.0)))
        return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.when(
            slope == 0, share).otherwise(F.coalesce(F.try_divide(2 * share, p + root),
                                                    F.lit(0.0)))))


def targets(sizes: DataFrame, plan: Curriculum) -> DataFrame:
    """Per source (source, source_size): its target and schedule.

    With all sources sorted by size / weight, the capped ones come first: the
    level at which a prefix is capped is a running sum, so no loop is needed.
    The sort is over sources, one row each.
    """
    n = len(plan.weights)
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    at = (rank % n).cast("int")
    ranked = sizes.select(
        "source", "source_size", rank.alias("source_rank"),
        F.get(F.array(*[F.lit(float(x)) for x in plan.weights]), at).alias("weight"),
        F.get(F.array(*[F.lit(float(x)) for x in plan.slopes]),
              (rank % len(plan.slopes)).cast("int")).alias("slope"))
    everyone = W.partitionBy()
    by_fill = W.orderBy(F.col("source_size") / F.col("weight"), "source_rank")
    before = by_fill.rowsBetween(W.unboundedPreceding, -1)
    cap = F.col("source_size") * F.lit(float(plan.max_repeats))
    level = ranked.select(
        "*", cap.alias("cap"),
        (F.sum("source_size").over(everyone) * F.lit(float(plan.budget))
         - F.coalesce(F.sum(cap).over(before), F.lit(0.0))).alias("left"),
        (F.sum("weight").over(everyone)
         - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("open"))
    # The first source whose share of what is left fits its cap sets the level for the rest.
    fits = F.col("left") * F.col("weight") <= F.col("cap") * F.col("open")
    level = level.withColumn("level", F.min(F.when(
        fits, F.struct(F.col("source_size") / F.col("weight"), "source_rank",
                       (F.col("left") / F.col("open")).alias("rate")))).over(everyone))
    return level.select(
        "source", "source_rank", "source_size", "slope",
        F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("level")["rate"],
                                         F.col("cap"))).alias("target"))


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _whole_row_key(docs: DataFrame) -> Column:
    """Hash of all columns of a row; a type that holds a map is hashed as JSON."""
    return F.xxhash64(*[F.to_json(F.struct(F.col(f"`{f.name}`")))
                        if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")
                        for f in docs.schema])


def _before(value: str, part: list[str], order: list[str]) -> Column:
    return F.coalesce(F.sum(value).over(W.partitionBy(*part).orderBy(*order).rowsBetween(
        W.unboundedPreceding, -1)), F.lit(0))


def _starts(rows: DataFrame) -> DataFrame:
    """Per (source, bucket): the source's words in earlier buckets, and in all."""
    run = F.floor(F.col("bucket") / BUCKETS_PER_RUN).alias("run")
    buckets = rows.groupBy("source", run, "bucket").agg(F.sum("words").alias("words"))
    runs = buckets.groupBy(F.col("source").alias("s"), F.col("run").alias("r")).agg(
        F.sum("words").alias("run_words"))
    runs = runs.withColumn("run_start", _before("run_words", ["s"], ["r"]))
    inside = buckets.withColumn("in_run", _before("words", ["source", "run"], ["bucket"]))
    return inside.join(runs, F.col("source").eqNullSafe(F.col("s")) & (F.col("run") == F.col("r"))) \
        .select("source", "bucket", "words", (F.col("run_start") + F.col("in_run")).alias("start"))


def mix(docs: DataFrame, plan: Curriculum | None = None, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", by_position: bool = True,
        key: Column | None = None) -> DataFrame:
    """One row per document, range-sorted by its first training position.

    Columns: doc_id, source, row_key, size, source_size, target, taken (words,
    repeats counted) and ``copies``: an array of (position, words), one entry for
    each time the document is taken; the last may be a part of it. ``key`` is the hash
    that deals the documents and tells equal rows (default: of id and text).
    """
    plan = plan or Curriculum()
    buckets = max(1, -(-docs.count() // ROWS_PER_BUCKET))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        (_row_key(id_col, text_col) if key is None else key).alias("row_key"),
        word_count(F.col(text_col)).alias("size")) \
        .groupBy("doc_id", "source", "row_key", "size").agg(F.count("*").alias("equal"))
    rows = materialize(rows.select(
        "*", (F.col("size") * F.col("equal")).alias("words"),
        F.pmod(F.xxhash64(F.lit("mix"), "row_key"), F.lit(buckets)).alias("bucket")))
    starts = _starts(rows)
    goal = targets(starts.groupBy("source").agg(F.sum("words").alias("source_size")), plan)
    goal = goal.withColumnRenamed("source", "goal_source")
    starts = starts.join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), "start", "source_rank",
        "source_size", "target", "slope")
    placed = rows.withColumn("before", _before("words", ["source", "bucket"],
                                               ["row_key", "doc_id"]))
    # A merge join: the rows are written in few bytes each, and Spark would have the driver hold
    # them all for a broadcast, as their places look longer than they are.
    placed = placed.join(starts.hint("merge"), F.col("source").eqNullSafe(F.col("s"))
                         & (F.col("bucket") == F.col("b")))
    # One row for each of the equal rows, in chunks: they follow one another.
    placed = placed.withColumn("chunk", F.explode(F.sequence(
        F.lit(0), F.floor((F.col("equal") - 1) / CHUNK)))).withColumn("nth", F.explode(F.sequence(
            F.col("chunk") * CHUNK, F.least(F.col("equal"), (F.col("chunk") + 1) * CHUNK) - 1)))
    offset = F.col("start") + F.col("before") + F.col("nth") * F.col("size")
    goal_words = F.round("target").cast("long")
    passes = F.when((F.col("size") > 0) & (goal_words > 0), F.filter(F.transform(
        F.sequence(F.lit(0), F.ceil(F.lit(float(plan.max_repeats))).cast("int")),
        lambda e: F.struct(
            (offset + e * F.col("source_size")).alias("at"),
            F.least(F.col("size"), goal_words - offset - e * F.col("source_size"))
            .alias("words"))), lambda x: x["words"] > 0)).otherwise(
        F.array().cast("array<struct<at:bigint,words:bigint>>"))
    out = placed.select(
        "doc_id", "source", "row_key", "size", "source_size", "target",
        F.transform(passes, lambda x: F.struct(
            plan.when(x["at"] / F.col("target"), F.col("slope")).alias("position"),
            x["words"].alias("words"))).alias("copies"))
    out = out.select(
        "doc_id", "source", "row_key", "size", "source_size", "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda a, x: a + x["words"]).alias("taken"),
        F.get("copies", F.lit(0))["position"].alias("position"), "copies")
    if by_position:
        order = (F.col("position").asc_nulls_last(), F.col("doc_id").asc_nulls_last())
        out = out.repartitionByRange(*order).sortWithinPartitions(*order)
    return out


def mixed_documents(docs: DataFrame, plan: Curriculum | None = None) -> DataFrame:
    """The documents as taken: one row per copy, cut to the words taken, in training order.

    A copy that is taken whole keeps its text as it is; a cut one keeps its first
    words, joined by single blanks. Columns are those of ``docs``; ``n_chars`` is
    set anew for cut copies. The places are found on keys alone; one row of each set of
    equal rows meets all places of the set.
    """
    key = _whole_row_key(docs)
    taken = mix(docs, plan, by_position=False, key=key).where("taken > 0").select(
        F.col("row_key").alias("k"), F.col("doc_id").alias("i"), "size",
        F.explode("copies").alias("copy"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       key.alias("key"), F.col("doc_id").alias("id")).dropDuplicates(["key", "id"])
    joined = taken.join(rows, (F.col("k") == F.col("key")) & F.col("i").eqNullSafe(F.col("id")))
    text = F.col("row.text")
    whole = F.col("copy.words") == F.col("size")
    cut = F.array_join(F.slice(words(text), F.lit(1), F.col("copy.words").cast("int")), " ")
    new = {"text": F.when(whole, text).otherwise(cut)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(whole, F.col("row.n_chars")).otherwise(
            F.length(cut)).cast(docs.schema["n_chars"].dataType)
    order = (F.col("copy.position"), F.col("id"))
    out = joined.repartitionByRange(*order).sortWithinPartitions(*order)
    return out.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`")
                        for c in docs.columns])
