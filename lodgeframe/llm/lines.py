"""Line deduplication by distinct-site spread.

1. Every non-blank line (trimmed) becomes a key of two hashes; one HyperLogLog
   sketch of sites per key is built and merged by aggregation, so a line that
   stands in a third of all documents reaches a reducer as one sketch a task.
2. Lines whose estimate lies within ``band`` of the threshold get an exact
   distinct count of sites; those above the band are taken, those below left.
3. Lines on ``min_sites`` sites or more are cross-site boilerplate. They are
   removed from every document but the first that has them (least doc_id, then
   line number), so the corpus as a whole loses no text.

Defined cases: a null text stays null and has no lines; an empty or blank text is
kept as it is; null is one site of its own; a null doc_id sorts before all ids;
rows that repeat (same id and text) are treated alike, so if they come first both
keep the line; other input columns pass through (a column named like an output
column is replaced); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.common import let, materialize
from lodgeframe.llm.rules import BLANKS


def _site(col: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), col.cast("string")), F.lit("n"))


def line_keys(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """One row per non-blank line: key (k1, k2), site, doc, row and line number."""
    line = F.btrim(F.col("line"), F.lit(BLANKS))
    # The hash of the text stands below the explode: it is taken once a text, not once a line.
    return docs.select(
        F.col(id_col).alias("doc"), _site(F.col(site_col)).alias("site"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"),
        F.split(F.col(text_col), "\n", -1).alias("lines"),
    ).select("doc", "site", "row", F.posexplode("lines").alias("at", "line")).where(line != "").select(
        F.xxhash64(line).alias("k1"), F.hash(line).alias("k2"), "site", "doc", "row", "at")


def boilerplate(lines: DataFrame, min_sites: int, lg_k: int = 12,
                band: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """(decisions per candidate line, occurrences of the candidate lines)."""
    low, high = min_sites * (1 - band), min_sites * (1 + band)
    spread = lines.groupBy("k1", "k2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"))
    wide = materialize(spread.where(F.col("sites") >= low))
    found = materialize(lines.join(wide, ["k1", "k2"]))
    exact = found.where(F.col("sites") <= high).groupBy("k1", "k2").agg(
        F.countDistinct("site").alias("exact"))
    first = found.groupBy("k1", "k2").agg(
        F.first("sites").alias("sites"), F.min(F.struct("doc", "at")).alias("first"))
    decided = first.join(exact, ["k1", "k2"], "left").where(
        F.coalesce(F.col("exact"), F.col("sites")) >= min_sites).select("k1", "k2", "first")
    # Written, so that the join below reads two plain exchanges and a hot line can be split.
    return materialize(decided), found


def dedup_lines(docs: DataFrame, min_sites: int = 5, lg_k: int = 12, band: float = 0.1,
                id_col: str = "doc_id", text_col: str = "text",
                site_col: str = "source", total_col: str = "lines_total",
                removed_col: str = "lines_removed") -> DataFrame:
    """``docs`` with boilerplate lines gone from the text; adds the two counts of lines."""
    lines = line_keys(docs, id_col, text_col, site_col)
    decided, found = boilerplate(lines, min_sites, lg_k, band)
    gone = found.drop("sites").join(decided, ["k1", "k2"]).where(
        ~F.struct("doc", "at").eqNullSafe(F.col("first")))
    per_row = gone.groupBy("row", "doc").agg(F.collect_set("at").alias("gone"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"),
                       F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("_row"))
    joined = rows.join(per_row, (F.col("_row") == F.col("row"))
                       & F.col("_doc").eqNullSafe(F.col("doc")), "left")
    split = F.split(F.col("_text"), "\n", -1)
    # The lines that stay, by a hash set of those that go: linear in the lines.
    clean = F.when(F.col("gone").isNull(), F.col("_text")).otherwise(let(split, lambda s: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(s) - 1), F.col("gone")),
                    lambda i: F.get(s, i)), "\n")))
    total = F.size(F.filter(F.coalesce(split, F.array().cast("array<string>")),
                            lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    new = {text_col: clean, total_col: total.cast("long"),
           removed_col: F.coalesce(F.size("gone"), F.lit(0)).cast("long")}
    kept = [F.col(f"d.`{c}`") if c not in new else new[c].alias(c) for c in docs.columns]
    return joined.select(*kept, *[v.alias(k) for k, v in new.items() if k not in docs.columns])
