"""Merkle manifest of a dataset: one leaf a row, one tree a group, one tree of all groups.

A leaf is the SHA-256 of a row's fields. Within a group (a source) leaves ascend by id;
runs of three consecutive nodes hash to their parent until one node, the subroot, is left;
the subroots, ordered by group, hash to the root alike.

1. Coordinates without sorting the rows. The ids of a group become 64-bit words of a
   bitmap, merged by OR; only words that hold an id are kept (the compressed form), 512
   of them under one container. A prefix sum over the containers and one inside each is
   the popcount directory. A row's rank is its word's entry plus the popcount of the lower
   bits, so rows meet one small directory row and are never ordered.
2. Ids that repeat within a group count in the directory with their number; their rows
   are ranked among themselves by leaf. Equal rows are one row with a count until then.
3. Levels. Nodes are keyed by (tree, rank div 729) and placed in an array by their slot,
   rank mod 729; six levels are reduced inside the array. So a tree of n leaves takes
   log_729(n) exchanges, and no task holds more than 729 nodes of a tree at once.
4. Proofs come down from the top: a run's rows take the path of the run's root, written
   once a round, and put the siblings inside their own array before it.

Defined cases: null fields hash as ``-``; a null group is a group of its own and comes
first; null ids come first in their group; rows that share an id ascend by leaf; rows that
are equal throughout are leaves one after another; an empty table gives an empty result;
columns that are not fields are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lodgeframe.llm.common import materialize
from lodgeframe.operators.util import prefix_sums

FAN = 3
LEVELS = 6                  # levels reduced inside one array
RUN = FAN ** LEVELS
WORD_BITS = 6               # ids to a bitmap word, as a power of two
CONTAINER_BITS = 9          # words to a container
CHUNK = 4096                # equal rows made from one row at once
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NO_PATH = "array<struct<slot:int,siblings:array<string>>>"


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """UTF-8 byte count, colon, value; ``-`` if null."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    return sha256(F.concat(*[field(v) for v in values]))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    def up(node: Column, step: Column) -> Column:
        left = F.slice(step["siblings"], F.lit(1), step["slot"])
        right = F.slice(step["siblings"], step["slot"] + 1, F.lit(FAN))
        return sha256(F.concat(F.array_join(left, ""), node, F.array_join(right, "")))
    return F.aggregate(path, leaf, up)


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a path, from the leaf up, left to right."""
    return sha256(F.array_join(F.flatten(F.transform(path, lambda s: s["siblings"])), ""))


# --- coordinates --------------------------------------------------------------

def directory(leaves: DataFrame) -> DataFrame:
    """(tree, group, word, bits, extra, start, n): where the ids of each bitmap word begin.

    ``extra`` lists the ids of a word that stand for several leaves: (bit, leaves, variants).
    """
    ids = leaves.groupBy("group", "id").agg(
        F.sum("equal").alias("leaves"), F.count("*").alias("variants"))
    bit = F.col("id").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
    words = ids.groupBy("group", F.shiftright("id", WORD_BITS).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"),
        F.sum("leaves").alias("leaves"),
        F.collect_list(F.when(F.col("leaves") > 1, F.struct(
            bit.alias("bit"), "leaves", "variants"))).alias("extra"))
    words = materialize(words.withColumn("container", F.shiftright("word", CONTAINER_BITS)))
    sums = words.groupBy("group", "container").agg(F.sum("leaves").alias("leaves"))
    begun = prefix_sums(sums, [F.col("group"), F.col("container")], F.col("leaves"))
    groups = begun.groupBy("group").agg(F.min("before").alias("first"), F.sum("leaves").alias("n"))
    trees = materialize(prefix_sums(groups, [F.col("group")], F.lit(1), into="tree"))
    begun = begun.select(F.col("group").alias("g"), F.col("container").alias("c"), "before").join(
        trees.select(F.col("group").alias("h"), "first", "n", "tree"),
        F.col("g").eqNullSafe(F.col("h"))).drop("h")
    inside = F.coalesce(F.sum("leaves").over(W.partitionBy("group", "container").orderBy(
        "word").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = words.withColumn("inside", inside).join(
        begun, F.col("group").eqNullSafe(F.col("g")) & F.col("container").eqNullSafe(F.col("c")))
    return materialize(placed.select(
        "tree", "group", "word", "bits", "extra", "n",
        (F.col("before") - F.col("first") + F.col("inside")).alias("start")))


def ranked(leaves: DataFrame) -> DataFrame:
    """Leaves with (tree, n, rank); equal rows become single ones."""
    where = directory(leaves).withColumnsRenamed({"group": "g", "word": "w"})
    bit = F.col("id").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
    below = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), bit))
    met = leaves.withColumn("word", F.shiftright("id", WORD_BITS)).join(
        where, F.col("group").eqNullSafe(F.col("g")) & F.col("word").eqNullSafe(F.col("w")))
    lower = F.aggregate(F.filter("extra", lambda x: x["bit"] < bit), F.lit(0).cast("long"),
                        lambda a, x: a + x["leaves"] - 1)
    own = F.get(F.filter("extra", lambda x: x["bit"].eqNullSafe(bit)), F.lit(0))
    # A null id has no bit: its rows are all the leaves of its word.
    met = met.select(
        "tree", "n", "id", "leaf", "altered", "equal",
        (F.col("start") + F.coalesce(F.bit_count(F.col("bits").bitwiseAND(below)) + lower,
                                     F.lit(0))).alias("rank"),
        F.coalesce(own["variants"], F.lit(1)).alias("variants"))
    met = materialize(met)
    tied = met.where("variants > 1")
    keys = ["tree", "id"]
    within = prefix_sums(tied, [F.col("tree"), F.col("id"), F.col("leaf"), F.col("altered")],
                         F.col("equal"), into="among")
    within = materialize(within)
    first = within.groupBy(*[F.col(k).alias(f"{k}_") for k in keys]).agg(
        F.min("among").alias("least"))
    within = within.join(first, (F.col("tree") == F.col("tree_"))
                         & F.col("id").eqNullSafe(F.col("id_"))).withColumn(
        "rank", F.col("rank") + F.col("among") - F.col("least"))
    kept = ["tree", "n", "id", "leaf", "altered", "equal", "rank"]
    every = met.where("variants = 1").select(kept).unionByName(within.select(kept))
    chunks = F.explode(F.sequence(F.lit(0), F.floor((F.col("equal") - 1) / CHUNK)))
    nth = F.explode(F.sequence(F.col("chunk") * CHUNK, F.least(
        F.col("equal"), (F.col("chunk") + 1) * CHUNK) - 1))
    return every.withColumn("chunk", chunks).withColumn("nth", nth).select(
        "tree", "n", (F.col("rank") + F.col("nth")).alias("rank"), "leaf", "id", "altered")


# --- levels -------------------------------------------------------------------

def runs_of(nodes: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """(tree, n, run, slots): the nodes of each run of 729, in the order of their slots."""
    slot = (F.col("rank") % RUN).cast("int").alias("slot")
    return nodes.groupBy("tree", "n", F.floor(F.col("rank") / RUN).alias("run")).agg(
        F.array_sort(F.collect_list(F.struct(slot, F.col("leaf"), *payload))).alias("slots"))


def level_up(nodes: Column) -> Column:
    """The parents of an array of nodes."""
    return F.transform(
        F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int")),
        lambda i: sha256(F.array_join(F.slice(nodes, i * FAN + 1, F.lit(FAN)), "")))


def with_levels(runs: DataFrame) -> DataFrame:
    """``level_0`` to ``level_6`` of each run; a tree of one run stops at one node."""
    out = runs.withColumn("level_0", F.transform("slots", lambda s: s["leaf"]))
    for k in range(LEVELS):
        below = F.col(f"level_{k}")
        out = out.withColumn(f"level_{k + 1}", F.when(
            (F.col("n") <= RUN) & (F.size(below) == 1), below).otherwise(level_up(below)))
    return out


def own_path(slot: Column) -> Column:
    """The steps of a slot's path inside its run."""
    steps = []
    for k in range(LEVELS):
        level = F.col(f"level_{k}")
        at = F.floor(slot / FAN ** k).cast("int")
        run = F.slice(level, at - at % FAN + 1, F.lit(FAN))
        siblings = F.concat(F.slice(run, F.lit(1), at % FAN),
                            F.slice(run, at % FAN + 2, F.lit(FAN)))
        steps.append(F.when((F.size(level) > 1) | (F.col("n") > RUN), F.struct(
            (at % FAN).alias("slot"), siblings.alias("siblings"))))
    return F.array_compact(F.array(*steps))


def build(nodes: DataFrame, payload: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """(the run tables, one a round; the root of each tree) of nodes (tree, n, rank, leaf)."""
    rounds, roots = [], None
    while True:
        runs = materialize(runs_of(nodes, payload if not rounds else ()))
        rounds.append(runs)
        tops = materialize(with_levels(runs).select(
            "tree", "n", F.col("run").alias("rank"),
            F.element_at(f"level_{LEVELS}", 1).alias("leaf")))
        done = tops.where(F.col("n") <= RUN).select("tree", F.col("leaf").alias("subroot"))
        roots = done if roots is None else roots.unionByName(done)
        nodes = tops.where(F.col("n") > RUN).withColumn("n", F.ceil(F.col("n") / RUN))
        if nodes.isEmpty():
            return rounds, materialize(roots)


def paths(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(tree, the fields of a slot, path, and the columns of ``tops``) of the first nodes.

    ``tops`` has one row a tree: its path from the tree's root on, and what else is
    to come down to the leaves.
    """
    more = [c for c in tops.columns if c not in ("tree", "path")]
    from_tops = tops.select(F.col("tree").alias("t"), F.lit(0).cast("long").alias("r"),
                            F.lit(True).alias("top"), F.col("path").alias("above"), *more)
    parents = from_tops
    for depth, runs in reversed(list(enumerate(rounds))):
        met = with_levels(runs).join(parents, (F.col("tree") == F.col("t")) & (
            F.col("run") == F.col("r")) & ((F.col("n") <= RUN) == F.col("top")))
        levels = [f"level_{k}" for k in range(LEVELS)]
        met = met.select("tree", "n", "run", "above", *more, *levels, F.explode("slots").alias("s"))
        met = met.select("tree", "run", "s", *more, F.concat(
            own_path(F.col("s.slot")), "above").alias("path"))
        if depth == 0:
            return met.select("tree", "s", "path", *more)
        found = materialize(met.select(
            F.col("tree").alias("t"), (F.col("run") * RUN + F.col("s.slot")).alias("r"),
            F.lit(False).alias("top"), F.col("path").alias("above"), *more))
        parents = found.unionByName(from_tops)
    raise ValueError("no rounds")


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id",
             group_col: str = "source", altered: Mapping[str, Column] | None = None,
             where_altered: Column | None = None) -> DataFrame:
    """One row per input row: id, leaf, altered, subroot, root and path.

    ``path`` lists the steps from the leaf to the root: (slot, siblings) each.
    ``altered`` gives other values of some fields; the leaf they make is returned where
    ``where_altered`` holds, and is null elsewhere.
    """
    values = [F.col(f"`{f}`") for f in fields]
    other = [(altered or {}).get(f, v) for f, v in zip(fields, values)]
    hit = F.lit(False) if not altered else (
        F.lit(True) if where_altered is None else where_altered)
    leaves = docs.select(
        F.col(f"`{group_col}`").alias("group"), F.col(f"`{id_col}`").cast("long").alias("id"),
        leaf_hash(values).alias("leaf"), F.when(hit, leaf_hash(other)).alias("altered"))
    leaves = materialize(leaves.groupBy("group", "id", "leaf", "altered").agg(
        F.count("*").alias("equal")))
    rounds, subroots = build(ranked(leaves), ("id", "altered"))
    n = subroots.count()
    top_rounds, root = build(subroots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(n).cast("long").alias("n"),
        F.col("tree").alias("rank"), F.col("subroot").alias("leaf"), "tree",
        ).toDF("tree", "n", "rank", "leaf", "of"), ("of",))
    tops = paths(top_rounds, root.select(
        "tree", F.col("subroot").alias("root"), F.array().cast(NO_PATH).alias("path")))
    tops = materialize(tops.select(F.col("s.of").alias("tree"), F.col("s.leaf").alias("subroot"),
                                   "root", "path"))
    return paths(rounds, tops).select(
        F.col("s.id").alias("id"), F.col("s.leaf").alias("leaf"),
        F.col("s.altered").alias("altered"), "subroot", "root", "path")


def without_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(""))


def verified(docs: DataFrame) -> DataFrame:
    """The manifest of documents, each checked after tampering with those of an even id hash.

    Tampering takes the newlines out of a text. A null id has no hash and is left alone.
    """
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    m = manifest(docs, altered={"text": without_newlines(F.col("text"))},
                 where_altered=F.coalesce(even, F.lit(False)))
    out = m.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                   proof_digest(F.col("path")).alias("proof_sha256"),
                   fold(F.coalesce("altered", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
