"""SimHash near-duplicates by the generalised pigeonhole principle.

1. Fingerprints: 64-bit majority vote over the XXH64 of word shingles.
2. The 64 bits are grouped so that correlated bits share a group. With
   thresholds t_i >= -1 and sum(t_i + 1) = max_bits + 1, any two fingerprints
   within ``max_bits`` differ in at most t_i bits of some group i. A dynamic
   programme picks the t_i of least estimated work: signatures sent plus
   candidate pairs, estimated from the distance distribution of each group,
   scaled by the equal pairs counted over all fingerprints.
3. Probe: a group with threshold t sends one signature per choice of t dropped
   bits; fingerprints that share a signature form a block. Copies of one
   fingerprint were merged before, so a block holds different fingerprints only.
   A block larger than ``block_rows`` is split again: its free bits are dealt to
   max_bits + 1 colours, and a pair within ``max_bits`` agrees on one colour.
   This goes on until each block is small, so no pair is lost and no block is
   compared whole.
   Two groups of 32 bits (the default) send about 64 signatures a fingerprint and meet
   by chance with odds of 2^-31, so chance candidates stay rare up to 10^8 fingerprints;
   more groups send less and meet more often.
4. Verify the bit distance inside blocks; a block yields a spanning star forest,
   not its pairs. Star contraction then labels the components.

Defined cases: a null, empty or blank text has fingerprint zero and links like
any other; a null doc_id takes part but never is a component id unless its
whole component has none; repeated rows give repeated output rows; an empty
table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.common import materialize
from lodgeframe.llm.graph import components

BITS = 64
SEED = 42
ALL = (1 << BITS) - 1
CHUNK = 1 << 16
SLOTS = 16
PAIR_COST = 1.0        # work of one candidate pair, in units of ...
SIGNATURE_COST = 4.0   # ... one signature sent through the shuffle


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority of the shingle hashes' bits, as an unsigned integer."""
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    n = len(w) - shingle + 1
    joined = b" ".join(w)
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    size = np.fromiter(map(len, w), dtype=np.int64, count=len(w))
    end = np.cumsum(size + 1) - 1
    begin = end - size
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, dtype=np.int64)
    begins, ends = begin[:n].tolist(), end[shingle - 1:].tolist()
    for at in range(0, n, CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in
                      zip(begins[at:at + CHUNK], ends[at:at + CHUNK])], dtype="<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id",
                 text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """(doc_id, fp[, key]): fp holds the 64 bits as a signed long.

    Ids stay Arrow longs: in pandas a null among them would turn all into doubles.
    """
    more = [key_col] if key_col else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()],
                          dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(fp.view(np.int64)), *(b.column(c) for c in more)],
                names=["doc_id", "fp", *more])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"),
                       *more).mapInArrow(run, ", ".join(
                           ["doc_id long", "fp long", *(f"{c} long" for c in more)]))


# --- bit groups and thresholds ----------------------------------------------

def bit_matrix(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little")


def bit_statistics(fps: DataFrame) -> np.ndarray:
    """64 x 64 counts of fingerprints that have both bits; the diagonal counts each bit."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((BITS, BITS), dtype=np.int64)
        for b in batches:
            fp = b["fp"].to_numpy()
            for at in range(0, len(fp), CHUNK):
                m = bit_matrix(fp[at:at + CHUNK]).astype(np.float32)
                total += (m.T @ m).astype(np.int64)
        slot = TaskContext.get().partitionId() % SLOTS
        yield pd.DataFrame({"slot": [slot], "both": [total.ravel()]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"both": [np.sum(np.stack(group["both"].to_list()), axis=0)]})

    parts = fps.select("fp").mapInPandas(count, "slot int, both array<long>") \
        .groupBy("slot").applyInPandas(add, "both array<long>").collect()
    return np.sum([np.array(p["both"]) for p in parts] or [np.zeros(BITS * BITS, np.int64)],
                  axis=0).reshape(BITS, BITS)


def group_bits(both: np.ndarray, n: int, n_groups: int) -> list[list[int]]:
    """Groups of about equal size; each takes the bit most correlated with it next."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, groups = set(range(BITS)), []
    for g in range(n_groups):
        size = len(free) // (n_groups - g)
        start = max(sorted(free), key=lambda b: corr[b, sorted(free)].sum())
        group = [start]
        free.discard(start)
        while len(group) < size:
            best = max(sorted(free), key=lambda b: corr[b, group].mean())
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def distance_distribution(agree: np.ndarray) -> np.ndarray:
    """P(distance = d) of a group whose bits agree with the given probabilities."""
    dist = np.ones(1)
    for a in agree:
        dist = np.convolve(dist, [a, 1 - a])
    return dist


def allocate(cost: list[list[float]], units: int) -> list[int]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = units and least total cost.

    ``cost[i][u]`` is the cost of group i at threshold u - 1.
    """
    best: list[dict[int, tuple[float, list[int]]]] = [{0: (0.0, [])}]
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (c, picked) in best[-1].items():
            for u in range(min(units - used, len(row) - 1) + 1):
                got = (c + row[u], [*picked, u - 1])
                if used + u not in step or got < step[used + u]:
                    step[used + u] = got
        best.append(step)
    return best[-1][units][1]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def mask_of(bits) -> int:
    return sum(1 << b for b in bits)


def plan(fps: DataFrame, max_bits: int, n_groups: int) -> list[int]:
    """Signature masks: every pair within ``max_bits`` agrees on all bits of one mask."""
    both = bit_statistics(fps)
    n = fps.count()
    groups = group_bits(both, n, n_groups)
    masks = [mask_of(g) for g in groups]
    keys = fps.select(F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(signed(m))) for m in masks])).alias("g", "key"))
    size = F.col("n").cast("double")
    equal = {r["g"]: r["pairs"] for r in keys.groupBy("g", "key").agg(
        F.count("*").alias("n")).groupBy("g").agg(
        F.sum(size * (size - 1) / 2).alias("pairs")).collect()}
    p = np.diag(both) / max(n, 1)
    agree = p * p + (1 - p) * (1 - p)
    cost = []
    for i, g in enumerate(groups):
        dist = distance_distribution(agree[g])
        scale = max(equal.get(i, 0.0), 1.0) / max(dist[0], 1e-300)
        row = [0.0]
        for t in range(max_bits + 1):
            sent = comb(len(g), t) * n
            row.append(SIGNATURE_COST * sent + PAIR_COST * scale * dist[:t + 1].sum())
        cost.append(row)
    thresholds = allocate(cost, max_bits + 1)
    return [mask_of(set(g) - set(drop)) for g, t in zip(groups, thresholds) if t >= 0
            for drop in combinations(g, t)]


# --- blocks -----------------------------------------------------------------

def colour_masks(level: int, colours: int) -> list[int]:
    order = list(range(BITS))
    random.Random(f"colours-{level}").shuffle(order)
    return [mask_of(order[c::colours]) for c in range(colours)]


def block_stars(max_bits: int):
    """Per block of different fingerprints: (member, least member) of each linked part."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            member, least = [], []
            for block in b["fps"]:
                fp = np.sort(np.asarray(block, dtype=np.int64))
                u = fp.view(np.uint64)
                label = np.arange(len(fp))
                near = np.bitwise_count(u[:, None] ^ u[None, :]) <= max_bits
                while True:
                    step = np.where(near, label[None, :], len(fp)).min(axis=1)
                    step = step[step]
                    if (step == label).all():
                        break
                    label = step
                moved = label != np.arange(len(fp))
                member.append(fp[moved])
                least.append(fp[label[moved]])
            yield pd.DataFrame({"a": np.concatenate(member or [np.zeros(0, np.int64)]),
                                "b": np.concatenate(least or [np.zeros(0, np.int64)])})
    return run


def links(fps: DataFrame, max_bits: int = 3, n_groups: int = 2,
          block_rows: int = 1024) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints reachable within ``max_bits``."""
    def signatures(df: DataFrame, masks: list, base=None) -> DataFrame:
        grown = [signed(m) for m in masks]
        mask = F.explode(F.array(*[F.lit(m).cast("long") if base is None else
                                   F.col(base).bitwiseOR(F.lit(m)) for m in grown]))
        return df.select("fp", mask.alias("mask")).select(
            "fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))

    # A fingerprint is 16 bytes and gives some 64 signatures: spread the work before it grows.
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = signatures(fps.select("fp").repartition(parts, "fp"), plan(fps, max_bits, n_groups))
    found, level = None, 0
    while True:
        sizes = sent.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        # A merge join: Spark sizes the exploded rows as the few bytes of the fingerprints, and
        # the driver would hold the signatures of them all for a broadcast.
        shared = materialize(sent.join(sizes.hint("merge"), ["mask", "key"]))
        small = shared.where(F.col("n") <= block_rows).groupBy("mask", "key").agg(
            F.collect_list("fp").alias("fps")).select("fps")
        edges = materialize(small.mapInPandas(block_stars(max_bits), "a long, b long").distinct())
        found = edges if found is None else found.unionAll(edges)
        large = shared.where(F.col("n") > block_rows).select("fp", "mask")
        if large.isEmpty():
            return found
        level += 1
        sent = signatures(large, colour_masks(level, max_bits + 1), "mask") \
            .dropDuplicates(["mask", "fp"])


def component_labels(prints: DataFrame, max_bits: int, n_groups: int,
                     block_rows: int) -> DataFrame:
    """(fp, component, component_id) per fingerprint: least fp and least id of its component."""
    if block_rows < 4 or not 0 <= max_bits < BITS or not 1 <= n_groups <= max_bits + 1:
        raise ValueError("block_rows >= 4, 0 <= max_bits < 64, 1 <= n_groups <= max_bits + 1")
    fps = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(fps, max_bits, n_groups, block_rows))
    rooted = fps.join(roots, fps["fp"] == roots["node"]).select("fp", "least", "root")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    # Written, so that joins with the documents read two plain exchanges and a fingerprint
    # of many copies can be split. These are merge joins: each side has a row a document.
    return materialize(fps.join(named.select("fp", "root", "component_id"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("component"),
        F.coalesce("component_id", "least").alias("component_id")))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3,
                    n_groups: int = 2, block_rows: int = 1024, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row."""
    prints = materialize(fingerprints(docs, shingle, id_col, text_col))
    label = component_labels(prints, max_bits, n_groups, block_rows)
    return prints.join(label.hint("merge"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3, n_groups: int = 2,
             block_rows: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the least id, then the least text hash.

    Rows equal in id and text are one document; one of them stays. The winners are
    found on ids and hashes alone; the texts move once, to meet them. All columns of
    ``docs`` pass through as they are, whatever their names.
    """
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("key"))
    prints = materialize(fingerprints(keyed, shingle, "id", "text", "key"))
    label = component_labels(prints, max_bits, n_groups, block_rows)
    best = prints.join(label.hint("merge"), "fp").groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("best"))
    best = best.select(F.col("best.doc_id").alias("best_id"), F.col("best.key").alias("best_key"))
    joined = keyed.drop("text").join(best, (F.col("key") == F.col("best_key"))
                                     & F.col("id").eqNullSafe(F.col("best_id")))
    # Equal rows all meet the winner: keep one.
    return joined.dropDuplicates(["key", "best_id"]).select(
        *[F.col(f"row.`{c}`") for c in docs.columns])
