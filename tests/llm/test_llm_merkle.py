"""Merkle manifest against a plain recomputation."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lodgeframe.llm import merkle, queries
from llm.helpers import DOCS, awkward

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def part(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def reduce_tree(nodes):
    """(root, proof steps of each node)."""
    steps = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 3] for i in range(0, len(nodes), 3)]
        for k, i in enumerate(at):
            run = runs[i // 3]
            steps[k].append((i % 3, [x for j, x in enumerate(run) if j != i % 3]))
            at[k] = i // 3
        nodes = [sha("".join(r)) for r in runs]
    return (nodes[0] if nodes else None), steps


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        v = [r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]]
        leaf = sha("".join(map(part, v)))
        bad = leaf
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
            t = r["text"]
            bad = sha("".join(map(part, v[:4] + [t if t is None else t.replace("\n", "")])))
        groups[r["source"]].append(
            ((r["doc_id"] is not None, r["doc_id"] or 0), leaf, bad, r["doc_id"]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda x: x[:2])
        trees[s] = reduce_tree([x[1] for x in groups[s]])
    root, top = reduce_tree([trees[s][0] for s in order])
    out = []
    for s, above in zip(order, top):
        for (_, leaf, bad, i), own in zip(groups[s], trees[s][1]):
            path, node = own + above, bad
            for slot, sib in path:
                node = sha("".join(sib[:slot]) + node + "".join(sib[slot:]))
            out.append((i, leaf, trees[s][0], root, sha("".join(x for _, q in path for x in q)),
                        node, node == root))
    return sorted(out, key=str)


def check(docs):
    got = merkle.verified(docs)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs.collect())


def test_manifest_matches_recomputation(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"))


@pytest.mark.parametrize("n", [1, 3, 28, 729, 730, 1500])
def test_every_size_of_tree(spark, n):
    docs = spark.range(n).selectExpr("id * 37 - 400 AS doc_id", "concat('t\n', id) AS text",
                                     "'en' AS lang", "'s' AS source", "id AS n_chars")
    check(docs)


def test_many_groups_and_sparse_ids(spark):
    docs = spark.range(2500).select(
        (F.xxhash64("id")).alias("doc_id"), F.concat(F.lit("a\nb "), F.col("id")).alias("text"),
        F.lit(None).cast("string").alias("lang"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 != 1, F.concat(
            F.lit("é"), (F.col("id") % 800).cast("string"))).alias("source"),
        F.col("id").alias("n_chars"))
    check(docs)


def test_repeated_ids_null_ids_and_equal_rows(spark):
    rows = [(7, f"text {i % 40}\n", "en", "s", i % 3) for i in range(300)]
    rows += [(None, f"n{i}", "en", "s", 0) for i in range(60)] + [(8, "x\ny", "en", None, None)] * 50
    rows += [(i, None, None, "s", None) for i in range(-70, 70)] + [(2 ** 62 + 1, "", "", "", 0)]
    check(spark.createDataFrame(rows, DOCS))


def test_awkward_and_empty_tables(spark):
    check(awkward(spark))
    empty = merkle.verified(spark.createDataFrame([], DOCS))
    assert empty.columns == COLUMNS and empty.count() == 0


def test_paths_fold_to_the_root_and_tampering_shows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    m = merkle.manifest(docs, altered={"text": F.upper("text")}).cache()
    assert m.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).isEmpty()
    changed = m.where(F.col("altered") != F.col("leaf"))
    assert changed.count() > 100
    assert changed.where(merkle.fold(F.col("altered"), F.col("path")) == F.col("root")).isEmpty()
    got = queries.queries()["op11_merkle_manifest"](spark, SF)
    assert 0 < got.where("verified").count() < got.count() == docs.count()
