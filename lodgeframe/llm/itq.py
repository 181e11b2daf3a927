"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

1. Codes. A sample of unit vectors, one a cell of a coarse random code (so that a group of
   near copies counts little), gives the mean, the principal axes and two rotations: each
   starts at random and is improved in turns, codes = signs of the rotated rows, rotation
   = the orthogonal map that brings the rows nearest to their codes. Every vector gets
   the signs under both rotations, up to 64 bits each: the rotation spreads the variance, so
   the bits are balanced.
2. Tables. The code is cut into pieces of 16 bits, one hash table each. Two vectors meet in
   a table if their pieces differ in one bit at most: a vector stands in the bucket of its
   own piece ("home") and visits the buckets of its piece with one set bit cleared. With
   eight tables all pairs within 15 of 128 bits meet. At cosine 0.98 a bit differs
   with odds of 0.064, so a pair misses all tables with odds below 1 in 10,000.
3. Retrieval. Buckets are cut into tiles of bounded size (home part x member part). A
   semi-join on the codes keeps the members that have a partner within ``max_bits`` for which
   this table is the first to hold both; so each pair is judged in one tile.
4. Rerank. The original vectors meet the kept members only; a tile computes cosines in
   double precision and gives a count of links a vector and a spanning forest of them, never
   its pairs. Star contraction labels the components.

Equal vectors are one vector with a count, so a group of copies is one row until the end.

Bounded, by parameter: the rotations are fitted on ``fit_rows`` vectors at most for each
length of vectors; all vectors are indexed. Retrieval is approximate; tests measure its
recall.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components,
and vectors without a label, link with nothing; vectors of different lengths never meet;
rows that repeat an id are vectors of their own; a null id takes part but names a component
only if no member has an id; an empty table gives an empty result; other input columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.common import materialize
from lodgeframe.llm.graph import components

CODES = 2                 # rotations
MAX_CODE = 64             # bits of one rotation's code
PIECE = 16                # bits of one table
ROUNDS = 50
TILE = 2048               # members of a bucket part
COARSE = 24               # bits of the random code that thins the sample
LEAST_SAMPLE = 64


# --- rotations ----------------------------------------------------------------

def random_rotation(dim: int, bits: int, seed: int) -> np.ndarray:
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q[:, :bits]


def iterate(rows: np.ndarray, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """The rotation of centred, projected rows that brings them nearest to their signs."""
    r = random_rotation(rows.shape[1], rows.shape[1], seed)
    for _ in range(rounds):
        codes = np.where(rows @ r > 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd(codes.T @ rows)
        r = (u @ vt).T
    return r


def fit(sample: np.ndarray, dim: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(mean, projections) for vectors of one length."""
    bits = min(dim, MAX_CODE)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    coarse = unit @ np.random.default_rng(7).normal(size=(dim, COARSE)) > 0
    _, cells = np.unique(coarse, axis=0, return_index=True)
    unit = unit[np.sort(cells)]
    if len(unit) < LEAST_SAMPLE:
        return np.zeros(dim), [random_rotation(dim, bits, s) for s in range(CODES)]
    mean = unit.mean(axis=0)
    centred = unit - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    return mean, [axes @ iterate(centred @ axes, s) for s in range(CODES)]


def encode(x: np.ndarray, model: tuple[np.ndarray, list[np.ndarray]]) -> list[np.ndarray]:
    """One code of up to 64 bits a rotation, as signed longs."""
    mean, projections = model
    unit = x / np.linalg.norm(x, axis=1, keepdims=True) - mean
    out = []
    for p in projections:
        bits = np.zeros((len(x), MAX_CODE), dtype=np.uint8)
        bits[:, :p.shape[1]] = unit @ p > 0
        out.append(np.packbits(bits, axis=1, bitorder="little").view("<i8").ravel())
    return out


# --- tables -------------------------------------------------------------------

def piece(code: Column, k: int) -> Column:
    return F.shiftrightunsigned(code, k * PIECE).bitwiseAND(F.lit((1 << PIECE) - 1))


def tables(prefix: str = "") -> list[Column]:
    """The pieces of the codes, a table each."""
    return [piece(F.col(f"{prefix}c{c}"), k) for c in range(CODES) for k in range(MAX_CODE // PIECE)]


def first_table(other: str) -> Column:
    """The first table whose pieces of two codes differ in one bit at most."""
    mine, theirs = tables(), tables(other)
    met = [F.bit_count(a.bitwiseXOR(b)) <= 1 for a, b in zip(mine, theirs)]
    return reduce(lambda rest, im: F.when(im[1], F.lit(im[0])).otherwise(rest),
                  reversed(list(enumerate(met))), F.lit(None).cast("int"))


def members(vectors: DataFrame) -> DataFrame:
    """One row per vector and bucket it stands in, of buckets that can hold a pair."""
    bits = F.array(*[F.lit(1 << b) for b in range(PIECE)])
    pieces = F.posexplode(F.array(*tables())).alias("t", "own")
    rows = vectors.select("r", "label", "dim", "c0", "c1", pieces)
    # Tables beyond a short vector's bits hold zeros only.
    rows = rows.where((F.col("t") % (MAX_CODE // PIECE)) * PIECE < F.col("dim"))
    cleared = F.transform(F.filter(bits, lambda b: F.col("own").bitwiseAND(b) != 0),
                          lambda b: F.col("own").bitwiseXOR(b).cast("int"))
    rows = rows.withColumn("spot", F.explode(F.concat(
        F.array(F.col("own").cast("int")), cleared)))
    rows = rows.withColumn("home", F.col("own") == F.col("spot")).drop("own")
    sizes = rows.groupBy("label", "dim", "t", "spot").agg(
        F.count("*").alias("n"), F.count_if("home").alias("homes")).where("n > 1 AND homes > 0")
    # Written, so that the join reads two plain exchanges and a hot bucket can be split.
    return rows.join(materialize(sizes), ["label", "dim", "t", "spot"])


KEY = ["label", "dim", "t", "spot", "i", "j"]


def tiles(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(homes, others) of each tile: home part i of a bucket against member part j."""
    parts = F.ceil(F.col("n") / TILE).cast("int")
    dealt = rows.withColumn("parts", parts).withColumn(
        "part", F.pmod(F.xxhash64(F.lit("part"), "r"), F.col("parts")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    columns = ["r", "c0", "c1", "home"]
    homes = dealt.where("home").withColumn("i", F.col("part")).withColumn("j", every)
    others = dealt.withColumn("j", F.col("part")).withColumn("i", every)
    return homes.select(*KEY, *columns), others.select(*KEY, *columns)


def with_partner(rows: DataFrame, against: DataFrame, max_bits: int) -> DataFrame:
    """Rows that have a partner in their tile, judged on the codes."""
    right = against.select(*[F.col(k).alias(f"o_{k}") for k in [*KEY, "r", "c0", "c1"]])
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"o_{k}") for k in KEY])
    apart = reduce(lambda a, b: a + b, [F.bit_count(F.col(f"c{c}").bitwiseXOR(F.col(f"o_c{c}")))
                                        for c in range(CODES)])
    return rows.join(right, same & (F.col("r") != F.col("o_r")) & (apart <= max_bits)
                     & (first_table("o_") == F.col("t")), "left_semi")


# --- rerank -------------------------------------------------------------------

def _codes(rows: pd.DataFrame) -> np.ndarray:
    return rows[["c0", "c1"]].to_numpy(np.int64).view(np.uint64)


def judged_here(a: np.ndarray, b: np.ndarray, table: int, max_bits: int) -> np.ndarray:
    """Pairs of codes within ``max_bits`` whose first common table is this one."""
    differ = a[:, None, :] ^ b[None, :, :]
    near = np.bitwise_count(differ).sum(axis=2, dtype=np.int64) <= max_bits
    mask = np.uint64((1 << PIECE) - 1)
    for t in range(table + 1):
        c, k = divmod(t, MAX_CODE // PIECE)
        met = np.bitwise_count((differ[:, :, c] >> np.uint64(k * PIECE)) & mask) <= 1
        near &= met if t == table else ~met
    return near


def tile_links(home: pd.DataFrame, other: pd.DataFrame, least: float, max_bits: int,
               table: int) -> pd.DataFrame:
    """(r, links, root): links of a tile's vectors, and a member of the same linked part.

    A link of two homes shows in two tiles and counts for the home side of each; a
    link of a home and a visitor shows once and counts for both.
    """
    near = judged_here(_codes(home), _codes(other), table, max_bits)
    near &= home["r"].to_numpy()[:, None] != other["r"].to_numpy()[None, :]
    x, y = (np.stack(d["v"].to_list()).astype(np.float64) for d in (home, other))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near &= x @ y.T >= least
    visits = ~other["home"].to_numpy(bool)
    n_home = near @ other["m"].to_numpy(np.int64)
    n_other = np.where(visits, near.T @ home["m"].to_numpy(np.int64), 0)
    ids = np.concatenate([home["r"].to_numpy(), other["r"].to_numpy()])
    label = ids.copy()
    h = len(home)
    while True:
        up = np.where(near, label[None, h:], np.iinfo(np.int64).max).min(axis=1, initial=2 ** 63 - 1)
        label[:h] = np.minimum(label[:h], up)
        down = np.where(near, label[:h, None], np.iinfo(np.int64).max).min(axis=0, initial=2 ** 63 - 1)
        fresh = np.minimum(label[h:], down)
        if (fresh == label[h:]).all():
            break
        label[h:] = fresh
    return pd.DataFrame({"r": ids, "links": np.concatenate([n_home, n_other]), "root": label})


# --- the operator ---------------------------------------------------------------

def usable(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


def encoded(vectors: DataFrame, fit_rows: int) -> DataFrame:
    """``vectors`` (r, dim, v and others) with their codes c0 and c1."""
    spot = F.pmod(F.xxhash64(F.lit("fit"), "r"), F.lit(1 << 20))
    sizes = {r["dim"]: r["n"] for r in vectors.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    share = F.create_map(*[F.lit(x) for d, n in sizes.items() for x in (
        d, int((1 << 20) * min(1.0, fit_rows / n)))]) if sizes else None
    models = {}
    if sizes:
        sample = vectors.where(spot < share[F.col("dim")]).select("dim", "v").toPandas()
        models = {d: fit(np.stack(g["v"].to_list()).astype(np.float64), int(d))
                  for d, g in sample.groupby("dim")}
    shared = vectors.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            codes = np.zeros((CODES, len(b)), dtype=np.int64)
            for d, at in b.groupby("dim").indices.items():
                x = np.stack(b["v"].iloc[at].to_list()).astype(np.float64)
                model = shared.value.get(d) or fit(x[:0], int(d))
                codes[:, at] = encode(x, model)
            yield pd.DataFrame({"r": b["r"], **{f"c{c}": codes[c] for c in range(CODES)}})

    codes = vectors.select("r", "dim", "v").mapInPandas(run, "r long, c0 long, c1 long")
    return vectors.drop("v").join(materialize(codes), "r")


def near_duplicates(vectors: DataFrame, least: float = 0.98, max_bits: int = 32,
                    fit_rows: int = 8_000, id_col: str = "vec_id", vec_col: str = "embedding",
                    group_col: str = "label") -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(group_col).alias("label"),
        F.col(vec_col).alias("v"), (usable(v) & F.col(group_col).isNotNull()).alias("on"))
    rows = rows.select("*", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit("again"), "v").alias("h2"))
    same = ["label", "h1", "h2"]
    # One row a different vector. Its number is written, so it stays what it is.
    found = materialize(rows.where("on").groupBy(*same).agg(
        F.min("vec_id").alias("least"), F.count("*").alias("m"), F.first("v").alias("v"))
        .withColumns({"r": F.monotonically_increasing_id(), "dim": F.size("v")}))
    coded = encoded(found.select("r", "label", "dim", "v"), fit_rows)
    homes, others = tiles(materialize(members(coded)))
    homes = materialize(with_partner(homes, others, max_bits))
    others = materialize(with_partner(others, homes, max_bits))

    def originals(rows: DataFrame) -> DataFrame:
        return rows.join(found.select("r", F.col("m").alias("m"), F.col("v").alias("v")), "r")

    def judge(home: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        if not len(home) or not len(other):
            return pd.DataFrame({"r": [], "links": [], "root": []}).astype("int64")
        return tile_links(home, other, least, max_bits, int(home["t"].iloc[0]))

    links = materialize(originals(homes).groupBy(*KEY).cogroup(
        originals(others).groupBy(*KEY)).applyInPandas(
        judge, "r long, links long, root long"))
    roots = components(links.where("r != root").select(F.col("r").alias("a"),
                                                       F.col("root").alias("b")))
    counts = links.groupBy("r").agg(F.sum("links").alias("links"))
    known = found.drop("v", "dim").join(counts, "r", "left").join(
        roots.withColumnRenamed("node", "r"), "r", "left").withColumn(
        "root", F.coalesce("root", "r"))
    named = known.groupBy("root").agg(F.min("least").alias("component_id"))
    # Written, so that a vector with many copies meets one plain row and can be split.
    known = materialize(known.join(named, "root").select(
        *[F.col(c).alias(f"k_{c}") for c in same], "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("links")))
    # Rows that take no part have no partner in ``known``: a key of theirs is null.
    keys = rows.select("vec_id", *[F.when(F.col("on"), F.col(c)).alias(c) for c in same], "on")
    out = keys.join(known, reduce(lambda a, b: a & b, [
        F.col(c) == F.col(f"k_{c}") for c in same]), "left")
    component = F.when(F.col("on"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
