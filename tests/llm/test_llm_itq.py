"""Near-duplicate vectors: codes, tables, links and components against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeframe.llm import itq

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, ids, vectors, labels, extra=""):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], l)
                                  for i, v, l in zip(ids, vectors, labels)], SCHEMA)


def brute(ids, vectors, labels, least=0.98):
    n = len(ids)
    ok = [v is not None and len(v) and None not in list(v) and np.isfinite(v).all() and np.any(v)
          and l is not None for v, l in zip(vectors, labels)]
    near = np.zeros((n, n), dtype=bool)
    for a in range(n):
        for b in range(n):
            if a != b and ok[a] and ok[b] and labels[a] == labels[b] and \
                    len(vectors[a]) == len(vectors[b]):
                x, y = (np.array(vectors[i], dtype=np.float32).astype(float) for i in (a, b))
                near[a, b] = x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least
    label = np.arange(n)
    while True:
        step = np.where(near, label[None, :], n).min(axis=1)
        step = np.minimum(step, label)
        if (step == label).all():
            break
        label = step
    out = []
    for a in range(n):
        part = [ids[b] for b in range(n) if label[b] == label[a] and ids[b] is not None]
        comp = min(part) if part else None
        out.append((ids[a], int(near[a].sum()), comp, ids[a] == comp))
    return sorted(out, key=str)


def clusters(seed=3, dim=64, groups=30, size=12, spread=0.06, alone=400):
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for g in range(groups):
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            rows.append(centre + rng.normal(size=dim) * spread * rng.random() / np.sqrt(dim) * 2)
            labels.append(g % 3)
    rows += list(rng.normal(size=(alone, dim)))
    labels += [int(x) for x in rng.integers(0, 3, alone)]
    return rows, labels


def got(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, df.collect()), key=str)


def test_links_match_brute_force(spark):
    rows, labels = clusters()
    rows += [rows[5]] * 40 + [rows[6] * 2] * 3
    labels += [labels[5]] * 40 + [labels[6]] * 3
    ids = list(range(1000, 1000 + len(rows)))
    want = brute(ids, rows, labels)
    assert sum(w[1] for w in want) > 2000
    assert got(itq.near_duplicates(frame(spark, ids, rows, labels))) == want


def test_recall_at_the_threshold(spark):
    """Pairs whose cosine lies just above the threshold are the hardest to retrieve."""
    rng = np.random.default_rng(11)
    rows = []
    for _ in range(1500):
        x = rng.normal(size=64)
        x /= np.linalg.norm(x)
        y = rng.normal(size=64)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        c = 0.9801
        rows += [x, c * x + np.sqrt(1 - c * c) * y]
    out = itq.near_duplicates(frame(spark, range(3000), rows, [0] * 3000))
    assert out.where("n_links > 0").count() >= 0.995 * 3000


@pytest.mark.parametrize("dim", [2, 5, 20, 100])
def test_other_lengths(spark, dim):
    rows, labels = clusters(seed=dim, dim=dim, groups=6, size=8, spread=0.1, alone=60 if dim > 4 else 5)
    ids = list(range(len(rows)))
    want, have = brute(ids, rows, labels), got(itq.near_duplicates(frame(spark, ids, rows, labels)))
    found, all_ = sum(h[1] for h in have), sum(w[1] for w in want)
    assert all(h[1] <= w[1] for h, w in zip(have, want)) and found >= 0.99 * all_ > 0


def test_large_groups_are_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(itq, "TILE", 16)
    rows, labels = clusters(groups=3, size=90, spread=0.03, alone=50)
    ids = list(range(len(rows)))
    assert got(itq.near_duplicates(frame(spark, ids, rows, labels))) == brute(ids, rows, labels)


def test_awkward_rows(spark):
    e = np.eye(4)[0].tolist()
    vectors = [None, [], [0.0] * 4, [None, 1.0, 0.0, 0.0], [float("nan"), 1, 0, 0],
               [float("inf"), 1, 0, 0], e, e, e, e, [1.0, 0.01, 0, 0], [1.0, 0.0], e, e,
               [0, 1.0, 0, 0], [0, 1.0, 0.001, 0]]
    ids = [1, 2, 3, 4, 5, 6, 7, 7, None, 8, 2 ** 60 + 1, 9, 10, 11, None, None]
    labels = [0] * 12 + [None, 1, 2, 2]
    docs = frame(spark, ids, vectors, labels).select(
        "*", *[F.lit(7).alias(c) for c in ("r", "m", "v", "t", "dim", "links", "root", "c0")])
    assert got(itq.near_duplicates(docs)) == brute(ids, vectors, labels)
    empty = itq.near_duplicates(spark.createDataFrame([], SCHEMA))
    assert got(empty) == []


def test_rotation_balances_and_quantises():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 32)) * np.linspace(3, 0.2, 32)
    mean, projections = itq.fit(x, 32)
    codes = itq.encode(x, (mean, projections))
    bits = np.unpackbits(codes[0].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :32]
    assert np.abs(bits.mean(axis=0) - 0.5).max() < 0.1
    unit = x / np.linalg.norm(x, axis=1, keepdims=True) - mean

    def loss(p):
        y = unit @ p
        y = y / np.abs(y).mean()
        return ((np.sign(y) - y) ** 2).sum()
    axes = np.linalg.eigh(unit.T @ unit)[1]
    assert loss(projections[0]) < loss(axes)
    assert np.allclose(projections[0].T @ projections[0], np.eye(32), atol=1e-8)
