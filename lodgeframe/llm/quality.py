"""Quality classifier by positive-unlabelled learning (non-negative risk).

Trusted positives are labelled documents of quality 1; everything else is
unlabelled web text. With class prior p and logistic loss l, a linear model f on
style features minimises

    p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)]),

so f is the log-odds of quality and the score is its sigmoid. When the second
term turns negative, a step is taken against it (the non-negative correction).
The prior is estimated first, from positives and unlabelled texts alone: a plain
P-against-U model ranks held-back rows, and the least ratio of the share of U to
the share of P above a cut bounds the prior (best bin).

The fit uses a bounded sample: ``fit_rows`` positives and as many unlabelled
rows (expected number; rows are taken by a hash of their id, or of their text if they
have no id, so reruns agree). Rows that share the hash are one row of the sample, the
one with the least hash of its text: a much repeated id does not fill the driver.
Scoring covers every whole text. Labels, language, source and id are never
features.

Defined cases: a null text is scored like an empty one, and both get a score; a
document labelled both ways is not trusted; labels without a document and null
labels are ignored; without positives or without unlabelled rows every score is
0.5; repeated rows score alike; an empty table gives an empty result; other
input columns pass through, a column named ``score`` is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.common import fold

CLASSES = 16
STYLE = 16
N_FEATURES = CLASSES + CLASSES * CLASSES + STYLE
CHUNK = 1 << 20
SPAN = 1 << 20


def _class_table() -> np.ndarray:
    """Character class of each byte of UTF-8 text."""
    t = np.full(256, 15, dtype=np.uint8)
    t[:128] = 12
    groups = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t",
              "\n\r", ".", ",", "!", "?", "'\"", "-", "|", None, ":;()", "@/_="]
    for k, g in enumerate(groups):
        if g:
            t[np.frombuffer(g.encode(), dtype=np.uint8)] = k
    return t


CLASS_OF = _class_table()


def features(text: str | None) -> np.ndarray:
    """Style of a whole text: class and class-pair frequencies, word and line statistics."""
    text = text or ""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    pairs = np.zeros(CLASSES * CLASSES)
    for at in range(0, max(len(raw) - 1, 0), CHUNK):
        c = CLASS_OF[raw[at:at + CHUNK + 1]].astype(np.int32)
        pairs += np.bincount(c[:-1] * CLASSES + c[1:], minlength=CLASSES * CLASSES)
    single = pairs.reshape(CLASSES, CLASSES).sum(axis=1)
    w = text.split()
    n = max(len(w), 1)
    counts = Counter(w)
    sizes = np.fromiter(map(len, w), dtype=np.int64, count=len(w))
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(len(lines), 1)
    closed = sum(x.rstrip()[-1] in ".!?\"'”»…" for x in lines)
    style = [
        np.log1p(len(w)), len(counts) / n, max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(w, w[1:])) / n, len(set(zip(w, w[1:]))) / n,
        sizes.mean() / 10 if len(w) else 0.0, sizes.std() / 10 if len(w) else 0.0,
        (sizes > 20).sum() / n, (sizes == 1).sum() / n,
        sum(map(str.isupper, w)) / n, len(re.findall(r"[^\w\s]{2,}", text)) / n,
        closed / m, len(set(lines)) / m, len(w) / m / 50, float(not w), np.log1p(m),
    ]
    scale = max(len(raw), 1)
    return np.concatenate([np.sqrt(single / scale), np.sqrt(pairs / scale),
                           style]).astype(np.float32)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -4, 4) @ self.weights + self.bias


CONSTANT = Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0, 0.5)


def sigmoid(f: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(f / 2))


def minimise(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    """Adam on the full batch."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def estimate_prior(z_p: np.ndarray, z_u: np.ndarray, least: float = 0.02) -> float:
    """Best-bin bound on the share of positives in U, from scores of held-back rows."""
    cuts = np.unique(np.quantile(z_p, np.linspace(0.0, 1 - least, 200)))
    share_p = (z_p[None, :] >= cuts[:, None]).mean(axis=1)
    share_u = (z_u[None, :] >= cuts[:, None]).mean(axis=1)
    slack = 0.5 * (np.sqrt(np.log(20) / 2 / len(z_p)) + np.sqrt(np.log(20) / 2 / len(z_u)))
    best = np.argmin((share_u + slack) / share_p)
    return float(np.clip(share_u[best] / share_p[best], 0.02, 0.98))


def fit(p: np.ndarray, u: np.ndarray, steps: int = 400, rate: float = 0.05,
        l2: float = 1e-3, min_rows: int = 4) -> Model:
    """Non-negative PU fit on feature rows of positives and unlabelled texts."""
    if len(p) < min_rows or len(u) < min_rows:
        return CONSTANT
    mean, scale = u.mean(axis=0), u.std(axis=0)
    scale = np.where(scale > 1e-6, scale, 1.0)

    def rows(x: np.ndarray) -> np.ndarray:
        z = np.clip((x - mean) / scale, -4, 4)
        return np.column_stack([z, np.ones(len(z))]).astype(np.float32)

    xp, xu = rows(p), rows(u)
    ridge = np.full(xp.shape[1], l2)
    ridge[-1] = 0.0

    def against(w: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (-(a.T @ sigmoid(-(a @ w))) / len(a) + (b.T @ sigmoid(b @ w)) / len(b)) / 2 \
            + ridge * w

    halves = []
    for k in (0, 1):
        w = minimise(lambda w, k=k: against(w, xp[k::2], xu[k::2]), xp.shape[1],
                     steps // 2, rate)
        halves.append(estimate_prior(xp[1 - k::2] @ w, xu[1 - k::2] @ w))
    prior = float(np.mean(halves))

    def risk_gradient(w: np.ndarray) -> np.ndarray:
        fp, fu = xp @ w, xu @ w
        positive = -prior * (xp.T @ sigmoid(-fp)) / len(xp)
        negative = (xu.T @ sigmoid(fu)) / len(xu) - prior * (xp.T @ sigmoid(fp)) / len(xp)
        risk = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        return (positive + negative if risk >= 0 else -negative) + ridge * w

    w = minimise(risk_gradient, xp.shape[1], steps, rate)
    return Model(mean, scale, w[:-1], float(w[-1]), prior)


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = 6_000, folds: int = 5,
          held_out: int = 0) -> Model:
    """Fit on rows outside the held-out fold; see the module text for the sample."""
    open_fold = fold(F.col("doc_id"), folds) != held_out
    trusted = labels.where(F.col("doc_id").isNotNull() & open_fold).groupBy("doc_id").agg(
        F.min("quality").alias("low"), F.max("quality").alias("high")).where(
        "low = 1 AND high = 1").select("doc_id")
    rows = docs.where(open_fold)
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("fit"), "text")).otherwise(
        F.xxhash64(F.lit("fit"), "doc_id"))
    spot = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(SPAN))
    n_p, n_u = trusted.count(), rows.count()
    cut_p = int(SPAN * min(1.0, fit_rows / max(n_p, 1)))
    cut_u = int(SPAN * min(1.0, fit_rows / max(n_u, 1)))
    # About fit_rows ids at most, whatever the size of the labels.
    chosen = F.broadcast(trusted.where(spot < cut_p).withColumnRenamed("doc_id", "_p"))
    taken = rows.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_p"), "left")
    taken = taken.select(
        "text", key.alias("key"), F.xxhash64("text").alias("h"),
        F.col("_p").isNotNull().alias("is_p"),
        (F.pmod(key, F.lit(SPAN)) < cut_u).alias("is_u")).where("is_p OR is_u")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"key": b["key"], "h": b["h"], "is_p": b["is_p"], "is_u": b["is_u"],
                                "x": [features(t) for t in b["text"]]})

    found = taken.mapInPandas(run, "key long, h long, is_p boolean, is_u boolean, x array<float>")
    got = found.groupBy("key").agg(
        F.max("is_p").alias("is_p"), F.max("is_u").alias("is_u"),
        F.min_by("x", "h").alias("x")).toPandas().sort_values("key")
    if not len(got):
        return CONSTANT
    x = np.stack(got["x"].to_list()).astype(np.float32)
    return fit(x[got["is_p"].to_numpy(bool)], x[got["is_u"].to_numpy(bool)])


def score(docs: DataFrame, model: Model, text_col: str = "text",
          score_col: str = "score") -> DataFrame:
    """``docs`` with a score column, the model's probability of quality."""
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.stack([features(t) for t in texts]) if len(texts) else \
                np.zeros((0, N_FEATURES))
            yield pd.Series(sigmoid(model.margin(x)))

    return docs.withColumn(score_col, run(F.col(text_col)))
