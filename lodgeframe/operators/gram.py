"""Price model from sufficient statistics: every fit of the tuning grid from one set of sums.

A Gaussian / identity GLM needs nothing of the data but counts, means and covariances. They
are aggregated once per (split part, fold); the training set of a fold is the pooled sum of
the other folds, so all folds and settings are small solves on matrices of the features.

Label indexes differ from fold to fold, because a fold's encoder sees its training rows
alone. They need no further pass over the rows: the numeric sums per pair of category
values are enough for every index, whatever the number of labels. Only matrices and one
row per (fold, group) reach the driver, never rows or labels.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.operators.model import (CATEGORICAL, CV_FOLDS, CV_REG_PARAMS, FEATURES,
                                        GLM_REG_PARAM, LABEL, fold_column, log_label,
                                        split_bucket)
from lodgeframe.operators.util import materialize, prefix_sums

# The training set without a fold left out.
ALL = -1
INDEXES = tuple(out for _, out in CATEGORICAL)


@dataclass(frozen=True)
class Moments:
    """Count, means and centred sums of products of the features and the label (last)."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        if not self.n or not other.n:
            return self if self.n else other
        n, gap = self.n + other.n, other.mean - self.mean
        return Moments(n, self.mean + gap * (other.n / n), self.products + other.products
                       + np.outer(gap, gap) * (self.n * other.n / n))

    def ridge(self, reg_param: float) -> tuple[np.ndarray, float]:
        """(coefficients, intercept): features and label standardised, as MLlib does.

        A feature without variance gets 0; so do all where the label has none.
        """
        deviation = np.sqrt(np.diag(self.products) / self.n)
        x, y = deviation[:-1], deviation[-1]
        if y == 0:
            return np.zeros(len(x)), float(self.mean[-1])
        scale = np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > 0)
        corr = self.products / self.n * np.outer(scale, scale)
        left = corr[:-1, :-1] + np.diag(np.where(x > 0, reg_param / y, 1.0))
        solution = np.linalg.lstsq(left, corr[:-1, -1], rcond=None)[0] if reg_param == 0 \
            else np.linalg.solve(left, corr[:-1, -1])
        slopes = solution * scale[:-1] * y
        return slopes, float(self.mean[-1] - slopes @ self.mean[:-1])

    def rmse(self, slopes: np.ndarray, intercept: float) -> float:
        """Error of a model on the rows behind these moments (NaN without rows)."""
        if not self.n:
            return float("nan")
        w = np.append(slopes, -1.0)
        bias = w @ self.mean + intercept
        return float(np.sqrt(max(w @ self.products @ w, 0.0) / self.n + bias * bias))


@dataclass(frozen=True)
class PriceModel:
    """Coefficients, and the label indexes as a table (column_name, value, index)."""

    features: tuple[str, ...]
    coefficients: np.ndarray
    intercept: float
    indexes: DataFrame | None
    sizes: dict[str, int]

    def _indexed(self, df: DataFrame) -> DataFrame:
        """``df`` with the index columns; unseen and NULL values get the index after the last.

        Columns of ``df`` that bear an index column's name are replaced.
        """
        for source, out in CATEGORICAL:
            if out not in self.features:
                continue
            table = self.indexes.where(F.col("column_name") == source).select(
                F.col("value").alias(f"_{out}"), F.col("index").alias(out))
            df = df.drop(out).join(table, F.col(source) == F.col(f"_{out}"), "left").drop(f"_{out}") \
                .withColumn(out, F.coalesce(out, F.lit(self.sizes[source])).cast("double"))
        return df

    def _sum(self, leave_out: str | None = None) -> Column:
        total = F.lit(self.intercept)
        for f, c in zip(self.features, self.coefficients):
            if f != leave_out:
                total = total + F.lit(float(c)) * F.col(f)
        return total

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the index columns and ``prediction`` (NULL where a feature is)."""
        return self._indexed(df).withColumn("prediction", self._sum())

    def lines(self, df: DataFrame, along: str = "future_occupancy") -> DataFrame:
        """``df`` with (intercept, slope) of each row's ``intercept - slope * along``.

        The form ``profit.closed_form_log_price`` takes, so a grid over ``along`` needs
        neither the other features nor the label joins.
        """
        slope = -float(self.coefficients[self.features.index(along)])
        return self._indexed(df).withColumn("intercept", self._sum(along)) \
            .withColumn("slope", F.lit(slope))


def labelled(cleaned: DataFrame, seed: int = 5, features: Sequence[str] = FEATURES,
             folds: int = CV_FOLDS) -> DataFrame:
    """The written model table: ``id``, features, label, ``_part`` (0 train, 1 held out), ``_fold``.

    Rows without a label or without some numeric feature take no part in a fit; MLlib's
    assembler would make them NaN.
    """
    indexed = {out: source for source, out in CATEGORICAL}
    numeric = [f for f in features if f not in indexed]
    data = log_label(cleaned).dropna(subset=numeric) if numeric else log_label(cleaned)
    return materialize(data.select(
        "id", LABEL, *[F.col(f).cast("double").alias(f) for f in numeric],
        *[indexed[f] for f in features if f in indexed],
        F.when(split_bucket("id", seed) < 80, 0).otherwise(1).alias("_part"),
        fold_column("id", folds).alias("_fold")))


def _numeric_moments(data: DataFrame, columns: Sequence[str], pivot: Sequence[float]) -> dict:
    """{(part, fold): Moments} of numeric columns, in one aggregate.

    Plain sums of the distances from ``pivot`` (the means over all rows, so nothing cancels)
    take half the time of as many ``covar_pop``.
    """
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    near = data.select("_part", "_fold", *[(F.col(c) - F.lit(float(p))).alias(c)
                                           for c, p in zip(columns, pivot)])
    rows = near.groupBy("_part", "_fold").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(columns)],
        *[F.sum(F.col(columns[i]) * F.col(columns[j])).alias(f"p{i}_{j}")
          for i, j in pairs]).collect()
    out = {}
    for r in rows:
        sums = np.array([r[f"s{i}"] for i in range(len(columns))])
        products = np.zeros((len(columns), len(columns)))
        for i, j in pairs:
            products[i, j] = products[j, i] = r[f"p{i}_{j}"] - sums[i] * sums[j] / r["n"]
        out[r["_part"], r["_fold"]] = Moments(r["n"], np.array(pivot) + sums / r["n"], products)
    return out


def label_indexes(groups: DataFrame, columns: Sequence[str], variants: Sequence[int]) -> DataFrame:
    """(column_name, variant, value, index): M1 on the training rows of every variant.

    ``groups`` holds counts ``n`` by part, fold and value; variant k leaves fold k out.
    Frequency descending, ties by value, ranked by ranges and offsets.
    """
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"))
                                 for c in columns]))
    counts = groups.where(F.col("_part") == 0).select(values.alias("v"), "_fold", "n") \
        .where(F.col("v.value").isNotNull()).groupBy("v", "_fold").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("variant", F.explode(F.lit(list(variants)))) \
        .where(F.col("_fold") != F.col("variant")) \
        .groupBy("v.column_name", "variant", "v.value").agg(F.sum("n").alias("n"))
    ranked = materialize(prefix_sums(counts, [F.col("column_name"), F.col("variant"), -F.col("n"),
                                              F.col("value")], F.lit(1), into="_at"))
    first = ranked.groupBy("column_name", "variant").agg(F.min("_at").alias("_first"))
    return ranked.join(first, ["column_name", "variant"]).select(
        "column_name", "variant", "value", (F.col("_at") - F.col("_first")).alias("index"))


def fold_moments(data: DataFrame, features: Sequence[str] = FEATURES,
                 variants: Sequence[int] = (ALL,)):
    """({(variant, part, fold): Moments}, label indexes or None, {(column, variant): labels})."""
    used = [(source, out) for source, out in CATEGORICAL if out in features]
    outs = [out for _, out in used]
    columns = [f for f in features if f not in outs] + [LABEL]
    pivot = data.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    if pivot[0] is None:
        raise ValueError("no row has a label and every feature")
    plain = _numeric_moments(data, columns, pivot)
    order = [*features, LABEL]
    if not used:
        return {(k, *key): m for k in variants for key, m in plain.items()}, None, {}

    sources = [source for source, _ in used]
    groups = materialize(data.groupBy("_part", "_fold", *sources).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(c) - F.lit(float(p))).alias(f"s{j}")
          for j, (c, p) in enumerate(zip(columns, pivot))]))
    indexes = materialize(label_indexes(groups, sources, variants))
    sizes = {(r["column_name"], r["variant"]): r["n"] for r in indexes.groupBy(
        "column_name", "variant").agg(F.count(F.lit(1)).alias("n")).collect()}

    spread = groups.withColumn("variant", F.explode(F.lit(list(variants))))
    for source, out in used:
        table = indexes.where(F.col("column_name") == source).select(
            "variant", F.col("value").alias(source), F.col("index").alias(out))
        after = F.coalesce(*[F.when(F.col("variant") == k, sizes.get((source, k), 0))
                             for k in variants])
        spread = spread.join(table, ["variant", source], "left").withColumn(
            out, F.coalesce(out, after).cast("double"))
    n = F.col("n")
    rows = spread.groupBy("variant", "_part", "_fold").agg(
        *[F.sum(n * F.col(o)).alias(f"i{a}") for a, o in enumerate(outs)],
        *[F.sum(n * F.col(o) * F.col(q)).alias(f"i{a}_{b}")
          for a, o in enumerate(outs) for b, q in enumerate(outs) if a <= b],
        *[F.sum(F.col(o) * F.col(f"s{j}")).alias(f"x{a}_{j}")
          for a, o in enumerate(outs) for j in range(len(columns))]).collect()

    out, place = {}, {c: i for i, c in enumerate(order)}
    at = [place[c] for c in columns]
    for r in rows:
        base = plain[r["_part"], r["_fold"]]
        mean, products = np.zeros(len(order)), np.zeros((len(order), len(order)))
        mean[at] = base.mean
        products[np.ix_(at, at)] = base.products
        centre = [r[f"i{a}"] / base.n for a in range(len(outs))]
        for a, o in enumerate(outs):
            i = place[o]
            mean[i] = centre[a]
            for j, p in enumerate(at):
                products[i, p] = products[p, i] = \
                    r[f"x{a}_{j}"] - r[f"i{a}"] * (base.mean[j] - pivot[j])
            for b in range(a, len(outs)):
                q = place[outs[b]]
                products[i, q] = products[q, i] = r[f"i{a}_{b}"] - r[f"i{a}"] * centre[b]
        out[r["variant"], r["_part"], r["_fold"]] = Moments(base.n, mean, products)
    return out, indexes, sizes


def _pool(moments: dict, variant: int, part: int, folds) -> Moments:
    width = len(next(iter(moments.values())).mean)
    total = Moments(0, np.zeros(width), np.zeros((width, width)))
    for (k, p, f), m in sorted(moments.items(), key=lambda x: x[0]):
        if k == variant and p == part and f in folds:
            total = total + m
    return total


def _model(training: Moments, reg_param: float, features, indexes, sizes) -> PriceModel:
    if not training.n:
        raise ValueError("the training part has no row with a label and every feature")
    slopes, intercept = training.ridge(reg_param)
    if indexes is not None:
        indexes = indexes.where(F.col("variant") == ALL).drop("variant")
    return PriceModel(tuple(features), slopes, intercept, indexes,
                      {source: sizes.get((source, ALL), 0) for source, _ in CATEGORICAL})


def fit(cleaned: DataFrame, seed: int = 5, reg_param: float = GLM_REG_PARAM,
        features: Sequence[str] = FEATURES) -> tuple[PriceModel, DataFrame]:
    """(model of the 80 % split, the held-out rows with ``prediction``).

    Equal to ``model.fit_price_model`` with ``handle_invalid='keep'`` up to rounding.
    """
    data = labelled(cleaned, seed, features)
    moments, indexes, sizes = fold_moments(data, features)
    model = _model(_pool(moments, ALL, 0, range(CV_FOLDS)), reg_param, features, indexes, sizes)
    return model, model.transform(data.where(F.col("_part") == 1).drop("_part", "_fold"))


def tune(cleaned: DataFrame, seed: int = 5, reg_params=CV_REG_PARAMS, folds: int = CV_FOLDS,
         features: Sequence[str] = FEATURES) -> tuple[PriceModel, DataFrame]:
    """M5 + K9: the table of ``model.tune_price_model`` without a fit per fold and setting.

    Folds without rows on either side are left out of the mean.
    """
    data = labelled(cleaned, seed, features, folds)
    moments, indexes, sizes = fold_moments(data, features, [ALL, *range(folds)])
    every = set(range(folds))
    errors = {rp: [] for rp in reg_params}
    for k in range(folds):
        training, held = _pool(moments, k, 0, every - {k}), _pool(moments, k, 0, {k})
        if training.n and held.n:
            for rp in reg_params:
                errors[rp].append(held.rmse(*training.ridge(rp)))
    means = [float(np.mean(errors[rp])) if errors[rp] else float("nan") for rp in reg_params]
    best = min(range(len(means)), key=lambda i: (means[i] != means[i], means[i], i))
    training = _pool(moments, ALL, 0, every)
    model = _model(training, reg_params[best], features, indexes, sizes)
    fitted = model.coefficients, model.intercept
    train_rmse, held_rmse = training.rmse(*fitted), _pool(moments, ALL, 1, every).rmse(*fitted)
    out = [(float(rp), m, i == best, train_rmse if i == best else None,
            held_rmse if i == best else None) for i, (rp, m) in enumerate(zip(reg_params, means))]
    return model, cleaned.sparkSession.createDataFrame(
        out, "reg_param double, cv_rmse double, is_best boolean, train_rmse double, "
             "validation_rmse double")
