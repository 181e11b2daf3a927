"""Price model: label encoding, deterministic split, GLM fit / tune / score.

Fitting is MLlib's distributed work (Gaussian / identity GLM is solved in
closed form from one tree-aggregated normal-equation pass); the driver only
holds model coefficients and metrics.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.operators.util import materialize, prefix_sums

# Fixed list (schema order) of numeric model inputs; the two label indices follow.
NUMERIC_FEATURES = (
    "latitude", "longitude", "num_bus_2km", "num_subway_2km", "num_shop_2km",
    "nearest_shop_m", "num_restaurant_2km", "accommodates", "baths", "beds", "days",
    "amenities", "future_occupancy",
)
CATEGORICAL = (("neighbourhood_cleansed", "neighbourhood_index"),
               ("room_type", "room_type_index"))
FEATURES = NUMERIC_FEATURES + tuple(out for _, out in CATEGORICAL)
LABEL = "label"

# GLM settings and tuning grid of the price model.
GLM_REG_PARAM = 0.01
GLM_MAX_ITER = 0
CV_REG_PARAMS = (1e-5, 1e-4, 1e-3, 1e-2, 0.1, 0.15, 0.2, 0.3)
CV_FOLDS = 5


def log_label(df: DataFrame, price_col: str = "price") -> DataFrame:
    """C17: label = log(price); rows whose label is NULL (price <= 0 or NULL) are left out.

    MLlib refuses NULL labels, so they cannot be part of a fit.
    """
    return df.withColumn(LABEL, F.log(F.col(price_col))).where(F.col(LABEL).isNotNull())


def split_bucket(key: str, seed: int = 5) -> Column:
    """``pmod(key * 48271 + seed, 100)``, for keys of any size."""
    small = F.pmod(F.col(key).cast("long"), F.lit(100))
    return F.pmod(small * F.lit(48271) + F.lit(seed), F.lit(100))


def hash_split(df: DataFrame, key: str, weights=(0.8, 0.2), seed: int = 5) -> list[DataFrame]:
    """M6: deterministic split on ``split_bucket``.

    Unlike ``randomSplit`` the assignment does not depend on partitioning, so a
    recomputed task (lost executor) puts every row in the same part again.
    """
    bucket = split_bucket(key, seed)
    total = float(sum(weights))
    parts, lo = [], 0
    for i, w in enumerate(weights):
        hi = 100 if i == len(weights) - 1 else lo + int(round(100 * w / total))
        parts.append(df.where((bucket >= lo) & (bucket < hi)))
        lo = hi
    return parts


def fold_column(key: str, folds: int):
    """Fold number of a row from its key alone, so folds do not depend on partitioning."""
    return F.pmod(F.pmod(F.col(key).cast("long"), F.lit(1009)) * F.lit(31) + F.lit(7),
                  F.lit(folds)).cast("int")


def indexers(handle_invalid: str = "error") -> list[StringIndexer]:
    """M1: frequency-descending label encoders (ties alphabetical)."""
    return [StringIndexer(inputCol=i, outputCol=o, stringOrderType="frequencyDesc",
                          handleInvalid=handle_invalid) for i, o in CATEGORICAL]


def label_index(df: DataFrame, column: str) -> DataFrame:
    """M1 as a table: (value, index) of one string column, for any number of labels.

    The same order as the encoder's (frequency descending, ties alphabetical), ranked by
    range partitions and their offsets; no label reaches the driver.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count("*").alias("n"))
    ranked = prefix_sums(counts, [-F.col("n"), F.col("value")], F.lit(1), into="index")
    return ranked.select("value", F.col("index").cast("int").alias("index"))


def price_pipeline(reg_param: float = GLM_REG_PARAM, max_iter: int = GLM_MAX_ITER,
                   features=FEATURES, handle_invalid: str = "error") -> Pipeline:
    """M2 + M3 + M4: indexers (of the category features used) -> assembler -> GLM."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features",
                                handleInvalid=handle_invalid)
    glm = GeneralizedLinearRegression(featuresCol="features", labelCol=LABEL,
                                      predictionCol="prediction", family="gaussian",
                                      link="identity", maxIter=max_iter, regParam=reg_param)
    encoders = [i for i in indexers(handle_invalid) if i.getOutputCol() in features]
    return Pipeline(stages=encoders + [assembler, glm])


def rmse(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """One-row RMSE table."""
    d = F.col(label) - F.col(prediction)
    return pred.agg(F.sqrt(F.avg(d * d)).alias("rmse"))


def fit_price_model(cleaned: DataFrame, seed: int = 5, reg_param: float = GLM_REG_PARAM,
                    max_iter: int = GLM_MAX_ITER, handle_invalid: str = "error"):
    """Train on the 80% hash split; returns (model, validation predictions).

    ``handle_invalid='keep'`` gives categories unseen in training their own
    index instead of failing on the held-out rows. The labelled input is
    written once (to the session's checkpoint folder) so the fit's several
    passes do not recompute its lineage.
    """
    data = materialize(log_label(cleaned))
    train, validation = hash_split(data, "id", (0.8, 0.2), seed)
    model = price_pipeline(reg_param, max_iter, handle_invalid=handle_invalid).fit(train)
    return model, model.transform(validation)


def tune_price_model(cleaned: DataFrame, seed: int = 5, reg_params=CV_REG_PARAMS,
                     folds: int = CV_FOLDS, parallelism: int = 8, features=FEATURES,
                     handle_invalid: str = "keep"):
    """M5 + K9: k-fold cross-validation over reg_param; (best model, result table).

    The table has one row per reg_param: cv_rmse (mean over folds), is_best (the
    first one with the lowest mean, as CrossValidator picks it) and, on that row,
    the refitted model's RMSE on the training split and on the held-out split. A
    Gaussian / identity GLM is solved in closed form, so the original's maxIter
    axis cannot change a fit and is dropped. Folds come from the id
    (``fold_column``). Categories missing from a training fold get their own
    index (``keep``).
    """
    data = materialize(log_label(cleaned).withColumn("_fold", fold_column("id", folds)))
    train, validation = hash_split(data, "id", (0.8, 0.2), seed)
    pipe = price_pipeline(reg_params[0], features=features, handle_invalid=handle_invalid)
    glm = pipe.getStages()[-1]
    grid = ParamGridBuilder().addGrid(glm.regParam, list(reg_params)).build()
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid,
                        evaluator=RegressionEvaluator(labelCol=LABEL, metricName="rmse"),
                        numFolds=folds, foldCol="_fold", parallelism=parallelism)
    fitted = cv.fit(train)
    metrics = [float(m) for m in fitted.avgMetrics]
    best = min(range(len(metrics)), key=lambda i: (metrics[i], i))
    train_rmse, held_rmse = (rmse(fitted.bestModel.transform(p)).first()["rmse"]
                             for p in (train, validation))
    out = [(float(rp), m, i == best, train_rmse if i == best else None,
            held_rmse if i == best else None)
           for i, (rp, m) in enumerate(zip(reg_params, metrics))]
    table = cleaned.sparkSession.createDataFrame(
        out, "reg_param double, cv_rmse double, is_best boolean, train_rmse double, "
             "validation_rmse double")
    return fitted.bestModel, table


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Batch scoring."""
    return model.transform(df)


def one_feature_ridge(df: DataFrame, x: str, reg_param: float = GLM_REG_PARAM) -> DataFrame:
    """M3 with a single feature: (slope, intercept) of the fitted GLM, label = log(price)."""
    data = log_label(df).where(F.col(x).isNotNull())
    assembler = VectorAssembler(inputCols=[x], outputCol="features")
    glm = GeneralizedLinearRegression(featuresCol="features", labelCol=LABEL,
                                      family="gaussian", link="identity",
                                      maxIter=GLM_MAX_ITER, regParam=reg_param)
    model = glm.fit(assembler.transform(data))
    spark = df.sparkSession
    return spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))],
                                 "slope double, intercept double")


def coefficients(df: DataFrame, features, reg_param: float = GLM_REG_PARAM) -> DataFrame:
    """M3 over numeric features: one row (feature, value) per coefficient, and the intercept."""
    data = log_label(df).where(" AND ".join(f"{f} IS NOT NULL" for f in features))
    model = price_pipeline(reg_param, features=tuple(features)).fit(data).stages[-1]
    rows = [(f, float(c)) for f, c in zip(features, model.coefficients)]
    return df.sparkSession.createDataFrame([*rows, ("intercept", float(model.intercept))],
                                           "feature string, value double")
