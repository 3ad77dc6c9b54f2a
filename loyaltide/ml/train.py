"""Splitting, training, evaluating and scoring churn models."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltide.functions.columns import as_list, safe_ratio
from loyaltide.ml.areas import areas
from loyaltide.ml.pipeline import LABEL, SEED, build_pipeline, param_grid, save_model
from loyaltide.operators.profile import class_weights, confusion_matrix, sample_weights
from loyaltide.plans.staging import stage

# Split and cross-validation.
TRAIN_SHARE = 0.8
FOLDS = 3
PARALLEL_FITS = 2


def with_split(df: DataFrame, key: str | Sequence[str] = "customer_unique_id", share: float = TRAIN_SHARE,
               seed: int = SEED) -> DataFrame:
    """Adds ``split``, train or test by a hash of the key: the same however the rows are partitioned."""
    bucket = _drawn(key, seed) % 10_000
    return df.withColumn("split", F.when(bucket < round(share * 10_000), "train").otherwise("test"))


def _drawn(key: str | Sequence[str], seed: int | str) -> Column:
    digest = F.md5(F.concat_ws("|", *as_list(key), F.lit(seed)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def with_fold(df: DataFrame, key: str | Sequence[str] = "customer_unique_id", folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """Adds ``fold``, 0 to folds - 1, by a hash of the key: a key's rows share one, at every run and partitioning."""
    return df.withColumn("fold", (_drawn(key, f"fold {seed}") % folds).cast("int"))


def train_test_split(df: DataFrame, key: str | Sequence[str] = "customer_unique_id",
                     share: float = TRAIN_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, key, share, seed)
    return tuple(marked.filter(F.col("split") == part).drop("split") for part in ("train", "test"))


def random_split(df: DataFrame, share: float = TRAIN_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split; it depends on how the rows are partitioned."""
    train, test = df.randomSplit([share, 1 - share], seed=seed)
    return train, test


def fit(train: DataFrame, kind: str = "gbt", cross_validate: bool = False, folds: int = FOLDS,
        weighted: bool = False, key: str | Sequence[str] = "customer_unique_id", **columns) -> PipelineModel:
    """Fit a pipeline, over the parameter grid by area under ROC if ``cross_validate``.

    The rows are cached for the passes of the fit and released after it.
    """
    if cross_validate:
        return search(train, kind, folds, weighted, key, **columns)[0]
    if weighted:
        train = sample_weights(train, class_weights(train))
    train = train.persist()
    try:
        return build_pipeline(kind, weight_col="sample_weight" if weighted else None, **columns).fit(train)
    finally:
        train.unpersist()


def search(train: DataFrame, kind: str = "gbt", folds: int = FOLDS, weighted: bool = False,
           key: str | Sequence[str] = "customer_unique_id", grid: Sequence[dict] | None = None,
           **columns) -> tuple[PipelineModel, DataFrame]:
    """Cross-validation by key over a parameter grid: the best model, fitted to all rows, and the table of the grid.

    The table has a row per grid point: ``parameters`` (a map), the mean and
    deviation of the area under ROC over the folds, and whether it is the best.
    The grid varies the classifier alone, so a fold's preprocessing is fitted
    once, to its training rows, and its inputs are cached for all grid points.
    """
    if weighted:
        train = sample_weights(train, class_weights(train))
    *before, estimator = build_pipeline(kind, weight_col="sample_weight" if weighted else None, **columns).getStages()
    points = list(grid) if grid is not None else param_grid(estimator, kind)
    evaluator = BinaryClassificationEvaluator(labelCol=LABEL, numBins=0)
    train = with_fold(train, key, folds).persist()
    try:
        scores = []
        for fold in range(folds):
            with _inputs(before, train.filter(F.col("fold") != fold), estimator) as (prepared, fitting), \
                    _cached(prepared.transform(train.filter(F.col("fold") == fold)), estimator) as held, \
                    ThreadPool(PARALLEL_FITS) as pool:
                def area(point, fitting=fitting, held=held):
                    return evaluator.evaluate(estimator.fit(fitting, point).transform(held))

                scores.append(pool.map(inheritable_thread_target(train.sparkSession)(area), points, 1))
        means, deviations = np.mean(scores, axis=0), np.std(scores, axis=0)
        best = max(means)
        with _inputs(before, train, estimator) as (prepared, fitting):
            model = PipelineModel([*prepared.stages, estimator.fit(fitting, points[int(np.argmax(means))])])
    finally:
        train.unpersist()
    rows = [({p.name: float(v) for p, v in point.items()}, float(mean), float(deviation), bool(mean == best))
            for point, mean, deviation in zip(points, means, deviations)]
    table = train.sparkSession.createDataFrame(
        rows, "parameters map<string,double>, mean_auc_roc double, std_auc_roc double, best boolean")
    return model, table


@contextmanager
def _cached(rows: DataFrame, estimator):
    """The columns that a classifier reads, cached inside the block."""
    wanted = [estimator.getFeaturesCol(), LABEL, *([estimator.getWeightCol()] if estimator.isSet("weightCol") else [])]
    kept = rows.select(*wanted).persist()
    try:
        yield kept
    finally:
        kept.unpersist()


@contextmanager
def _inputs(before: Sequence, rows: DataFrame, estimator):
    """The preprocessing fitted to the rows, and their inputs for the classifier."""
    prepared = Pipeline(stages=list(before)).fit(rows)
    with _cached(prepared.transform(rows), estimator) as kept:
        yield prepared, kept


def count_metrics(confusion: DataFrame, label_col: str = LABEL, prediction_col: str = "prediction") -> DataFrame:
    """Accuracy, F1, and precision and recall weighted by class size, from confusion counts."""
    label, predicted = F.col(label_col).cast("double"), F.col(prediction_col).cast("double")
    none = F.lit(0).cast("bigint")
    hits = F.when(label == predicted, F.col("count")).otherwise(none)
    per_class = confusion.select(F.inline(F.array(
        F.struct(label.alias("class"), F.col("count").alias("actual"), none.alias("predicted"), hits.alias("hits")),
        F.struct(predicted.alias("class"), none.alias("actual"), F.col("count").alias("predicted"),
                 none.alias("hits")),
    ))).groupBy("class").agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hits")])
    precision = safe_ratio(F.col("hits"), F.col("predicted"), 0.0)
    recall = safe_ratio(F.col("hits"), F.col("actual"), 0.0)
    scored = per_class.withColumns({"p": precision, "r": recall}).withColumn(
        "f", safe_ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r"), 0.0))
    rows = F.sum("actual")
    return scored.agg(
        (F.sum("hits") / rows).alias("accuracy"),
        *[(F.sum(F.col("actual") * F.col(c)) / rows).alias(name)
          for c, name in (("f", "f1"), ("p", "precision"), ("r", "recall"))])


def evaluate(predictions: DataFrame) -> DataFrame:
    """One row with area under ROC and PR, accuracy, F1, weighted precision and recall."""
    score = vector_to_array("rawPrediction")[1]
    predictions = stage(predictions.select(LABEL, score.alias("score"), "prediction"), "predictions")
    counts = count_metrics(confusion_matrix(predictions))
    found = areas(predictions, "score", LABEL).withColumn("counts", counts.agg(F.first(F.struct(*counts.columns))).scalar())
    measures = ["auc_roc", "auc_pr", *[f"counts.{c}" for c in counts.columns]]
    return found.select(*[F.round(c, 4).alias(c.split(".")[-1]) for c in measures])


def run_training(features: DataFrame, kind: str = "gbt", cross_validate: bool = False, weighted: bool = False,
                 key: str | Sequence[str] = "customer_unique_id",
                 save_to: str | None = None) -> tuple[PipelineModel, DataFrame]:
    """Split labelled rows, fit, evaluate on the held-out part and save. Gives the model and its metrics."""
    train, test = train_test_split(features.filter(F.col(LABEL).isNotNull()), key)
    model = fit(train, kind, cross_validate, weighted=weighted, key=key)
    metrics = evaluate(model.transform(test)).withColumn("classifier", F.lit(kind))
    if save_to:
        save_model(model, save_to)
    return model, metrics
