"""Grids, cross-validation, comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..operators.ensemble.common import fit_all
from ..operators.splitting import with_fold
from ..sources.inline import inline_table
from ..sources.readers import schema_of

FOLD = "_fold"


def param_grid(values: Mapping[Param, Sequence]) -> list[dict]:
    """All combinations of the values; one empty point for an empty mapping."""
    builder = ParamGridBuilder()
    for param, options in values.items():
        builder = builder.addGrid(param, list(options))
    return builder.build()


def point_name(point: Mapping[Param, object]) -> str:
    """A grid point as ``name=value`` pairs joined by commas."""
    return ",".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda i: i[0].name))


def evaluator(metric: str, label: str = "label",
              prediction: str = "prediction") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                             metricName=metric)


def cross_validate(estimator: Estimator, grid: Sequence[dict], train: DataFrame, *, metric: str,
                   folds: int, key: str | None = None, parallelism: int = 1, seed: int = 42,
                   label: str = "label") -> CrossValidatorModel:
    """Mean metric per grid point over the folds, best point refitted on all of ``train``.

    With ``key`` folds are hash buckets of that column, the same whatever the partitioning;
    otherwise Spark draws them from ``seed``. ``train`` must not hold the test rows. Folds by key are
    conditions on one kept frame (the caller's, if it keeps one), accuracy is taken for all points of a
    fold in one pass, and multinomial naive Bayes is fitted on the ``class_totals`` of one pass.
    """
    validator = CrossValidator(estimator=estimator, estimatorParamMaps=list(grid),
                               evaluator=evaluator(metric, label), numFolds=folds, seed=seed,
                               parallelism=parallelism)
    if key is None:
        return validator.fit(train)
    keep = train.storageLevel == StorageLevel.NONE
    train = with_fold(train, F.col(key), folds, FOLD)
    if keep:
        train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        totals = class_totals(train, label, estimator.getFeaturesCol()) if _fits_on_totals(estimator, grid) else None
        if totals:
            filled = {fold for fold, _ in totals}
        else:
            filled = {r[FOLD] for r in train.groupBy(FOLD).count().collect()}
        for fold in range(folds):
            if not filled - {fold}:
                raise ValueError(f"The training data at fold {fold} is empty.")
            if fold not in filled:
                raise ValueError(f"The validation data at fold {fold} is empty.")

        def fitted(point: dict, fold: int | None) -> Model:
            if totals:
                return _fitted_on_totals(estimator, point, train, label, {k: v for k, v in totals.items() if k[0] != fold})
            return estimator.fit(train if fold is None else train.where(F.col(FOLD) != fold), dict(point))

        values = []
        for fold in range(folds):
            models = fit_all([lambda point=point, fold=fold: fitted(point, fold) for point in grid], parallelism)
            values.append(_values(models, train.where(F.col(FOLD) == fold), validator.getEvaluator(), parallelism))
        means, deviations = [[float(f(v)) for v in zip(*values, strict=True)] for f in (np.mean, np.std)]
        best = int((np.argmax if validator.getEvaluator().isLargerBetter() else np.argmin)(means))
        model = CrossValidatorModel(fitted(grid[best], None), means, None, deviations)
    finally:
        if keep:
            train.unpersist()
    return validator._copyValues(model)


def class_totals(rows: DataFrame, label: str, features: str) -> dict[tuple[int, float], tuple[int, np.ndarray]] | None:
    """Rows and feature sums of each (fold, class), from one pass; None if a row is not one that
    multinomial naive Bayes takes (it then says so itself)."""
    sums = Summarizer.metrics("sum", "min", "count").summary(F.col(features))
    found = rows.groupBy(F.col(FOLD), F.col(label).cast("double").alias("_class")).agg(F.count(F.lit(1)).alias("_n"), sums.alias("_s")).collect()
    for r in found:
        if r["_class"] is None or r["_s"] is None or r["_s"]["count"] != r["_n"]:
            return None
        if not np.isfinite(r["_s"]["sum"].toArray()).all() or (r["_s"]["min"].toArray() < 0).any():
            return None
    return {(r[FOLD], r["_class"]): (r["_n"], r["_s"]["sum"].toArray()) for r in found}


def _fits_on_totals(estimator: Estimator, grid: Sequence[dict]) -> bool:
    """Whether every point is multinomial naive Bayes without weights: it sees rows by their sums only."""
    return (type(estimator) is NaiveBayes and estimator.getModelType() == "multinomial"
            and not estimator.isDefined(estimator.weightCol) and all(p == estimator.smoothing for point in grid for p in point))


def _fitted_on_totals(estimator: NaiveBayes, point: dict, rows: DataFrame, label: str, totals: Mapping) -> Model:
    """The model that a fit on all rows of the totals gives: a class is one row with its feature sums and
    empty rows, by their number, for the others."""
    classes: dict[float, list] = {}
    for (_, c), (n, sums) in totals.items():
        have = classes.setdefault(c, [0, np.zeros(len(sums))])
        have[0], have[1] = have[0] + n, have[1] + sums
    table = [row for c, (n, sums) in sorted(classes.items())
             for row in ((c, sums.tolist(), 1.0), (c, [0.0] * len(sums), n - 1.0)) if row[2] > 0]
    frame = inline_table(rows.sparkSession, table, "c double, x array<double>, w double").select(
        F.col("c").alias(label, metadata=rows.schema[label].metadata), array_to_vector("x").alias(estimator.getFeaturesCol()),
        F.col("w").alias("_rows"))
    model = estimator.fit(frame, {**point, estimator.weightCol: "_rows"})
    model.clear(model.weightCol)
    return model


def _values(models: Sequence[Model], held_out: DataFrame, judge: MulticlassClassificationEvaluator, parallelism: int) -> list[float]:
    """The metric of each model on the rows held out; accuracy in one pass for all."""
    if judge.getMetricName() != "accuracy":
        return fit_all([lambda model=model: judge.evaluate(model.transform(held_out)) for model in models], parallelism)
    out, points = held_out, [f"_point{i}" for i in range(len(models))]
    for model, point in zip(models, points, strict=True):
        told = model.transform(out).withColumnRenamed(model.getPredictionCol(), point)
        out = told.drop(*[c for c in told.columns if c not in (*held_out.columns, *points)])
    label = F.col(judge.getLabelCol()).cast("double")
    return list(out.agg(*[F.avg((label == F.col(point).cast("double")).cast("double")).alias(point) for point in points]).first())


def best_point(model: CrossValidatorModel) -> int:
    """Position of the chosen grid point: the first with the best mean metric."""
    metrics = model.avgMetrics
    larger = model.getEvaluator().isLargerBetter()
    return metrics.index(max(metrics) if larger else min(metrics))


def cv_results(spark: SparkSession, model: CrossValidatorModel) -> DataFrame:
    """One row per grid point: its name, mean and deviation over folds, whether it is best."""
    best = best_point(model)
    rows = [(point_name(p), float(m), float(s), i == best) for i, (p, m, s) in enumerate(
        zip(model.getEstimatorParamMaps(), model.avgMetrics, model.stdMetrics))]
    return inline_table(spark, rows, schema_of(("point", "string"), ("metric", "double"),
                                               ("std", "double"), ("is_best", "boolean")))


def fit_predict(estimator: Estimator, train: DataFrame, test: DataFrame) -> DataFrame:
    """Fit without tuning and predict."""
    return estimator.fit(train).transform(test)


def cross_validated_score(estimator: Estimator, grid: Sequence[dict], train: DataFrame,
                          test: DataFrame, *, metric: str = "accuracy", folds: int = 3,
                          key: str | None = None, parallelism: int = 1,
                          label: str = "label") -> tuple[float, CrossValidatorModel]:
    """Tune on ``train``, score once on ``test``."""
    model = cross_validate(estimator, grid, train, metric=metric, folds=folds, key=key,
                           parallelism=parallelism, label=label)
    return evaluator(metric, label).evaluate(model.bestModel.transform(test)), model


def leaderboard(spark: SparkSession, scores: Mapping[str, float]) -> DataFrame:
    """Model and Score, best first, equal scores by name."""
    schema = schema_of(("Model", "string")).add("Score", DoubleType(), False)
    return (inline_table(spark, [(n, float(s)) for n, s in scores.items()], schema)
            .orderBy(F.desc("Score"), F.asc("Model")))
