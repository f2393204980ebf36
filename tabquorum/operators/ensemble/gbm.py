"""Gradient boosting over a base regressor, for any number of classes.

Friedman (2001), "Greedy function approximation: a gradient boosting machine", the K-class
logistic case.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel, keyword_only
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.scores import argmax_index, softmax
from ...sources.spread import task_count
from .common import (WEIGHT, EnsembleEstimator, EnsembleModel, RoundState, ScoreParams,
                     class_count, configured, fit_all, strip, takes_weights, training_frame)

SMALLEST_SHARE = 1e-12
LARGEST_STEP, STEP_POINTS, STEP_PASSES = 100.0, 10, 9    # the last bracket is 1e-7 wide


class GradientBoostingParams(ScoreParams):
    baseLearner: Param = Param(Params._dummy(), "baseLearner", "regressor fitted on residuals")
    learningRate: Param[float] = Param(
        Params._dummy(), "learningRate", "factor on every step", TypeConverters.toFloat)
    optimizedWeights: Param[bool] = Param(
        Params._dummy(), "optimizedWeights",
        "weight each step by a search for the smallest loss instead of (K-1)/K", TypeConverters.toBoolean)
    checkpointInterval: Param[int] = Param(
        Params._dummy(), "checkpointInterval",
        "rounds after which the scores are written; 0 never", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(learningRate=0.1, optimizedWeights=False, checkpointInterval=1)

    def getBaseLearner(self):
        return self.getOrDefault(self.baseLearner)

    def getLearningRate(self) -> float:
        return self.getOrDefault(self.learningRate)


def class_shares(df: DataFrame, label: str, weight: str, classes: int) -> DataFrame:
    """One row with the weighted share of each class as ``share0``, ``share1``, ..."""
    total = F.sum(weight)
    return df.agg(*[
        (F.sum(F.when(F.col(label) == float(k), F.col(weight)).otherwise(F.lit(0.0))) / total)
        .alias(f"share{k}") for k in range(classes)])


def residuals(label: str, scores: list[Column]) -> list[Column]:
    """Per class: 1 for the row's own class, else 0, minus the class's probability."""
    return [F.when(F.col(label) == float(k), F.lit(1.0)).otherwise(F.lit(0.0)) - p
            for k, p in enumerate(softmax(scores))]


def step_slopes(df: DataFrame, label: str, weight: str, scores: Sequence[str], steps: Sequence[str],
                tried: Sequence[Sequence[float]]) -> list[list[float]]:
    """Slope of the log loss in the step of each class at each step tried, from one aggregate.

    Class k's score moves by the step times the column ``steps[k]``, the others stay. The loss is convex
    in the step, so its slope never falls.
    """
    top = F.greatest(*scores)
    rows = df.withColumn("_all", sum((F.exp(F.col(s) - top) for s in scores), F.lit(0.0))).withColumn("_top", top)
    sums = []
    for k, (s, h) in enumerate(zip(scores, steps, strict=True)):
        own = F.when(F.col(label) == float(k), 1.0).otherwise(0.0)
        others = F.col("_all") - F.exp(F.col(s) - F.col("_top"))
        for i, step in enumerate(tried[k]):
            share = 1.0 / (1.0 + others * F.exp(-(F.col(s) + float(step) * F.col(h) - F.col("_top"))))
            sums.append(F.sum(F.col(weight) * (share - own) * F.col(h)).alias(f"s{k}_{i}"))
    row = rows.agg(*sums).first()
    return [[row[f"s{k}_{i}"] for i in range(len(tried[k]))] for k in range(len(scores))]


def score_cells(df: DataFrame, label: str, weight: str, scores: Sequence[str], steps: Sequence[str]) -> DataFrame:
    """``df`` with one row, of the summed weight, for all rows alike in label, scores and steps.

    Trees give as many different scores and steps as they have leaves; learners that give each row its
    own leave the rows as many as they were.
    """
    return df.groupBy(label, *scores, *steps).agg(F.sum(weight).alias(weight))


def searched_steps(df: DataFrame, label: str, weight: str, scores: Sequence[str], steps: Sequence[str]) -> list[float]:
    """The step of each class with the smallest loss in [0, LARGEST_STEP], all classes in the same passes.

    A pass tries points across every class's bracket and keeps the part in which the slope changes
    sign: STEP_PASSES aggregates in all, over the kept ``score_cells`` of one pass over the rows. A loss
    that rises from the start gives 0, one that still falls at the end LARGEST_STEP.
    """
    brackets = [(0.0, LARGEST_STEP)] * len(scores)
    kept = score_cells(df, label, weight, scores, steps).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cells = kept.coalesce(task_count(kept.count()))
        for _ in range(STEP_PASSES):
            tried = [[low + (high - low) * i / STEP_POINTS for i in range(STEP_POINTS + 1)] for low, high in brackets]
            slopes = step_slopes(cells, label, weight, scores, steps, tried)
            for k, (points, slope) in enumerate(zip(tried, slopes, strict=True)):
                at = next((i for i, x in enumerate(slope) if x >= 0.0), None)
                brackets[k] = ((points[-1], points[-1]) if at is None else (points[0], points[0]) if at == 0
                               else (points[at - 1], points[at]))
    finally:
        kept.unpersist()
    return [(low + high) / 2 for low, high in brackets]


class GradientBoostingClassifier(GradientBoostingParams, EnsembleEstimator):
    """K regressors per round, one per class, each fitted on that class's residuals.

    The regressors of a round are independent and fitted from ``parallelism`` threads;
    rounds follow one another.
    """

    nested = ("baseLearner",)

    @keyword_only
    def __init__(self, *, baseLearner=None, maxIter=None, learningRate=None,
                 optimizedWeights=None, checkpointInterval=None, parallelism=None, seed=None,
                 featuresCol=None, labelCol=None, predictionCol=None, weightCol=None,
                 rawPredictionCol=None, probabilityCol=None):
        super().__init__()
        self._with(**self._input_kwargs)

    def _step_weights(self, stepped: DataFrame, label: str, classes: int) -> list[float]:
        if not self.getOrDefault(self.optimizedWeights):
            return [(classes - 1.0) / classes] * classes
        return searched_steps(stepped, label, WEIGHT, [f"_f{k}" for k in range(classes)], [f"_h{k}" for k in range(classes)])

    def _fit(self, dataset: DataFrame) -> GradientBoostingModel:
        base, label, features = self.getBaseLearner(), self.getLabelCol(), self.getFeaturesCol()
        if self.weight_column() and not takes_weights(base):
            raise ValueError(f"{type(base).__name__} takes no weights")
        classes, rate = class_count(dataset, label), self.getLearningRate()
        rounds, weights = [], []
        with training_frame(dataset, self, words=False) as train:
            carried = RoundState(dataset, self.getOrDefault(self.checkpointInterval))
            try:
                shares = class_shares(train, label, WEIGHT, classes).first()
                if shares[0] is None:
                    raise ValueError("no training rows with positive weight")
                start = [math.log(max(s, SMALLEST_SHARE)) for s in shares]
                state = train.select(features, label, WEIGHT,
                                     *[F.lit(f).alias(f"_f{k}") for k, f in enumerate(start)])
                for m in range(self.getMaxIter()):
                    scores = [F.col(f"_f{k}") for k in range(classes)]
                    targets = {f"_r{k}": r for k, r in enumerate(residuals(label, scores))}
                    with_targets = state.withColumns(targets)

                    def member(k: int, rows=with_targets, m=m):
                        weight = WEIGHT if self.weight_column() else None
                        learner = configured(base, f"_r{k}", features, f"_h{k}", weight,
                                             seed_shift=m * classes + k)
                        return learner.fit(rows)

                    models = fit_all([lambda k=k: member(k) for k in range(classes)],
                                     self.getParallelism())
                    stepped = with_targets
                    for model in models:
                        stepped = model.transform(stepped)
                    weights.append(self._step_weights(stepped, label, classes))
                    rounds.append(models)
                    if m + 1 == self.getMaxIter():
                        break
                    state = stepped.select(
                        features, label, WEIGHT,
                        *[(F.col(f"_f{k}") + rate * weights[-1][k] * F.col(f"_h{k}"))
                          .alias(f"_f{k}") for k in range(classes)])
                    state = carried.carry(state, m + 1)
            finally:
                carried.close()
        return GradientBoostingModel(start, rounds, weights)._take(self)


class GradientBoostingModel(GradientBoostingParams, EnsembleModel):
    """Softmax over start scores plus weighted steps; ``weights[round][class]``."""

    def __init__(self, start, rounds, weights):
        super().__init__()
        self.start, self.rounds, self.weights = start, rounds, weights
        self.numClasses = len(start)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, rate = dataset, self.getLearningRate()
        scores = [F.lit(float(f)) for f in self.start]
        for m, models in enumerate(self.rounds):
            for k, model in enumerate(models):
                name = f"_h{m}_{k}"
                out = model.copy({model.getParam("featuresCol"): self.getFeaturesCol(),
                                  model.getParam("predictionCol"): name}).transform(out)
                scores[k] = scores[k] + rate * self.weights[m][k] * F.col(name)
        names = [f"_f{k}" for k in range(self.numClasses)]
        out = out.withColumns(dict(zip(names, scores)))
        raw = F.array(*names)
        added = {self.getPredictionCol(): argmax_index(raw)}
        if self.getRawPredictionCol():
            added[self.getRawPredictionCol()] = array_to_vector(raw)
        if self.getProbabilityCol():
            shares = F.array(*softmax([F.col(n) for n in names]))
            added[self.getProbabilityCol()] = array_to_vector(shares)
        return strip(out.withColumns(added), [*dataset.columns, *added])
