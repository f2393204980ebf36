"""Boosting: a classifier refitted on rows reweighted towards its mistakes.

Freund and Schapire (1997); the multi-class form is SAMME of Zhu, Zou, Rosset and Hastie
(2009), "Multi-class AdaBoost".
"""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.scores import argmax_index, vote_scores
from .common import (WEIGHT, EnsembleEstimator, EnsembleModel, RoundState, ScoreParams,
                     class_count, configured, strip, takes_weights, training_frame)

SMALLEST_ERROR = 1e-10


class BoostingParams(ScoreParams):
    baseLearner: Param = Param(Params._dummy(), "baseLearner", "classifier that takes weights")
    learningRate: Param[float] = Param(
        Params._dummy(), "learningRate", "factor on every member's say", TypeConverters.toFloat)
    checkpointInterval: Param[int] = Param(
        Params._dummy(), "checkpointInterval",
        "rounds after which the reweighted rows are written; 0 never", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(learningRate=1.0, checkpointInterval=1)

    def getBaseLearner(self):
        return self.getOrDefault(self.baseLearner)

    def getLearningRate(self) -> float:
        return self.getOrDefault(self.learningRate)


def member_say(error: float, classes: int, learning_rate: float) -> float:
    """Weight of a member's vote from its weighted error."""
    error = min(max(error, SMALLEST_ERROR), 1.0 - SMALLEST_ERROR)
    return learning_rate * (math.log((1.0 - error) / error) + math.log(classes - 1.0))


def missed(label: str, prediction: str) -> Column:
    return F.col(label) != F.col(prediction)


def weighted_error(df: DataFrame, label: str, prediction: str, weight: str) -> DataFrame:
    """One row: total weight and the share of it on mispredicted rows."""
    miss = F.when(missed(label, prediction), F.col(weight)).otherwise(F.lit(0.0))
    return df.agg(F.sum(weight).alias("total"), (F.sum(miss) / F.sum(weight)).alias("error"))


def reweighted(label: str, prediction: str, weight: str, say: float, scale: float) -> Column:
    """New weight: mispredicted rows times exp(say), all times ``scale``."""
    return (F.when(missed(label, prediction), F.col(weight) * math.exp(say))
             .otherwise(F.col(weight)) * scale)


class BoostingClassifier(BoostingParams, EnsembleEstimator):
    """Adaptive boosting of any classifier with a weight column.

    The weights of a round follow from the members so far, so they can stay an expression
    over the training rows: a round adds a projection and one aggregate.
    """

    nested = ("baseLearner",)

    @keyword_only
    def __init__(self, *, baseLearner=None, maxIter=None, learningRate=None,
                 checkpointInterval=None, seed=None, featuresCol=None, labelCol=None,
                 predictionCol=None, weightCol=None, rawPredictionCol=None, probabilityCol=None):
        super().__init__()
        self._with(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> BoostingModel:
        base, label, features = self.getBaseLearner(), self.getLabelCol(), self.getFeaturesCol()
        if not takes_weights(base):
            raise ValueError(f"{type(base).__name__} takes no weights")
        classes = class_count(dataset, label)
        members, says, errors = [], [], []
        with training_frame(dataset, self, words=False) as train:
            rounds = RoundState(dataset, self.getOrDefault(self.checkpointInterval))
            state = train
            try:
                for m in range(self.getMaxIter()):
                    learner = configured(base, label, features, "_guess", WEIGHT, seed_shift=m)
                    model = learner.fit(state)
                    scored = model.transform(state)
                    row = weighted_error(scored, label, "_guess", WEIGHT).first()
                    error, total = row["error"], row["total"]
                    if error is None:
                        raise ValueError("no training rows with positive weight")
                    no_better = error >= 1.0 - 1.0 / classes
                    if no_better and members:
                        break
                    say = member_say(error, classes, self.getLearningRate())
                    # A first member no better than guessing is all there is: let it speak.
                    members.append(model)
                    says.append(1.0 if no_better else say)
                    errors.append(error)
                    if no_better or error <= 0.0 or m + 1 == self.getMaxIter():
                        break
                    grown = total * (1.0 - error) + total * error * math.exp(say)
                    update = reweighted(label, "_guess", WEIGHT, say, total / grown)
                    state = scored.select(features, label, update.alias(WEIGHT))
                    state = rounds.carry(state, m + 1)
            finally:
                rounds.close()
        return BoostingModel(members, says, errors, classes)._take(self)


class BoostingModel(BoostingParams, EnsembleModel):
    """Weighted vote: the class with the largest total say, the lowest on a tie."""

    def __init__(self, members, says, errors, classes: int):
        super().__init__()
        self.members, self.says, self.errors, self.numClasses = members, says, errors, classes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for m, member in enumerate(self.members):
            out = member.copy({member.getParam("featuresCol"): self.getFeaturesCol(),
                               member.getParam("predictionCol"): f"_vote{m}"}).transform(out)
        votes = [F.col(f"_vote{m}") for m in range(len(self.members))]
        out = out.withColumn("_votes", vote_scores(votes, self.numClasses, self.says))
        added = {self.getPredictionCol(): argmax_index(F.col("_votes"))}
        if self.getRawPredictionCol():
            added[self.getRawPredictionCol()] = array_to_vector("_votes")
        if self.getProbabilityCol():
            total = sum(self.says)
            share = F.transform("_votes", lambda v: v / F.lit(float(total)))
            added[self.getProbabilityCol()] = array_to_vector(share)
        return strip(out.withColumns(added), [*dataset.columns, *added])
