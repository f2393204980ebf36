"""Stacking: a learner on top of the outputs of several different learners.

Wolpert (1992), "Stacked generalization".
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel, keyword_only
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.hashing import hash_word
from .common import (ROW_KEY, WEIGHT, EnsembleEstimator, EnsembleModel, class_count,
                     configured, fit_all, strip, takes_weights, training_frame)

META = "_meta"


class StackingParams(Params):
    baseLearners: Param = Param(Params._dummy(), "baseLearners", "list of classifiers")
    stacker: Param = Param(Params._dummy(), "stacker", "classifier over the base outputs")
    numFolds: Param[int] = Param(
        Params._dummy(), "numFolds", "folds for the stacker's training rows",
        TypeConverters.toInt)
    stackMethod: Param[str] = Param(
        Params._dummy(), "stackMethod", "base output to stack: class or probability",
        TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(numFolds=3, stackMethod="class")

    def getBaseLearners(self):
        return self.getOrDefault(self.baseLearners)

    def getStacker(self):
        return self.getOrDefault(self.stacker)

    def getNumFolds(self) -> int:
        return self.getOrDefault(self.numFolds)

    def getStackMethod(self) -> str:
        return self.getOrDefault(self.stackMethod)


def with_meta(df: DataFrame, models, method: str, features: str) -> DataFrame:
    """Base outputs of one set of fitted models, assembled into a vector."""
    for model in models:
        df = model.copy({model.getParam("featuresCol"): features}).transform(df)
    prefix = "_p" if method == "probability" else "_g"
    return VectorAssembler(inputCols=[f"{prefix}{b}" for b in range(len(models))],
                           outputCol=META).transform(df)


class StackingClassifier(StackingParams, EnsembleEstimator):
    """The stacker learns only from out-of-fold outputs: a row's base outputs come from
    models that did not see its fold. Folds are hash buckets of the row id; all fold fits
    and the final fits on all rows are independent and share one pool of threads.
    """

    nested = ("baseLearners", "stacker")

    @keyword_only
    def __init__(self, *, baseLearners=None, stacker=None, numFolds=None, stackMethod=None,
                 parallelism=None, seed=None, idCol=None, featuresCol=None, labelCol=None,
                 predictionCol=None, weightCol=None):
        super().__init__()
        self._with(**self._input_kwargs)

    def _base(self, b: int, weight: str | None):
        learner = self.getBaseLearners()[b]
        if self.getStackMethod() == "probability":
            if not learner.hasParam("probabilityCol"):
                raise ValueError(f"{type(learner).__name__} gives no probabilities")
            return configured(learner, self.getLabelCol(), self.getFeaturesCol(), f"_g{b}", weight,
                              probability=f"_p{b}")
        return configured(learner, self.getLabelCol(), self.getFeaturesCol(), f"_g{b}", weight)

    def _fit(self, dataset: DataFrame) -> StackingModel:
        label, features, folds = self.getLabelCol(), self.getFeaturesCol(), self.getNumFolds()
        bases, stacker = self.getBaseLearners(), self.getStacker()
        if folds < 2:
            raise ValueError("numFolds must be at least 2")
        if self.getStackMethod() not in ("class", "probability"):
            raise ValueError(f"unknown stackMethod {self.getStackMethod()}")
        weight = WEIGHT if self.weight_column() else None
        if weight and not all(takes_weights(x) for x in [*bases, stacker]):
            raise ValueError("a learner takes no weights")
        classes = class_count(dataset, label)
        with training_frame(dataset, self, words=True) as train:
            fold = hash_word(F.col(ROW_KEY), 0, self.getSeed()) % folds
            # Every fit reads the same kept rows; fold None is the final fit on all of them.
            plan = [(f, b) for f in [*range(folds), None] for b in range(len(bases))]

            def one(f: int | None, b: int):
                rows = train if f is None else train.where(fold != f)
                return self._base(b, weight).fit(rows)

            fitted = fit_all([lambda f=f, b=b: one(f, b) for f, b in plan], self.getParallelism())
            by_fold = {f: [m for (g, _), m in zip(plan, fitted) if g == f]
                       for f in [*range(folds), None]}
            parts = [with_meta(train.where(fold == f), by_fold[f], self.getStackMethod(), features)
                     .select(label, WEIGHT, META) for f in range(folds)]
            meta = reduce(DataFrame.unionByName, parts).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                top = configured(stacker, label, META, self.getPredictionCol(), weight).fit(meta)
            finally:
                meta.unpersist()
        return StackingModel(by_fold[None], top, classes)._take(self)


class StackingModel(StackingParams, EnsembleModel):
    """The stacker's prediction over the outputs of the base models."""

    def __init__(self, bases, top, classes: int):
        super().__init__()
        self.bases, self.top, self.numClasses = bases, top, classes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = with_meta(dataset, self.bases, self.getStackMethod(), self.getFeaturesCol())
        out = self.top.copy({self.top.getParam("predictionCol"): self.getPredictionCol()}
                            ).transform(out)
        return strip(out, [*dataset.columns, self.getPredictionCol()])
