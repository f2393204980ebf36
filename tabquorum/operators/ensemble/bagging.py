"""Bagging: members fitted on row samples and feature subspaces, most votes win.

Breiman (1996), "Bagging predictors"; Louppe and Geurts (2012), "Ensembles on random
patches" for sampling rows and features together.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Mapping, Sequence
from threading import Lock

from pyspark import keyword_only
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.hashing import member_seed, member_uniform, poisson_count, poisson_steps
from ...functions.scores import argmax_index, vote_counts
from .common import (ROW_KEY, WEIGHT, EnsembleEstimator, EnsembleModel,
                     ScoreParams, class_count, configured, feature_count, fit_all, strip,
                     takes_weights, training_frame)
from . import grown


# Parameters a decision tree and a forest share.
TREE_SETTINGS = ("maxDepth", "maxBins", "minInstancesPerNode", "minWeightFractionPerNode",
                 "minInfoGain", "maxMemoryInMB", "cacheNodeIds", "checkpointInterval", "impurity")
# Values (features and what a row carries besides) that the rows of one task may have: 128 MB.
TASK_VALUES = 1 << 24
# Rows of all trees that are grown by one job, as a tree may have a node or two for each of its rows.
TREE_ROWS = 1 << 19


class BaggingParams(ScoreParams):
    baseLearner: Param = Param(Params._dummy(), "baseLearner", "classifier fitted as a member")
    sampleRatio: Param[float] = Param(
        Params._dummy(), "sampleRatio", "expected share of rows a member sees",
        TypeConverters.toFloat)
    replacement: Param[bool] = Param(
        Params._dummy(), "replacement", "draw rows with replacement", TypeConverters.toBoolean)
    sampleRatioFeatures: Param[float] = Param(
        Params._dummy(), "sampleRatioFeatures", "share of features a member sees",
        TypeConverters.toFloat)
    replacementFeatures: Param[bool] = Param(
        Params._dummy(), "replacementFeatures",
        "draw features with replacement; repeated draws count once", TypeConverters.toBoolean)
    grownTogether: Param[bool] = Param(
        Params._dummy(), "grownTogether",
        "grow decision trees over all features in one fit of Spark's forest, which draws its own "
        "row samples (by partition, not by row id)", TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(sampleRatio=1.0, replacement=True, sampleRatioFeatures=1.0,
                         replacementFeatures=False, grownTogether=False)

    def getBaseLearner(self):
        return self.getOrDefault(self.baseLearner)

    def getSampleRatio(self) -> float:
        return self.getOrDefault(self.sampleRatio)

    def getReplacement(self) -> bool:
        return self.getOrDefault(self.replacement)

    def getSampleRatioFeatures(self) -> float:
        return self.getOrDefault(self.sampleRatioFeatures)

    def getReplacementFeatures(self) -> bool:
        return self.getOrDefault(self.replacementFeatures)


class BaggingClassifier(BaggingParams, EnsembleEstimator):
    """Bagging of any classifier.

    Row samples are decided row by row from a hash of the row's id, the seed and the
    member's number, so they need no shuffle and come out the same when a task is run
    again. With replacement a row gets a Poisson(sampleRatio) count, passed as its weight,
    or as repeated rows for learners without weights.

    With ``grownTogether`` decision trees over all features are grown in the passes one tree
    would need, by Spark's forest with every feature considered at every split. It draws the
    same kind of row samples itself, from partitions instead of row ids.
    """

    nested = ("baseLearner",)

    @keyword_only
    def __init__(self, *, baseLearner=None, maxIter=None, sampleRatio=None, replacement=None,
                 sampleRatioFeatures=None, replacementFeatures=None, parallelism=None, seed=None,
                 idCol=None, featuresCol=None, labelCol=None, predictionCol=None, weightCol=None,
                 rawPredictionCol=None, probabilityCol=None, grownTogether=None):
        super().__init__()
        self._with(**self._input_kwargs)

    def _subspace(self, member: int, features: int) -> list[int]:
        """Feature positions of a member, ascending."""
        size = max(1, round(self.getSampleRatioFeatures() * features))
        draw = random.Random(self.getSeed() * 1_000_003 + member)
        if self.getReplacementFeatures():
            return sorted({draw.randrange(features) for _ in range(size)})
        return sorted(draw.sample(range(features), min(size, features)))

    def _sampled(self, train: DataFrame, member: int, weighted: bool) -> DataFrame:
        """The member's rows; repeats are in the weight if ``weighted``, else real rows."""
        ratio = self.getSampleRatio()
        if not self.getReplacement():
            if ratio >= 1.0:
                return train
            uniform = member_uniform(F.col(ROW_KEY), self.getSeed(), member)
            return train.where(uniform < ratio)
        uniform = member_uniform(F.col(ROW_KEY), self.getSeed(), member)
        # The filter is the first step of the count, so pushing it down costs one hash.
        drawn = (train.where(uniform >= poisson_steps(ratio)[0])
                      .withColumn("_count", poisson_count(uniform, ratio)))
        if weighted:
            return drawn.withColumn(WEIGHT, F.col(WEIGHT) * F.col("_count"))
        return drawn.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_count"))))

    def _grown_together(self, dataset: DataFrame) -> list:
        """Members from one forest fit."""
        base = self.getBaseLearner()
        sampling = self.getReplacement() or self.getSampleRatio() < 1.0
        whole = self.getSampleRatioFeatures() >= 1.0 and not self.getReplacementFeatures()
        if not (type(base) is DecisionTreeClassifier and sampling and whole
                and self.getSampleRatio() <= 1.0):
            raise ValueError("grownTogether takes decision trees, row samples up to 1.0 and all features")
        forest = RandomForestClassifier(
            numTrees=self.getMaxIter(), featureSubsetStrategy="all", seed=self.getSeed(),
            bootstrap=self.getReplacement(), subsamplingRate=self.getSampleRatio(),
            labelCol=self.getLabelCol(), featuresCol=self.getFeaturesCol())
        forest._set(**{name: base.getOrDefault(name) for name in TREE_SETTINGS})
        if self.weight_column():
            forest.setWeightCol(self.weight_column())
        return [tree.setPredictionCol(f"_vote{m}").setRawPredictionCol("").setProbabilityCol("")
                for m, tree in enumerate(forest.fit(dataset).trees)]

    def _in_one_task(self, dataset: DataFrame) -> bool:
        """Whether ``grow_all`` grows the members that ``fit`` gives."""
        base = self.getBaseLearner()
        kinds = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
        label = dataset.schema[self.getLabelCol()].metadata.get("ml_attr", {})
        return (grown.pa is not None and type(base) is DecisionTreeClassifier and base.getImpurity() == "gini" and not base.isDefined(base.weightCol)
                and not self.weight_column() and not self.getOrDefault(self.grownTogether)
                and set(kinds) <= {"numeric"} and (not label or label.get("type") == "nominal"))

    def _fit_together(self, points: Sequence[BaggingClassifier], dataset: DataFrame) -> list[BaggingModel]:
        """The models of bags that read the same columns, their members grown by one job."""
        label, features = self.getLabelCol(), self.getFeaturesCol()
        classes, width = class_count(dataset, label), feature_count(dataset, features)
        named = dataset.schema[label].metadata.get("ml_attr", {})
        told = len(named["vals"]) if "vals" in named else named.get("num_vals")
        trees, spaces = [], []
        for point in points:
            spaces.append([point._subspace(m, width) for m in range(point.getMaxIter())])
            base, sources = point.getBaseLearner(), _sources(spaces[-1], width, features)
            for m, (space, source) in enumerate(zip(spaces[-1], sources, strict=True)):
                values = {base.labelCol: label, base.featuresCol: source, base.predictionCol: f"_vote{m}", base.rawPredictionCol: "",
                          base.probabilityCol: "", base.seed: base.getSeed() + m}
                if point.getReplacement():
                    values[base.weightCol] = WEIGHT
                plan = grown.plan_of(base, point.getSampleRatio(), point.getReplacement(), space, told)
                trees.append((base, values, member_seed(point.getSeed(), m), plan))
        with training_frame(dataset, self, words=True, merged=True) as train:
            members = iter(grown.grow_all(train, features, label, ROW_KEY, trees))
        return [BaggingModel([next(members) for _ in space], space, width, classes)._take(point)
                for point, space in zip(points, spaces, strict=True)]

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[Mapping]) -> Iterator[tuple[int, BaggingModel]]:
        """The model of each map, as ``fit`` gives it; may be read from several threads.

        Bags of decision trees whose training rows fit into one task are grown some together, by one task
        (``grown``): as many as have TREE_ROWS rows in all their trees.
        """
        points = [self.copy(dict(values)) for values in paramMaps]
        same = {(p.getLabelCol(), p.getFeaturesCol(), p.getIdCol()) for p in points}
        if len(same) != 1 or not all(p._in_one_task(dataset) for p in points):
            return super().fitMultiple(dataset, paramMaps)
        rows = dataset.count()
        draws = len({(p.getSeed(), m) for p in points for m in range(p.getMaxIter())})
        if not rows or rows * (feature_count(dataset, points[0].getFeaturesCol()) + draws + 4) > TASK_VALUES:
            return super().fitMultiple(dataset, paramMaps)
        return _Together(points, dataset, rows)

    def _fit(self, dataset: DataFrame) -> BaggingModel:
        base, label, features = self.getBaseLearner(), self.getLabelCol(), self.getFeaturesCol()
        classes = class_count(dataset, label)
        weighted = takes_weights(base)
        if self.weight_column() and not weighted:
            raise ValueError(f"{type(base).__name__} takes no weights")
        width = feature_count(dataset, features)
        if self.getOrDefault(self.grownTogether):
            together = self._grown_together(dataset)
            spaces = [list(range(width))] * len(together)
            return BaggingModel(together, spaces, width, classes)._take(self)
        spaces = [self._subspace(m, width) for m in range(self.getMaxIter())]
        sampling = self.getReplacement() or self.getSampleRatio() < 1.0

        with training_frame(dataset, self, words=sampling, merged=type(base) is DecisionTreeClassifier) as train:
            def member(m: int):
                whole = len(spaces[m]) == width
                rows = self._sampled(train, m, weighted)
                if not whole:
                    rows = VectorSlicer(inputCol=features, outputCol="_subspace",
                                        indices=spaces[m]).transform(rows)
                use_weight = weighted and (self.getReplacement() or self.weight_column())
                learner = configured(base, label, features if whole else "_subspace", f"_vote{m}",
                                     WEIGHT if use_weight else None, seed_shift=m)
                return learner.fit(rows)

            members = fit_all([lambda m=m: member(m) for m in range(self.getMaxIter())],
                              self.getParallelism())
        return BaggingModel(members, spaces, width, classes)._take(self)


def _sources(spaces: Sequence[Sequence[int]], width: int, features: str) -> list[str]:
    """The column each member reads: all features, or a slice named after the first member with its space."""
    first: dict[tuple, str] = {}
    return [features if len(space) == width else first.setdefault(tuple(space), f"_subspace{m}") for m, space in enumerate(spaces)]


class _Together:
    """(position, model) of each bag; the bags of a group are fitted when the first of them is asked for."""

    def __init__(self, points: Sequence[BaggingClassifier], dataset: DataFrame, rows: int):
        self.dataset, self.ready, self.lock = dataset, [], Lock()
        groups: list[list] = []
        for item in enumerate(points):
            if not groups or sum(p.getMaxIter() for _, p in [*groups[-1], item]) * rows > TREE_ROWS:
                groups.append([])
            groups[-1].append(item)
        self.waiting = iter(groups)

    def __iter__(self) -> _Together:
        return self

    def __next__(self) -> tuple[int, BaggingModel]:
        with self.lock:
            if not self.ready:
                group = next(self.waiting)
                models = group[0][1]._fit_together([p for _, p in group], self.dataset)
                self.ready = [(i, model) for (i, _), model in zip(group, models, strict=True)]
            return self.ready.pop(0)


class BaggingModel(BaggingParams, EnsembleModel):
    """Votes of the members: counts, shares and the class with most (lowest on a tie)."""

    def __init__(self, members, subspaces, width: int, classes: int):
        super().__init__()
        self.members, self.subspaces = members, subspaces
        self.numFeatures, self.numClasses = width, classes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        sources = _sources(self.subspaces, self.numFeatures, self.getFeaturesCol())
        for m, (member, space, source) in enumerate(zip(self.members, self.subspaces, sources, strict=True)):
            if source == f"_subspace{m}" and len(space) < self.numFeatures:
                out = VectorSlicer(inputCol=self.getFeaturesCol(), outputCol=source, indices=space).transform(out)
            if member.getOrDefault("featuresCol") != source:
                member = member.copy({member.getParam("featuresCol"): source})
            out = member.transform(out)
        out = out.withColumn("_votes", vote_counts([f"_vote{m}" for m in range(len(self.members))], self.numClasses))
        added = {self.getPredictionCol(): argmax_index(F.col("_votes"))}
        if self.getRawPredictionCol():
            added[self.getRawPredictionCol()] = array_to_vector("_votes")
        if self.getProbabilityCol():
            share = F.transform("_votes", lambda v: v / float(len(self.members)))
            added[self.getProbabilityCol()] = array_to_vector(share)
        return strip(out.withColumns(added), [*dataset.columns, *added])
