"""A comparison of learners that can be cut off and resumed.

Training rows are written once, by fold, so a fit reads only the folders of its folds. Every fit
leaves its scores as one small table below the comparison's folder; a run that starts again
reads what is there and fits the rest. Grid points that differ only in the number of boosting
rounds share one fit at the largest number: the others are its prefixes, scored in the same pass.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from threading import Lock

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.param import Param
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ensemble import (BaggingClassifier, BoostingClassifier, BoostingModel, GradientBoostingClassifier, GradientBoostingModel)
from ..operators.ensemble.common import fit_all
from ..operators.splitting import with_fold
from ..sources.inline import inline_table
from ..sources.shared import exists
from .tuning import FOLD, leaderboard, point_name

STAGED = (GBTClassifier, GBTRegressor, BoostingClassifier, GradientBoostingClassifier)
RESULTS = "entrant string, position int, point string, fold int, value double"
SCORES = "entrant string, position int, point string, value double"


def prefix(model: Model, rounds: int) -> Model:
    """The model that a fit with ``rounds`` rounds would have given: its first rounds.

    A model that stopped earlier is its own prefix.
    """
    if isinstance(model, GradientBoostingModel):
        out = GradientBoostingModel(model.start, model.rounds[:rounds], model.weights[:rounds])._take(model)
    elif isinstance(model, BoostingModel):
        out = BoostingModel(model.members[:rounds], model.says[:rounds], model.errors[:rounds], model.numClasses)._take(model)
    elif isinstance(model, (GBTClassificationModel, GBTRegressionModel)):
        gateway, weights = SparkSession.active().sparkContext._gateway, model.treeWeights[:rounds]
        trees = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(weights))
        shares = gateway.new_array(gateway.jvm.double, len(weights))
        for i, weight in enumerate(weights):
            trees[i], shares[i] = model._java_obj.trees()[i], float(weight)
        kinds = (gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel if isinstance(model, GBTClassificationModel)
                 else gateway.jvm.org.apache.spark.ml.regression.GBTRegressionModel)
        out = model._copyValues(type(model)(kinds(model.uid, trees, shares)))
    else:
        raise TypeError(f"{type(model).__name__} has no rounds")
    if out.hasParam("maxIter"):
        out._set(maxIter=rounds)
    return out


def fit_groups(estimator: Estimator, grid: Sequence[Mapping[Param, object]]) -> list[list[int]]:
    """Positions of the grid that one fit serves: those that differ in the number of rounds only."""
    if not isinstance(estimator, STAGED):
        return [[i] for i in range(len(grid))]
    groups: dict[tuple, list[int]] = {}
    for i, point in enumerate(grid):
        rest = tuple(sorted((p.parent, p.name, str(v)) for p, v in point.items() if p != estimator.maxIter))
        groups.setdefault(rest, []).append(i)
    return list(groups.values())


def passes(estimator: Estimator, point: Mapping[Param, object]) -> int:
    """Roughly how many passes over the rows follow one another in a fit: rounds times levels."""
    values = estimator.extractParamMap(dict(point))
    named = {p.name: v for p, v in values.items() if p.parent == estimator.uid and p.name in ("maxIter", "maxDepth")}
    return max(1, int(named.get("maxIter", 1))) * max(1, int(named.get("maxDepth", 1)))


def fitted_points(estimator: Estimator, grid: Sequence[Mapping[Param, object]], group: Sequence[int],
                  train: DataFrame) -> dict[int, Model]:
    """The fitted model of each point of a group, by one fit."""
    if len(group) == 1:
        return {group[0]: estimator.fit(train, dict(grid[group[0]]))}
    rounds = {i: int(grid[i].get(estimator.maxIter, estimator.getMaxIter())) for i in group}
    most = max(group, key=lambda i: rounds[i])
    model = estimator.fit(train, dict(grid[most]))
    return {i: model if i == most else prefix(model, rounds[i]) for i in group}


def fitted_groups(estimator: Estimator, grid: Sequence[Mapping[Param, object]], groups: Sequence[Sequence[int]],
                  train: DataFrame) -> Iterator[tuple[Sequence[int], dict[int, Model]]]:
    """Each group with the fitted models of its points, one after another; bags may share the work of their fits.
    May be read from several threads."""
    if isinstance(estimator, BaggingClassifier):
        fitted = estimator.fitMultiple(train, [dict(grid[i]) for i, in groups])
        return map(lambda told: (groups[told[0]], {groups[told[0]][0]: told[1]}), fitted)
    return map(lambda group: (group, fitted_points(estimator, grid, group, train)), groups)


def predictions_of(models: Mapping[int, Model], rows: DataFrame, label: str) -> DataFrame:
    """(label, point, prediction) of all models, in one pass over the rows."""
    out = rows
    for i, model in models.items():
        out = model.copy({model.getParam("predictionCol"): f"_point{i}"}).transform(out).drop("rawPrediction", "probability")
    pairs = F.array(*[F.struct(F.lit(i).alias("point"), F.col(f"_point{i}").alias("prediction")) for i in models])
    return out.select(F.col(label).alias("label"), F.explode(pairs).alias("p")).select("label", "p.point", "p.prediction")


def score_of(cells: Sequence[tuple[float, float, int]], metric: str) -> float:
    """Accuracy or class-weighted F1 from confusion counts (label, prediction, n)."""
    total = sum(n for *_, n in cells)
    if metric == "accuracy":
        return sum(n for a, b, n in cells if a == b) / total
    if metric != "f1":
        raise ValueError(f"unknown metric {metric}")
    out = 0.0
    for c in {a for a, _, _ in cells}:
        labelled, told = sum(n for a, _, n in cells if a == c), sum(n for _, b, n in cells if b == c)
        out += labelled * 2.0 * sum(n for a, b, n in cells if a == b == c) / (labelled + told)
    return out / total


def scores(models: Mapping[int, Model], rows: DataFrame, label: str, metric: str) -> dict[int, float]:
    """The metric of each model from one table of counts."""
    found = predictions_of(models, rows, label).groupBy("point", "label", "prediction").count().collect()
    return {i: score_of([(r.label, r.prediction, r["count"]) for r in found if r.point == i], metric) for i in models}


@dataclass
class Comparison:
    """Entrants, (estimator, grid) by name, on one task, with their results below ``folder``.

    ``key`` names the row's key, whose hash gives the fold. The same entrants and rows must be given
    when a comparison is resumed in its folder; ``fits`` counts the fits of this run.
    """
    folder: str
    entrants: Mapping[str, tuple[Estimator, Sequence[Mapping[Param, object]]]]
    key: str
    folds: int = 3
    metric: str = "accuracy"
    label: str = "label"
    parallelism: int = 1
    after_fit: Callable[[int], None] | None = None
    fits: int = field(default=0, init=False)

    def _write_features(self, train: DataFrame, test: DataFrame) -> None:
        spark = train.sparkSession
        if not exists(spark, f"{self.folder}/train/_SUCCESS"):
            with_fold(train, F.col(self.key), self.folds, FOLD).write.mode("overwrite").partitionBy(FOLD).parquet(f"{self.folder}/train")
        if not exists(spark, f"{self.folder}/test/_SUCCESS"):
            test.write.mode("overwrite").parquet(f"{self.folder}/test")

    def _rows(self, train: DataFrame, fold: Column | None = None) -> DataFrame:
        """Training rows as written; a condition on the fold skips whole folders."""
        schema = T.StructType([*train.schema.fields, T.StructField(FOLD, T.IntegerType())])
        rows = train.sparkSession.read.schema(schema).parquet(f"{self.folder}/train")
        return (rows if fold is None else rows.where(fold)).drop(FOLD)

    def _done(self, spark: SparkSession, path: str) -> bool:
        return exists(spark, f"{path}/_SUCCESS")

    def _counted(self) -> None:
        self.fits += 1
        if self.after_fit:
            self.after_fit(self.fits)

    def _path(self, kind: str, name: str, *parts) -> str:
        tag = hashlib.sha256(name.encode()).hexdigest()[:12]
        return f"{self.folder}/{kind}/{tag}/" + "-".join(map(str, parts or ("all",)))

    def _steps(self, estimator: Estimator, grid: Sequence[Mapping[Param, object]]) -> list[list[list[int]]]:
        """The groups of a fold by steps: one to a step, but all of a grid of bags, which share the work of their fits."""
        groups = fit_groups(estimator, grid)
        return [groups] if isinstance(estimator, BaggingClassifier) else [[g] for g in groups]

    def run(self, train: DataFrame, test: DataFrame) -> DataFrame:
        """All fits that are not done yet; returns the leaderboard (Model, Score)."""
        spark = train.sparkSession
        self._write_features(train, test)
        held_out = spark.read.schema(test.schema).parquet(f"{self.folder}/test")

        def some(name: str, groups: list[list[int]], fold: int) -> None:
            estimator, grid = self.entrants[name]
            paths = {g[0]: self._path("results", name, g[0], fold) for g in groups}
            left = [g for g in groups if not self._done(spark, paths[g[0]])]
            if not left:
                return
            fitted = fitted_groups(estimator, grid, left, self._rows(train, F.col(FOLD) != fold))

            def scored() -> None:
                group, models = next(fitted)
                found = scores(models, self._rows(train, F.col(FOLD) == fold), self.label, self.metric)
                rows = [(name, i, point_name(grid[i]), fold, found[i]) for i in group]
                inline_table(spark, rows, RESULTS).coalesce(1).write.mode("overwrite").parquet(paths[group[0]])
                self._counted()

            fit_all([scored] * len(left), 1 if self.parallelism == 1 else -(-self.parallelism // self.folds))

        def final(name: str, position: int) -> None:
            estimator, grid = self.entrants[name]
            path = self._path("scores", name)
            if self._done(spark, path):
                return
            if isinstance(estimator, BaggingClassifier):
                (_, models), = fitted_groups(estimator, grid, [[position]], self._rows(train))
            else:
                models = {position: estimator.fit(self._rows(train), dict(grid[position]))}
            value = scores(models, held_out, self.label, self.metric)[position]
            inline_table(spark, [(name, position, point_name(grid[position]), value)], SCORES).coalesce(1).write.mode("overwrite").parquet(path)
            self._counted()

        # The longest fits come first, and an entrant's last fit begins when its folds are done: no
        # thread waits for the rounds of one slow learner at the end.
        plan = [(n, s, f) for n, (e, grid) in self.entrants.items() for s in self._steps(e, grid) for f in range(self.folds)]
        plan.sort(key=lambda p: -max(passes(self.entrants[p[0]][0], self.entrants[p[0]][1][i]) for g in p[1] for i in g))
        waiting, lock = Counter(n for n, _, _ in plan), Lock()

        def step(name: str, groups: list[list[int]], fold: int) -> None:
            some(name, groups, fold)
            with lock:
                waiting[name] -= 1
                last = not waiting[name]
            if last:
                final(name, self.chosen(spark, name)[name])

        fit_all([lambda p=p: step(*p) for p in plan], self.parallelism)
        told = spark.read.schema(SCORES).parquet(f"{self.folder}/scores/*/*").collect()
        return leaderboard(spark, {r.entrant: r.value for r in told})

    def results(self, spark: SparkSession, entrant: str | None = None) -> DataFrame:
        """One row per (entrant, point, fold) that is done, of all entrants or one."""
        path = f"{self.folder}/results/*/*" if entrant is None else self._path("results", entrant, "*")
        return spark.read.schema(RESULTS).parquet(path)

    def points(self, spark: SparkSession, entrant: str | None = None) -> DataFrame:
        """One row per entrant and point: mean metric, its deviation over folds, and whether it is the
        chosen one (the largest mean, the first of equals)."""
        from pyspark.sql import Window
        means = self.results(spark, entrant).groupBy("entrant", "position", "point").agg(
            F.avg("value").alias("metric"), F.stddev_pop("value").alias("std"), F.count(F.lit(1)).alias("folds"))
        order = Window.partitionBy("entrant").orderBy(F.desc(F.round("metric", 12)), "position")
        return means.withColumn("is_best", F.row_number().over(order) == 1)

    def chosen(self, spark: SparkSession, entrant: str | None = None) -> dict[str, int]:
        return {r.entrant: r.position for r in self.points(spark, entrant).where("is_best").collect()}


__all__ = ["Comparison", "fit_groups", "fitted_points", "prefix", "score_of", "scores"]
