"""What the four ensembles share: parameters, class count, training frame, member fitting."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol, HasLabelCol, HasMaxIter, HasParallelism, HasPredictionCol,
    HasProbabilityCol, HasRawPredictionCol, HasSeed, HasWeightCol)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ...sources.shared import materialize, release
from ...sources.spread import task_count

ROW_KEY, WEIGHT = "_key", "_weight"


class EnsembleParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasWeightCol, HasSeed,
                     HasMaxIter, HasParallelism):
    """Columns and settings common to the estimators and their models."""

    idCol: Param[str] = Param(
        Params._dummy(), "idCol",
        "column identifying a row; without it the training rows are numbered and written once",
        TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(seed=42, maxIter=10, parallelism=1)

    def getIdCol(self) -> str | None:
        return self.getOrDefault(self.idCol) if self.isDefined(self.idCol) else None

    def weight_column(self) -> str | None:
        return self.getWeightCol() if self.isDefined(self.weightCol) else None


class ScoreParams(HasRawPredictionCol, HasProbabilityCol):
    """Output columns of the ensembles that give class scores."""


class NestedLearners(Params):
    """``copy`` that reaches into parameters holding learners, so that one parameter map may
    set values on the ensemble and on the learners inside it."""

    nested: Sequence[str] = ()

    def copy(self, extra=None):
        out = super().copy(extra)
        for name in self.nested:
            if self.isSet(name):
                held = self.getOrDefault(name)
                inner = ([learner.copy(extra) for learner in held] if isinstance(held, list)
                         else held.copy(extra))
                out._set(**{name: inner})
        return out


class EnsembleEstimator(NestedLearners, EnsembleParams, Estimator):
    def _with(self, **values):
        """Set the parameters that were given."""
        self._set(**{k: v for k, v in values.items() if v is not None})
        return self


class EnsembleModel(EnsembleParams, Model):
    """A model whose ``_transform`` adds native columns; members are Spark models."""

    def _take(self, parent: EnsembleEstimator):
        self._resetUid(parent.uid)
        return parent._copyValues(self)


def class_count(df: DataFrame, label: str) -> int:
    """Number of classes from the label column's metadata, else from the largest label.

    The metadata comes first: a small fold may not hold every class.
    """
    attributes = df.schema[label].metadata.get("ml_attr", {})
    if "vals" in attributes:
        return max(2, len(attributes["vals"]))
    if "num_vals" in attributes:
        return max(2, int(attributes["num_vals"]))
    top = df.agg(F.max(F.col(label).cast("double"))).first()[0]
    if top is None:
        raise ValueError("no training rows")
    return max(2, int(top) + 1)


def feature_count(df: DataFrame, features: str) -> int:
    attributes = df.schema[features].metadata.get("ml_attr", {})
    if "num_attrs" in attributes:
        return int(attributes["num_attrs"])
    first = df.select(features).first()
    if first is None:
        raise ValueError("no training rows")
    return int(first[0].size)


def takes_weights(learner: Estimator) -> bool:
    return learner.hasParam("weightCol")


def configured(learner: Estimator, label: str, features: str, prediction: str,
               weight: str | None = None, seed_shift: int = 0, **probability) -> Estimator:
    """Copy of a base learner reading and writing the given columns.

    ``probability`` is a column for the learner's class probabilities. Score columns nobody
    reads are switched off, which also keeps the names of several members from clashing.
    """
    out = learner.copy()
    out._set(labelCol=label, featuresCol=features, predictionCol=prediction)
    if out.hasParam("rawPredictionCol"):
        out._set(rawPredictionCol="")
    if out.hasParam("probabilityCol"):
        out._set(probabilityCol=probability.get("probability", ""))
    if weight is not None:
        out._set(weightCol=weight)
    if seed_shift and out.hasParam("seed"):
        out._set(seed=out.getOrDefault("seed") + seed_shift)
    return out


def fit_all(tasks: Sequence[Callable[[], Model]], parallelism: int) -> list[Model]:
    """Run the fits from ``parallelism`` driver threads; each submits its own Spark jobs."""
    if parallelism <= 1 or len(tasks) <= 1:
        return [task() for task in tasks]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(tasks))) as pool:
        futures = [pool.submit(inheritable_thread_target(task)) for task in tasks]
        return [future.result() for future in futures]


@contextmanager
def training_frame(df: DataFrame, est: EnsembleParams, words: bool,
                   sources: Sequence[str] = (), merged: bool = False) -> Iterator[DataFrame]:
    """The columns training needs, ready to be read many times.

    Columns: features, label as double, ``_weight`` (the weight column or 1.0), and with
    ``words`` the key that draws are hashed from. It is ``idCol``; without one the rows
    are numbered and written to the shared folder, as a numbering computed again after a
    lost executor could differ. ``merged`` puts the kept rows into no more tasks than their number
    needs: for many short fits whose members draw nothing by partition.
    """
    label, features, weight = est.getLabelCol(), est.getFeaturesCol(), est.weight_column()
    metadata = df.schema[label].metadata
    columns = [F.col(features), F.col(label).cast("double").alias(label, metadata=metadata),
               (F.col(weight).cast("double") if weight else F.lit(1.0)).alias(WEIGHT)]
    path = None
    if words:
        row_id = est.getIdCol()
        if row_id is None:
            numbered = df.select(*columns, F.monotonically_increasing_id().alias("_id"))
            frame, path = materialize(numbered, "rows")
            row_id, columns = "_id", [F.col(features), F.col(label), F.col(WEIGHT)]
        else:
            frame = df
        frame = frame.select(*columns, F.col(row_id).alias(ROW_KEY))
    else:
        frame = df.select(*columns)
    # A frame the caller already keeps in memory only needs projecting.
    keep = path is not None or df.storageLevel == StorageLevel.NONE
    if keep:
        frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield frame.coalesce(task_count(frame.count())) if keep and merged else frame
    finally:
        if keep:
            frame.unpersist()
        if path is not None:
            release(df.sparkSession, path)


class RoundState:
    """The frame carried from one boosting round to the next.

    Every ``every`` rounds it is written to the shared folder, so that the passes of the next fit
    do not evaluate all earlier members again and the plan stays short; in between it is an
    expression over the last table written. 0 writes nothing.
    """

    def __init__(self, df: DataFrame, every: int):
        self.spark, self.every = df.sparkSession, every
        self.path: str | None = None

    def carry(self, df: DataFrame, done: int) -> DataFrame:
        """The frame to use for the round after ``done`` rounds."""
        if self.every > 0 and done % self.every == 0:
            df, path = materialize(df, "state")
            self.close()
            self.path = path
        return df

    def close(self) -> None:
        """Delete the table still held."""
        if self.path is not None:
            release(self.spark, self.path)
            self.path = None


def strip(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Drop working columns: keep only the wanted names, whatever characters they hold."""
    return df.select(*[F.col(f"`{name}`") for name in wanted])
