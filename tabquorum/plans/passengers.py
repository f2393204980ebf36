"""Passenger records to eight model features."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import band, zero_flag
from ..functions.fixed_values import (AGE_EDGES, DEFAULT_PORT, FARE_EDGES, PASSENGER_FIELDS,
                                      TITLE_RECODE)
from ..functions.text import honorific
from ..operators.encode import string_indexer
from ..operators.impute import fill_values, fit_means, recode
from ..sources.readers import schema_of

INDEXED = ("Embarked", "Title", "Sex")


def passenger_schema(with_label: bool = True):
    return schema_of(*[f for f in PASSENGER_FIELDS if with_label or f[0] != "Survived"])


def engineered(df: DataFrame, means: dict[str, float]) -> DataFrame:
    """Fill, title, recode, bands, family flag and interaction; one projection chain."""
    filled = fill_values(df, {"Fare": means["Fare"], "Age": means["Age"],
                              "Embarked": DEFAULT_PORT})
    titled = recode(filled.withColumn("Title", honorific(F.col("Name"))), "Title", TITLE_RECODE)
    banded = titled.withColumns({
        "Age": band(F.col("Age"), AGE_EDGES),
        "Fare": band(F.col("Fare"), FARE_EDGES),
        "FamilySize": F.col("SibSp") + F.col("Parch"),
    })
    return banded.withColumns({
        "Alone": zero_flag(F.col("FamilySize")),
        "Age*Class": F.col("Age") * F.col("Pclass"),
    }).drop("Ticket", "Cabin", "Name", "SibSp", "Parch", "FamilySize")


class PrepParams(Params):
    foldUnknownTitles: Param[bool] = Param(
        Params._dummy(), "foldUnknownTitles",
        "treat titles absent from the training rows as Rare, which keeps the number of "
        "categories; otherwise handleInvalid applies", TypeConverters.toBoolean)
    handleInvalid: Param[str] = Param(
        Params._dummy(), "handleInvalid", "error, skip or keep, for unseen strings",
        TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(foldUnknownTitles=True, handleInvalid="error")


class PassengerPrep(PrepParams, Estimator):
    """Means and string indices are fitted once, on the training rows, and applied to any
    other frame with the same columns (the label may be missing)."""

    @keyword_only
    def __init__(self, *, foldUnknownTitles=True, handleInvalid="error"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PassengerPrepModel:
        means = fit_means(dataset, ["Age", "Fare"])
        indexer = string_indexer(INDEXED, handle_invalid=self.getOrDefault(self.handleInvalid))
        model = PassengerPrepModel(means, indexer.fit(engineered(dataset, means)))
        model._resetUid(self.uid)
        return self._copyValues(model)


class PassengerPrepModel(PrepParams, Model):
    def __init__(self, means, indexer):
        super().__init__()
        self.means, self.indexer = means, indexer

    @property
    def labels(self) -> dict[str, list[str]]:
        """Strings behind the index values, per column."""
        return {c: list(v) for c, v in zip(INDEXED, self.indexer.labelsArray)}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = engineered(dataset, self.means)
        known = self.labels["Title"]
        if self.getOrDefault(self.foldUnknownTitles) and "Rare" in known:
            title = F.col("Title")
            out = out.withColumn("Title", F.when(title.isin(known), title).otherwise("Rare"))
        return self.indexer.transform(out).drop(*INDEXED)
