"""Strings to indices, columns to vectors, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def string_indexer(columns: Sequence[str], suffix: str = "_indexed",
                   handle_invalid: str = "error") -> StringIndexer:
    """Frequency indices of several columns, all counted in one pass."""
    return StringIndexer(inputCols=list(columns), outputCols=[c + suffix for c in columns],
                         handleInvalid=handle_invalid)


def label_indexer(column: str, out: str = "label") -> StringIndexer:
    """Class index by frequency. Classes 0, 1, 2 need not be the values 0, 1, 2; the fitted
    model's ``labels`` and ``decode_prediction`` lead back."""
    return StringIndexer(inputCol=column, outputCol=out)


def decode_prediction(df: DataFrame, labels: Sequence[str], column: str = "prediction",
                      out: str = "predicted_value") -> DataFrame:
    return IndexToString(inputCol=column, outputCol=out, labels=list(labels)).transform(df)


def assembler(columns: Sequence[str], out: str = "features",
              handle_invalid: str = "error") -> VectorAssembler:
    """Vector of the columns in the given order; a null raises an error by default."""
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid=handle_invalid)


def chained(*stages) -> Pipeline:
    return Pipeline(stages=list(stages))


def vector_entries(df: DataFrame, keys: Sequence[str], column: str = "features") -> DataFrame:
    """One row per vector position: the keys, ``position`` and ``value``."""
    return df.select(*keys, F.posexplode(vector_to_array(column)).alias("position", "value"))
