"""Null filling: constants, and means fitted on one frame and applied to others."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fit_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Mean of each column, nulls skipped, all in one aggregate; 0.0 where there is no value."""
    row = df.agg(*[F.avg(F.col(f"`{c}`")).alias(c) for c in columns]).first()
    return {c: 0.0 if row[c] is None else float(row[c]) for c in columns}


def fill_values(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Per-column constants. A double going into an int column is truncated (74.9 -> 74)."""
    return df.na.fill(dict(values))


def fill_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill the columns with their own means."""
    return fill_values(df, fit_means(df, columns))


def fill_mean_lazy(df: DataFrame, column: str, source: DataFrame | None = None, where: Column | None = None) -> DataFrame:
    """As ``fill_mean`` with the mean as a scalar subquery: no job until the result is used.

    The mean is that of ``source`` (``df`` itself by default), of the rows that ``where`` selects; with a
    condition for training rows, one pass fills training and other rows alike.
    """
    source = df if source is None else source
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`") if where is None else F.when(where, F.col(f"`{column}`"))
    mean = source.agg(F.coalesce(F.avg(value), F.lit(0.0))).scalar()
    return df.withColumn(column, F.coalesce(F.col(f"`{column}`"), mean.cast(kind)))


def recode(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace listed strings by others; strings not listed are kept."""
    return df.na.replace(dict(mapping), subset=[column])
