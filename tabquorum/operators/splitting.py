"""Train/test splits and fold numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_bucket, hash_word

FOLD_SEED = 7919    # folds and splits of one key must not share a hash


def hash_split(df: DataFrame, key: Column, train_percent: int) -> tuple[DataFrame, DataFrame]:
    """Split by a bucket of the row key.

    Each side is a filter on the scan: no sort, no shuffle, and the same rows every time
    whatever the partitioning.
    """
    return df.where(in_train(key, train_percent)), df.where(~in_train(key, train_percent))


def in_train(key: Column, train_percent: int) -> Column:
    """Whether ``hash_split`` puts a row on the training side, for use in one pass over both."""
    return hash_bucket(key, 100) < train_percent


def fold_number(key: Column, folds: int) -> Column:
    """Fold 0..folds-1 from a hash of the row key that splits do not use."""
    return (hash_word(key, 0, FOLD_SEED) % folds).cast("int")


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Spark's seeded random split; repeatable only for an unchanged partitioning."""
    return df.randomSplit(list(weights), seed)


def with_fold(df: DataFrame, key: Column, folds: int, out: str = "fold") -> DataFrame:
    """Fold number 0..folds-1 from the row key, as ``CrossValidator(foldCol=...)`` takes it."""
    return df.withColumn(out, fold_number(key, folds))
