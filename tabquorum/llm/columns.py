"""Working on frames whose columns may have any name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def apart(df: DataFrame, *needed: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``df`` with its columns out of the way, and the function that brings them back.

    All columns get names no operator uses; those of ``needed`` are there once more under their own
    name. The function, given a frame made of these rows, selects exactly the columns of ``df`` again,
    and after them the result columns named; a column of ``df`` with the name of a result gives way.
    """
    names = {c: f"_own_{i}_" for i, c in enumerate(df.columns)}
    rows = df.select(*[column(c).alias(a) for c, a in names.items()], *[column(c).alias(c) for c in needed])
    return rows, lambda out, *results: out.select(*[F.col(a).alias(c) for c, a in names.items() if c not in results], *results)
