"""Ordinal bands with right-closed edges, and flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(value: Column, edges: Sequence[float]) -> Column:
    """0 up to and including the first edge, 1 up to the second, ..., else ``len(edges)``.

    A null or NaN value takes the last band. Edges are compared as doubles: a float column
    is widened first, so float 14.454 lies above the edge 14.454. ``Bucketizer`` closes its
    bands on the left and would place values on an edge one band too high.
    """
    out = None
    for code, edge in enumerate(edges):
        hit = value.cast("double") <= F.lit(float(edge))
        out = F.when(hit, code) if out is None else out.when(hit, code)
    return out.otherwise(len(edges))


def zero_flag(value: Column) -> Column:
    """1 where the value is zero, else 0 (null counts as not zero)."""
    return F.when(value == 0, 1).otherwise(0)
