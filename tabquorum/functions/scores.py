"""Class scores as native expressions: votes, weighted votes, softmax, argmax."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def vote_scores(predictions: Sequence[Column], classes: int,
                weights: Sequence[float] | None = None) -> Column:
    """Array of ``classes`` doubles: total (weighted) vote for each class."""
    weights = [1.0] * len(predictions) if weights is None else weights
    return F.array(*[
        reduce(add, [F.when(p == float(k), F.lit(float(w))).otherwise(F.lit(0.0))
                     for p, w in zip(predictions, weights)])
        for k in range(classes)])


def vote_counts(names: Sequence[str], classes: int) -> Column:
    """``vote_scores`` of the columns of these names, each vote 1, parsed as one text: building it part by part
    takes the driver longer than a small table's votes."""
    return F.expr("array(" + ", ".join(" + ".join(f"CASE WHEN `{name}` = {k}.0D THEN 1.0D ELSE 0.0D END" for name in names)
                                       for k in range(classes)) + ")")


def softmax(scores: Sequence[Column]) -> list[Column]:
    """Class probabilities; the largest score is subtracted first so exp cannot overflow."""
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    terms = [F.exp(s - top) for s in scores]
    total = reduce(add, terms)
    return [t / total for t in terms]


def argmax_index(scores: Column) -> Column:
    """0-based position of the largest array element as a double; the lowest on a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("double")
