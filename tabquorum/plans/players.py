"""Player ratings to a three-class task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import band
from ..functions.fixed_values import OVERALL_EDGES, PLAYER_SKILLS
from ..operators.encode import assembler
from ..operators.impute import fill_mean
from ..sources.readers import schema_of

PLAYER_FEATURES = ("Age", "Potential", "Value", *PLAYER_SKILLS)


def player_schema():
    head = (("Name", "string"), ("Age", "int"), ("Nationality", "string"), ("Overall", "int"),
            ("Potential", "int"), ("Club", "string"), ("Value", "int"))
    return schema_of(*head, *[(skill, "int") for skill in PLAYER_SKILLS])


def player_frame(df: DataFrame, weight: float = 0.5) -> DataFrame:
    """Missing ratings filled with their (truncated) mean, ratings banded, columns assembled.

    ``weight`` becomes a constant column for ``weightCol``. It is not a feature: no split can
    use a constant. Index the bands with ``label_indexer("Overall")``.
    """
    filled = fill_mean(df, ["Overall"]).drop("Name", "Club", "Nationality")
    banded = filled.withColumns({"weight": F.lit(weight),
                                 "Overall": band(F.col("Overall"), OVERALL_EDGES)})
    return assembler(PLAYER_FEATURES).transform(banded)
