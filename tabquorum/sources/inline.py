"""Small in-memory rows (score tables, band names) as typed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Rows already on the driver, such as one metric per model, with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)
