"""Typed scans. Schemas are always given, so no read triggers an inference job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


KINDS = {"int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
         "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType()}


def schema_of(*fields: tuple[str, str]) -> T.StructType:
    """Schema from ``(name, type)`` pairs; names may hold spaces and operators."""
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in fields])


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line that is skipped; a cell that does not parse becomes null."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """``label index:value ...`` text as ``(label double, features vector)``.

    Give ``num_features`` for large inputs: without it Spark reads all lines once more to
    find the largest index.
    """
    reader = spark.read.format("libsvm")
    if num_features is not None:
        reader = reader.option("numFeatures", num_features)
    return reader.load(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tables(spark: SparkSession, folder: str, *names: str) -> None:
    """Register parquet tables of a folder as temporary views."""
    for name in names:
        table(spark, folder, name).createOrReplaceTempView(name)
