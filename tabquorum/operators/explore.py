"""Exploratory aggregates. Every grouping aggregates within its partitions first, so a key
holding a large share of the rows sends one row per partition through the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def global_mean(df: DataFrame, column: str, out: str) -> DataFrame:
    """One row with the mean; nulls are skipped."""
    return df.agg(F.avg(F.col(f"`{column}`")).alias(out))


def group_mean(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Mean per key, largest first, equal means by key."""
    return (df.groupBy(key).agg(F.avg(F.col(f"`{value}`")).alias(out))
              .orderBy(F.desc(out), F.asc(key)))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def crosstab(df: DataFrame, left: str, right: str, right_values: Sequence[str] | None = None,
             max_columns: int = 10_000) -> DataFrame:
    """Counts of value pairs: one row per left value, one column per right value.

    The key column is named ``left_right``; pairs that do not occur give 0 and nulls are
    counted under "null". Only the right-hand values, which become column names, come to
    the driver, and no more than ``max_columns`` of them are accepted. With ``right_values``
    only these become columns, in this order.
    """
    as_text = df.select(
        F.coalesce(F.col(f"`{left}`").cast("string"), F.lit("null")).alias("l"),
        F.coalesce(F.col(f"`{right}`").cast("string"), F.lit("null")).alias("r"))
    if right_values is None:
        found = as_text.select("r").distinct().limit(max_columns + 1).collect()
        if len(found) > max_columns:
            raise ValueError(f"{right} has more than {max_columns} values; too many columns")
        right_values = sorted(row["r"] for row in found)
    out = f"{left}_{right}"
    if out in right_values:
        raise ValueError(f"a value of {right} is named like the key column {out}")
    key = "l"
    while key in {v.lower() for v in right_values}:
        key += "_"
    counts = (as_text.withColumnRenamed("l", key).groupBy(key).pivot("r", list(right_values))
                     .agg(F.count(F.lit(1))).na.fill(0))
    return counts.toDF(out, *right_values)


def describe_typed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum per column, one row each.

    One pass over the input. Numeric columns give doubles; for string columns mean and
    deviation are null and the extremes are in the text columns.
    """
    measures, rows = [], []
    for i, name in enumerate(columns):
        col = F.col(f"`{name}`")
        numeric = isinstance(df.schema[name].dataType, T.NumericType)
        as_double = col.cast("double") if numeric else F.lit(None).cast("double")
        as_text = F.lit(None).cast("string") if numeric else col.cast("string")
        measures.append(F.struct(
            F.lit(name).alias("column"), F.count(col).alias("n"),
            F.avg(as_double).alias("mean"), F.stddev_samp(as_double).alias("stddev"),
            F.min(as_double).alias("min"), F.max(as_double).alias("max"),
            F.min(as_text).alias("min_text"), F.max(as_text).alias("max_text"),
        ).alias(f"m{i}"))
        rows.append(F.col(f"m{i}"))
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def correlation(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson correlation of column pairs, one row per pair, in one pass."""
    row = df.agg(*[F.corr(F.col(f"`{a}`"), F.col(f"`{b}`")).alias(f"c{i}")
                   for i, (a, b) in enumerate(pairs)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"c{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)])))
