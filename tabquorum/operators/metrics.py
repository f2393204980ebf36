"""Evaluation as aggregates over ``(label, prediction)`` frames; each returns rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction); everything class-based below starts from these."""
    return (df.groupBy(F.col(label).cast("double").alias("label"),
                       F.col(prediction).cast("double").alias("prediction"))
              .agg(F.count(F.lit(1)).alias("n")))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, one minus accuracy and the row count in one aggregate."""
    hit = F.avg((F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double"))
    return df.agg(hit.alias("accuracy"), (F.lit(1.0) - hit).alias("error"),
                  F.count(F.lit(1)).alias("n"))


def test_error(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Mismatching rows, all rows, and their ratio."""
    miss = F.col(label).cast("double") != F.col(prediction).cast("double")
    return df.agg(F.count_if(miss).alias("mismatches"), F.count(F.lit(1)).alias("n"),
                  F.avg(miss.cast("double")).alias("test_error"))


test_error.__test__ = False


def mismatches(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows whose prediction differs from the label."""
    return df.where(F.col(label).cast("double") != F.col(prediction).cast("double"))


def class_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class: rows, predicted rows, hits and F1. Works on the confusion counts."""
    cells = confusion(df, label, prediction)
    sides = cells.select("n", (F.col("label") == F.col("prediction")).alias("hit"),
                         F.inline(F.array(
                             F.struct(F.lit(True).alias("is_label"), F.col("label").alias("class")),
                             F.struct(F.lit(False).alias("is_label"),
                                      F.col("prediction").alias("class")))))
    per = sides.groupBy("class").agg(
        F.sum(F.when(F.col("is_label"), F.col("n")).otherwise(0)).alias("labelled"),
        F.sum(F.when(~F.col("is_label"), F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when(F.col("is_label") & F.col("hit"), F.col("n")).otherwise(0)).alias("hits"))
    return per.withColumn("f1", 2.0 * F.col("hits") / (F.col("labelled") + F.col("predicted")))


def weighted_f1(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """F1 per class weighted by the class's share of the labels."""
    return class_scores(df, label, prediction).agg(
        (F.sum(F.col("labelled") * F.col("f1")) / F.sum("labelled")).alias("f1"),
        F.sum("labelled").alias("n"))


def mean_squared_error(df: DataFrame, label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(label) - F.col(prediction), 2)).alias("mse"),
                  F.count(F.lit(1)).alias("n"))


def area_under_roc(df: DataFrame, score: str = "score", label: str = "label",
                   buckets: int | None = None) -> DataFrame:
    """Exact area under the ROC curve: share of (positive, negative) pairs in right order,
    equal scores counting half.

    Rows are first reduced to one per distinct score, so a score shared by many rows costs
    nothing later. The scores are dealt by range (in as many ranges as the session shuffles to, or in
    ``buckets``), each range is ranked by itself, and only one row per range is ranked globally.
    Infinite scores rank below or above all others; rows whose score is null or not a number,
    or whose label is null, are left out.
    """
    df = df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull())
    positive = F.col(label).cast("double") > 0.5
    per_score = df.groupBy(score).agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    dealt = per_score.repartitionByRange(score) if buckets is None else per_score.repartitionByRange(buckets, score)
    per_score = dealt.withColumn("_range", F.spark_partition_id())
    lower = (Window.partitionBy("_range").orderBy(score)
             .rowsBetween(Window.unboundedPreceding, -1))
    beaten = F.coalesce(F.sum("neg").over(lower), F.lit(0)) + F.col("neg") / 2
    per_range = (per_score.withColumn("pairs", F.col("pos") * beaten).groupBy("_range")
                 .agg(F.sum("pairs").alias("pairs"), F.sum("pos").alias("pos"),
                      F.sum("neg").alias("neg")))
    # One row a range from here on.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    total = per_range.withColumn(
        "pairs", F.col("pairs") + F.col("pos") * F.coalesce(F.sum("neg").over(before), F.lit(0)))
    return total.agg(
        (F.sum("pairs") / (F.sum("pos").cast("double") * F.sum("neg"))).alias("auc"),
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
