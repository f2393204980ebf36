import random

import pytest
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tabquorum.operators import explore, metrics
from tabquorum.operators.ranking import frequency_index, global_row_number


def scored(spark, rows):
    return spark.createDataFrame(rows, "score double, label double").repartition(5)


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def uniform(n):
    draw = random.Random(1)
    return [(draw.random(), float(draw.random() < 0.4)) for _ in range(n)]


def hot(n):
    draw = random.Random(2)
    return [(0.5 if draw.random() < 0.4 else round(draw.random(), 2), float(draw.random() < 0.3))
            for _ in range(n)]


@pytest.mark.parametrize("rows", [uniform(600), hot(600), [(1.0, 0.0), (1.0, 1.0)],
                                  [(float(i), float(i % 2)) for i in range(50)]])
@pytest.mark.parametrize("buckets", [1, 7, None])
def test_auc_is_exact(spark, rows, buckets):
    out = metrics.area_under_roc(scored(spark, rows), buckets=buckets).first()
    assert out.auc == pytest.approx(brute_auc(rows), abs=1e-12)
    assert out.positives + out.negatives == len(rows)


def test_auc_against_the_evaluator(spark):
    frame = scored(spark, uniform(500))
    expected = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(frame)
    assert metrics.area_under_roc(frame).first().auc == pytest.approx(expected, abs=1e-9)


def test_class_metrics_against_the_evaluator(spark):
    draw = random.Random(3)
    rows = [(float(draw.choice([0, 0, 0, 1, 2])), float(draw.choice([0, 0, 1, 3]))) for _ in range(400)]
    frame = spark.createDataFrame(rows, "label double, prediction double")
    for metric, value in (("f1", metrics.weighted_f1(frame).first().f1),
                          ("accuracy", metrics.accuracy(frame).first().accuracy)):
        expected = MulticlassClassificationEvaluator(metricName=metric).evaluate(frame)
        assert value == pytest.approx(expected, abs=1e-12)
    error = metrics.test_error(frame).first()
    assert error.mismatches == sum(a != b for a, b in rows) == metrics.mismatches(frame).count()
    expected = RegressionEvaluator(metricName="mse").evaluate(frame)
    assert metrics.mean_squared_error(frame).first().mse == pytest.approx(expected, abs=1e-12)


def skewed_values(spark):
    """One value on a third of the rows, a few ties, and many values that occur once."""
    n = F.col("id")
    return spark.range(1500).select("id", F.when(n % 3 == 0, "hot").when(n % 3 == 1, F.concat(
        F.lit("t"), (n % 40).cast("string"))).otherwise(F.concat(F.lit("v"), n.cast("string"))).alias("v"))


@pytest.mark.parametrize("hot_labels", [10_000, 10, 3, 0])
def test_frequency_index_agrees_with_spark(spark, hot_labels):
    rows = skewed_values(spark)
    expected = {r.id: r.i for r in StringIndexer(inputCol="v", outputCol="i").fit(rows).transform(rows).collect()}
    got = frequency_index(rows, "v", "i", hot_labels)
    assert {r.id: r.i for r in got.collect()} == expected
    assert got.columns == ["id", "v", "i"]


@pytest.mark.parametrize("hot_labels", [0, 1, 1000])
def test_index_keeps_null_rows(spark, hot_labels):
    rows = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "v string")
    got = frequency_index(rows, "v", "i", hot_labels)
    assert sorted(((r.v, r.i) for r in got.collect()), key=str) == sorted(
        [("a", 0.0), ("a", 0.0), ("b", 1.0), (None, None)], key=str)


def test_global_row_number(spark):
    rows = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    numbered, _ = global_row_number(rows.repartition(6), [F.desc("k")], "pos")
    assert all(r.pos == 999 - r.k for r in numbered.collect())


def test_index_deals_nulls_evenly_and_has_one_metadata_rule(spark):
    rows = spark.range(8000, numPartitions=8).select(F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = frequency_index(rows, "v", "i", hot_labels=10)
        sizes = [r.n for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got.schema["i"].metadata == {}
    assert sum(sizes) == 8000 and max(sizes) < 8000 / len(sizes) * 1.5


def test_area_under_roc_with_infinite_and_missing_scores(spark):
    inf = float("inf")
    rows = spark.createDataFrame([(-inf, 0.0), (-inf, 1.0), (0.5, 0.0), (inf, 1.0), (inf, 1.0), (None, 1.0),
                                  (float("nan"), 0.0), (0.1, None)], "score double, label double")
    row = metrics.area_under_roc(rows).first()
    assert (row.positives, row.negatives) == (3, 2) and row.auc == pytest.approx(4.5 / 6)


def test_crosstab_with_values_named_like_its_columns(spark):
    rows = spark.createDataFrame([("a", "l"), ("b", "r"), ("a", "l"), ("b", "L_")], "x string, y string")
    out = explore.crosstab(rows, "x", "y")
    assert out.columns == ["x_y", "L_", "l", "r"]
    assert {tuple(r) for r in out.collect()} == {("a", 0, 2, 0), ("b", 1, 0, 1)}
    with pytest.raises(ValueError):
        explore.crosstab(rows.withColumn("y", F.lit("x_y")), "x", "y")


def test_crosstab_with_null_and_absent_pairs(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", None), (None, "y")], "l string, r string")
    out = {r.l_r: r.asDict() for r in explore.crosstab(rows, "l", "r").collect()}
    assert out["a"] == {"l_r": "a", "null": 0, "x": 2, "y": 0}
    assert out["b"]["null"] == 1 and out["null"]["y"] == 1
    with pytest.raises(ValueError):
        explore.crosstab(rows, "l", "r", max_columns=2)


def test_describe_and_correlation(spark):
    rows = spark.createDataFrame([(1, 2.0, "p"), (2, 4.5, "q"), (3, None, None)], "i int, d double, s string")
    out = {r.column: r for r in explore.describe_typed(rows, ["i", "d", "s"]).collect()}
    assert (out["i"].n, out["i"].mean, out["i"].stddev) == (3, 2.0, 1.0)
    assert (out["d"].n, out["d"].min, out["d"].max) == (2, 2.0, 4.5)
    assert (out["s"].n, out["s"].mean, out["s"].min_text, out["s"].max_text) == (2, None, "p", "q")
    assert explore.correlation(rows, [("i", "i")]).first().corr == pytest.approx(1.0)


def test_group_mean_order(spark):
    rows = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 5.0), ("c", None)], "k string, v double")
    assert [tuple(r) for r in explore.group_mean(rows, "k", "v", "m").collect()] == [
        ("c", 5.0), ("a", 1.0), ("b", 1.0)]
    assert explore.global_mean(rows, "v", "m").first().m == pytest.approx(7 / 3)
    assert explore.distinct_values(rows, "k").count() == 3
