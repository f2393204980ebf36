"""Fitted index tables applied to other frames."""

import pytest
from pyspark.sql import functions as F

from tabquorum.operators.ranking import apply_index, decode_index, fit_index
from tabquorum.sources import dealt
from tabquorum.sources.spread import task_count


@pytest.fixture(scope="module")
def index(spark):
    rows = [("b",), ("b",), ("a",), ("c",), (None,), ("a",), ("d e",)]
    return fit_index(spark.createDataFrame(rows, "v string"), "v")


def test_positions_by_frequency_then_text(index):
    assert [(r.value, r.position, r.n) for r in index.orderBy("position").collect()] == [("a", 0.0, 2), ("b", 1.0, 2), ("c", 2.0, 1), ("d e", 3.0, 1)]


@pytest.mark.parametrize("hot", [0, 1, 1000])
def test_unseen_values(spark, index, hot):
    other = spark.createDataFrame([(1, "b"), (2, "new"), (3, None), (4, "d e"), (5, "new")], "id int, `the.value` string")
    kept = apply_index(other, index, "the.value", "i", "keep", hot)
    assert sorted(((r.id, r.i) for r in kept.collect())) == [(1, 1.0), (2, 4.0), (3, None), (4, 3.0), (5, 4.0)]
    skipped = apply_index(other, index, "the.value", "i", "skip", hot)
    assert sorted((r.id, r.i) for r in skipped.collect()) == [(1, 1.0), (3, None), (4, 3.0)]
    assert skipped.columns == ["id", "the.value", "i"]
    with pytest.raises(Exception, match="not in the index: new"):
        apply_index(other, index, "the.value", "i", "error", hot).collect()
    with pytest.raises(ValueError):
        apply_index(other, index, "the.value", "i", "drop")


def test_decoding_leads_back(spark, index):
    rows = spark.createDataFrame([(0.0,), (3.0,), (4.0,), (None,)], "p double")
    assert [r.v for r in decode_index(rows, index, "p", "v").orderBy("p").collect()] == [None, "a", "d e", None]


def test_an_index_of_no_values(spark):
    index = fit_index(spark.createDataFrame([(None,)], "v string"), "v")
    assert index.count() == 0
    assert apply_index(spark.createDataFrame([("x",)], "v string"), index, "v", "i", "keep").first().i == 0.0


def test_numbers_are_indexed_by_their_text(spark):
    index = fit_index(spark.range(20).select((F.col("id") % 3).alias("v")), "v")
    assert [(r.value, r.n) for r in index.orderBy("position").collect()] == [("0", 7), ("1", 7), ("2", 6)]


def test_dealt_rows_do_not_depend_on_the_files(spark, squares):
    rows = squares.select("id", "label")
    one, other = dealt(rows.repartition(9), "id", 200), dealt(rows.coalesce(1).orderBy(F.desc("id")), "id", 200)
    parts = lambda df: [[r.id for r in p] for p in df.rdd.glom().collect()]
    assert parts(one) == parts(other) and len(parts(one)) == -(-squares.count() // 200)
    one.unpersist()
    other.unpersist()


def test_many_passes_take_few_tasks():
    assert [task_count(n, many_passes=True) for n in (0, 600_000, 36_000_000, 216_000_000)] == [1, 10, 48, 206]
    assert [task_count(n) for n in (0, 65_537, 216_000_000)] == [1, 2, 3296]
