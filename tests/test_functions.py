import math

import pytest
from pyspark.sql import functions as F

from tabquorum.functions import (argmax_index, band, hash_bucket, hash_word, honorific,
                                 honorific_by_split, lookup, member_uniform, poisson_count,
                                 softmax, text_shape, vote_scores, zero_flag)
from tabquorum.functions.fixed_values import AGE_EDGES, FARE_EDGES, SEX_CODES


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def test_band_edges_belong_to_the_lower_band(spark):
    values = [0.0, 16.0, 16.5, 32.0, 48.0, 48.1, 64.0, 64.1, None]
    assert column(spark, values, "double", band(F.col("v"), AGE_EDGES)) == [0, 0, 1, 1, 2, 3, 3, 4, 4]


def test_float_on_a_decimal_edge_is_widened_first(spark):
    # float 7.91 widens to slightly less, float 14.454 to slightly more than the edge
    values = [7.91, 14.454, 31.0, None]
    assert column(spark, values, "float", band(F.col("v"), FARE_EDGES)) == [0, 2, 2, 3]
    assert column(spark, values, "double", band(F.col("v"), FARE_EDGES)) == [0, 1, 2, 3]


def test_zero_flag(spark):
    assert column(spark, [0, 1, None], "int", zero_flag(F.col("v"))) == [1, 0, 0]


@pytest.mark.parametrize("name,title", [
    ("Kelly, Mr. James", "Mr"), ("Oliva y Ocana, Dona. Fermina", "Dona"), ("Cher", ""),
    ("Rothes, the Countess. of (Lucy Noel)", "Countess"), ("St. John, Mr. X", "St"), (None, None)])
def test_honorific(spark, name, title):
    assert column(spark, [name], "string", honorific(F.col("v"))) == [title]


def test_honorific_by_split_keeps_the_blank(spark):
    assert column(spark, ["Kelly, Mr. James"], "string", honorific_by_split(F.col("v"))) == [" Mr"]


def test_lookup_without_entry_is_null(spark):
    out = column(spark, ["female", "male", "other", None], "string", lookup(F.col("v"), SEX_CODES))
    assert out == [1, 0, None, None]


def test_text_shape(spark):
    rows = spark.createDataFrame([("a b a",), ("",), ("  x1 ",), ("\nab cd",), (" \t",), (None,)], "t string")
    out = rows.select(*[c.alias(n) for n, c in text_shape(F.col("t")).items()]).collect()
    assert out[0].text_words == 3 and out[0].distinct_word_share == pytest.approx(2 / 3)
    assert out[0].letter_share == pytest.approx(3 / 5)
    assert out[1].letter_share == 0.0 and out[2].text_words == 1
    assert (out[1].text_words, out[3].text_words, out[4].text_words) == (0, 2, 0)
    assert (out[1].distinct_word_share, out[4].distinct_word_share, out[5].distinct_word_share) == (0.0, 0.0, None)


def test_hash_depends_on_the_key_only(spark):
    keys = spark.range(2000)
    one = {r.id: r.b for r in keys.repartition(1).select("id", hash_bucket(F.col("id"), 10).alias("b")).collect()}
    other = {r.id: r.b for r in keys.repartition(7).select("id", hash_bucket(F.col("id"), 10).alias("b")).collect()}
    assert one == other and set(one.values()) == set(range(10))


def test_words_are_32_bits(spark):
    words = [hash_word(F.col("id"), w, 3) for w in (0, 1)]
    row = spark.range(5000).select(*[F.max(w) for w in words], *[F.min(w) for w in words]).first()
    assert max(row) < 2 ** 32 and min(row) >= 0


def test_poisson_counts_have_the_right_moments(spark):
    for member in (0, 5):
        count = poisson_count(member_uniform(F.col("id"), 1, member), 0.7)
        mean, var, zero = spark.range(40_000).select(
            F.avg(count), F.var_samp(count), F.avg((count == 0).cast("double"))).first()
        assert mean == pytest.approx(0.7, abs=0.02) and var == pytest.approx(0.7, abs=0.03)
        assert zero == pytest.approx(math.exp(-0.7), abs=0.01)


def test_members_draw_independently(spark):
    u, v = member_uniform(F.col("id"), 1, 1), member_uniform(F.col("id"), 1, 2)
    assert abs(spark.range(40_000).select(F.corr(u, v)).first()[0]) < 0.02


@pytest.mark.parametrize("chosen,share", [
    (lambda u: poisson_count(u, 0.5) > 0, math.exp(-0.5)), (lambda u: u < 0.3, 0.7)])
def test_rows_in_no_member_are_as_many_as_independent_draws_leave(spark, chosen, share):
    n, members = 400_000, 10
    seen = F.greatest(*[chosen(member_uniform(F.col("id"), 5, m)) for m in range(members)])
    expected = n * share ** members
    unseen = spark.range(n).where(~seen).count()
    assert abs(unseen - expected) <= 3 * math.sqrt(expected)


@pytest.mark.parametrize("rate", [0.0, -1.0, 101.0, float("nan")])
def test_poisson_rates_out_of_range_are_refused(rate):
    from tabquorum.functions.hashing import poisson_steps
    with pytest.raises(ValueError):
        poisson_steps(rate)


def test_votes_ties_and_softmax(spark):
    row = spark.range(1).select(
        argmax_index(vote_scores([F.lit(2.0), F.lit(1.0), F.lit(0.0)], 3)).alias("tie"),
        argmax_index(vote_scores([F.lit(2.0), F.lit(1.0)], 3, [0.4, 0.6])).alias("weighted"),
        F.array(*softmax([F.lit(1000.0), F.lit(1000.0)])).alias("large")).first()
    assert (row.tie, row.weighted, row.large) == (0.0, 1.0, [0.5, 0.5])
