"""Frames the queries share, in Spark and in SQL.

The given tables have no names with titles, no missing values and no wide ratings, so these
are derived from keys by rule, identically on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabquorum.functions import band, text_shape
from tabquorum.operators.encode import assembler
from tabquorum.sources import dealt, table

TITLES = ["Mr", "Mrs", "Miss", "Master", "Don", "Countess", "Col", "Rev", "Lady", "Mme", "Capt",
          "Dr", "Sir", "Jonkheer", "Mlle", "Major", "Ms", "Dona"]


def null_every(key: str, step: int, value: Column) -> Column:
    """The value, missing where the key divides by ``step``."""
    return F.when(F.col(key) % step != 0, value)


# The 64-bit multipliers of the public xxHash algorithm, XXH64.
XX = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
      0x27D4EB2F165667C5)


def mod64(expression: str) -> str:
    return f"(({expression}) & 18446744073709551615::UHUGEINT)::UBIGINT"


def times(a: str, b: int) -> str:
    return mod64(f"({a})::UHUGEINT * {b}::UHUGEINT")


def plus(a: str, b: int) -> str:
    return mod64(f"({a})::UHUGEINT + {b}::UHUGEINT")


def xxhash_steps(out: str, value: str, seed: str) -> str:
    """Select list ending in column ``out``: XXH64 of one long, each step naming the last."""
    def rotated(x: str, bits: int) -> str:
        return f"({times(x, 1 << bits)} + ({x} >> {64 - bits}))"
    steps = [times(value, XX[1]), times(rotated(f"{out}0", 31), XX[0]),
             f"xor({plus(seed, XX[4] + 8)}, {out}1)", plus(times(rotated(f"{out}2", 27), XX[0]), XX[3]),
             times(f"xor({out}3, {out}3 >> 33)", XX[1]), times(f"xor({out}4, {out}4 >> 29)", XX[2])]
    named = [f"{s} AS {out}{i}" for i, s in enumerate(steps)]
    return ", ".join([*named, f"xor({out}5, {out}5 >> 32) AS {out}"])


def hashed_sql(source: str, key: str, seed: int | None = None) -> str:
    """The source with the two hash words ``h0`` and ``h1`` of a long key."""
    steps = xxhash_steps("hx", key, "42::UBIGINT")
    if seed is not None:
        steps += ", " + xxhash_steps("hy", str(seed), "hx")
    last = "hx" if seed is None else "hy"
    return (f"(SELECT *, CAST({last} & 4294967295 AS BIGINT) AS h0, CAST({last} >> 32 AS BIGINT) AS h1 "
            f"FROM (SELECT *, {steps} FROM {source}))")


# --- passengers derived from customer -------------------------------------------------------

def passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passenger-shaped rows; one key in 19 has a name without a title."""
    key = F.col("c_custkey")
    title = F.element_at(F.array(*map(F.lit, [*TITLES, ""])), (key % 19 + 1).cast("int"))
    name = F.when(title == "", F.concat(F.lit("Surname"), key.cast("string"))).otherwise(
        F.concat(F.lit("Surname"), key.cast("string"), F.lit(", "), title, F.lit(". Given")))
    return table(spark, sf_dir, "customer").select(
        key.alias("PassengerId"),
        (key % 2).cast("int").alias("Survived"),
        (F.col("c_nationkey") % 3 + 1).cast("int").alias("Pclass"),
        name.alias("Name"),
        F.when(key % 3 == 0, "female").otherwise("male").alias("Sex"),
        null_every("c_custkey", 7, (key % 80).cast("float")).alias("Age"),
        (F.col("c_nationkey") % 2).cast("int").alias("SibSp"),
        (key % 3).cast("int").alias("Parch"),
        F.col("c_mktsegment").alias("Ticket"),
        null_every("c_custkey", 11, (F.col("c_acctbal") / 100).cast("float")).alias("Fare"),
        F.lit(None).cast("string").alias("Cabin"),
        null_every("c_custkey", 13, F.element_at(F.array(*map(F.lit, "SCQ")),
                                                 (key % 5 % 3 + 1).cast("int"))).alias("Embarked"),
    )


PASSENGERS_SQL = f"""
passengers AS (
  SELECT c_custkey AS PassengerId, CAST(c_custkey % 2 AS INTEGER) AS Survived,
         CAST(c_nationkey % 3 + 1 AS INTEGER) AS Pclass,
         CASE WHEN c_custkey % 19 = 18 THEN 'Surname' || c_custkey
              ELSE 'Surname' || c_custkey || ', ' || {TITLES!r}[c_custkey % 19 + 1] || '. Given'
         END AS Name,
         CASE WHEN c_custkey % 3 = 0 THEN 'female' ELSE 'male' END AS Sex,
         CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 80 AS FLOAT) END AS Age,
         CAST(c_nationkey % 2 AS INTEGER) AS SibSp, CAST(c_custkey % 3 AS INTEGER) AS Parch,
         c_mktsegment AS Ticket,
         CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_acctbal / 100 AS FLOAT) END AS Fare,
         CASE WHEN c_custkey % 13 <> 0 THEN ['S', 'C', 'Q'][c_custkey % 5 % 3 + 1] END AS Embarked
  FROM customer)"""


# --- a three-class task over all of lineitem -------------------------------------------------

LINE_FEATURES = ("x0", "x1", "x2", "x3")
LINE_EDGES = (500_000, 1_700_000)


def line_columns() -> dict[str, Column]:
    """Row id, four small integer features, and the value band as label."""
    value = F.col("l_quantity") * F.col("l_extendedprice")
    return {
        "id": F.col("l_orderkey") * 8 + F.col("l_linenumber"),
        "x0": F.col("l_quantity"),
        "x1": F.floor(F.col("l_extendedprice") / 2100).cast("double"),
        "x2": F.round(F.col("l_discount") * 100),
        "x3": F.round(F.col("l_tax") * 100),
        "label": band(value, LINE_EDGES).cast("double"),
    }


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = line_columns()
    return table(spark, sf_dir, "lineitem").select(*[c.alias(n) for n, c in columns.items()])


def line_task(spark: SparkSession, sf_dir: str, features=LINE_FEATURES, many_passes: bool = False) -> DataFrame:
    """``line_rows`` with the features as a vector and the classes in the metadata, kept for
    the many passes of training (hundreds with ``many_passes``)."""
    rows = assembler(features).transform(line_rows(spark, sf_dir))
    classes = {"ml_attr": {"type": "nominal", "vals": ["0", "1", "2"], "name": "label"}}
    return dealt(rows.select("id", "features", "label").withMetadata("label", classes), "id", many_passes=many_passes)


LINES_SQL = """
lines AS (
  SELECT l_orderkey * 8 + l_linenumber AS id,
         l_quantity AS x0, floor(l_extendedprice / 2100) AS x1,
         round(l_discount * 100) AS x2, round(l_tax * 100) AS x3,
         CASE WHEN l_quantity * l_extendedprice <= 500000 THEN 0
              WHEN l_quantity * l_extendedprice <= 1700000 THEN 1 ELSE 2 END AS y
  FROM lineitem)"""


# --- a two-class task with real signal: is a document of good quality ------------------------

QUALITY_FEATURES = ("text_chars", "text_words", "distinct_word_share", "letter_share")


def quality_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with the shape of their texts.

    The shape is computed before the join, so texts are never shuffled by it.
    """
    shapes = table(spark, sf_dir, "documents").select(
        "doc_id", *[c.alias(n) for n, c in text_shape(F.col("text")).items()])
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("label"))
    return shapes.join(labels, "doc_id")


def quality_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = {"ml_attr": {"type": "nominal", "vals": ["0", "1"], "name": "label"}}
    rows = assembler(QUALITY_FEATURES).transform(quality_rows(spark, sf_dir)).select("doc_id", "features", "label")
    return dealt(rows.withMetadata("label", classes), "doc_id")
