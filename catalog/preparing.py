"""Columns, bands, null filling, recoding, text, and the whole preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabquorum.functions import (band, honorific, honorific_by_split, lookup,
                                 zero_flag)
from tabquorum.functions.fixed_values import (AGE_EDGES, FARE_EDGES, OVERALL_EDGES,
                                              SEX_CODES, TITLE_CODES, TITLE_RECODE)
from tabquorum.operators.impute import fill_mean, fill_mean_lazy, fill_values, fit_means, recode
from tabquorum.operators.splitting import (FOLD_SEED, fold_number, hash_split, in_train,
                                           random_split, with_fold)
from tabquorum.plans import PassengerPrep
from tabquorum.sources import table

from .frames import PASSENGERS_SQL, hashed_sql, null_every, passengers
from .registry import query


@query("drop_and_literal", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, CAST(0.5 AS DOUBLE) AS weight, 0 AS Survived
FROM lineitem""")
def drop_and_literal(spark, sf_dir):
    return (table(spark, sf_dir, "lineitem").drop("l_linestatus", "l_shipdate", "no_such_column")
            .withColumns({"weight": F.lit(0.5), "Survived": F.lit(0)}))


@query("sum_and_product_features", """
SELECT l_orderkey, l_partkey, l_suppkey,
       CASE WHEN l_orderkey % 7 <> 0 THEN l_linenumber END + l_suppkey AS FamilySize,
       CASE WHEN l_orderkey % 7 <> 0 THEN l_linenumber END * l_quantity AS "Age*Class"
FROM lineitem""")
def sum_and_product_features(spark, sf_dir):
    part = null_every("l_orderkey", 7, F.col("l_linenumber"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", (part + F.col("l_suppkey")).alias("FamilySize"),
        (part * F.col("l_quantity")).alias("Age*Class"))


@query("band_five", """
SELECT p_partkey, CASE WHEN age <= 16 THEN 0 WHEN age <= 32 THEN 1 WHEN age <= 48 THEN 2
                       WHEN age <= 64 THEN 3 ELSE 4 END AS Age
FROM (SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_size * 2 END AS age FROM part)""")
def band_five(spark, sf_dir):
    """Right-closed bands hit exactly on the edges; null goes to the last band."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        band(null_every("p_partkey", 7, F.col("p_size") * 2), AGE_EDGES).alias("Age"))


@query("band_four", """
SELECT o_orderkey, CASE WHEN fare <= CAST(7.91 AS DOUBLE) THEN 0
                        WHEN fare <= CAST(14.454 AS DOUBLE) THEN 1
                        WHEN fare <= CAST(31 AS DOUBLE) THEN 2 ELSE 3 END AS Fare
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0
             THEN CAST(CAST(o_totalprice / 10000 AS FLOAT) AS DOUBLE) END AS fare FROM orders)""")
def band_four(spark, sf_dir):
    """Single-precision values against double edges."""
    fare = (F.col("o_totalprice") / 10000).cast("float")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", band(null_every("o_orderkey", 7, fare), FARE_EDGES).alias("Fare"))


@query("band_three", """
SELECT CASE WHEN l_quantity * 2 <= 74 THEN 0 WHEN l_quantity * 2 <= 83 THEN 1 ELSE 2 END AS Overall,
       count(*) AS n, sum(l_quantity) AS quantity
FROM lineitem GROUP BY 1""")
def band_three(spark, sf_dir):
    return (table(spark, sf_dir, "lineitem")
            .groupBy(band(F.col("l_quantity") * 2, OVERALL_EDGES).alias("Overall"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")))


@query("flag_zero_null_to_else", """
SELECT l_orderkey, l_partkey, CASE WHEN size = 0 THEN 1 ELSE 0 END AS Alone
FROM (SELECT *, CASE WHEN l_orderkey % 7 <> 0 THEN l_linenumber - 1 END AS size FROM lineitem)""")
def flag_zero_null_to_else(spark, sf_dir):
    size = null_every("l_orderkey", 7, F.col("l_linenumber") - 1)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey",
                                                   zero_flag(size).alias("Alone"))


@query("predicate_text", """
SELECT o_orderstatus, count(*) AS n FROM orders
WHERE o_totalprice > 79100 AND o_totalprice <= 144540 GROUP BY o_orderstatus""")
def predicate_text(spark, sf_dir):
    """A predicate given as SQL text; it reaches the scan as a pushed filter."""
    return (table(spark, sf_dir, "orders")
            .where(F.expr("o_totalprice > 79100 and o_totalprice <= 144540"))
            .groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")))


@query("cast_columns", """
SELECT o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS price_int,
       CAST(o_custkey AS VARCHAR) AS customer_text,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_int
FROM orders""")
def cast_columns(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("int").alias("price_int"),
        F.col("o_custkey").cast("string").alias("customer_text"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority_int"))


@query("impute_map_mixed", """
WITH c AS (SELECT c_custkey,
                  CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_acctbal AS FLOAT) END AS Fare,
                  CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS Embarked FROM customer)
SELECT c_custkey, round(CAST(COALESCE(Fare, CAST((SELECT avg(Fare) FROM c) AS FLOAT)) AS DOUBLE), 3)
         AS Fare, COALESCE(Embarked, 'S') AS Embarked
FROM c""")
def impute_map_mixed(spark, sf_dir):
    """A mean into a float column and a constant into a string column at once."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", null_every("c_custkey", 7, F.col("c_acctbal").cast("float")).alias("Fare"),
        null_every("c_custkey", 5, F.col("c_mktsegment")).alias("Embarked"))
    filled = fill_values(rows, {**fit_means(rows, ["Fare"]), "Embarked": "S"})
    return filled.withColumn("Fare", F.round(F.col("Fare").cast("double"), 3))


@query("impute_int_truncates", """
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_size END AS Overall FROM part)
SELECT p_partkey, COALESCE(Overall, CAST(trunc((SELECT avg(Overall) FROM p)) AS INTEGER)) AS Overall
FROM p""")
def impute_int_truncates(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", null_every("p_partkey", 7, F.col("p_size")).alias("Overall"))
    return fill_mean(rows, ["Overall"])


@query("impute_mean_lazy", """
WITH e AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events)
SELECT event_id, round(COALESCE(value, (SELECT avg(value) FROM e)), 6) AS value FROM e""")
def impute_mean_lazy(spark, sf_dir):
    """The mean as a scalar subquery inside the same job."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", null_every("event_id", 7, F.col("value")).alias("value"))
    return fill_mean_lazy(rows, "value").withColumn("value", F.round("value", 6))


@query("impute_train_stats_on_test", f"""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price,
                  CASE WHEN h0 % 100 < 70 THEN 'train' ELSE 'test' END AS side
           FROM {hashed_sql('orders', 'o_orderkey')})
SELECT o_orderkey, side,
       round(COALESCE(price, (SELECT avg(price) FROM o WHERE side = 'train')), 4) AS price
FROM o""")
def impute_train_stats_on_test(spark, sf_dir):
    """The mean of the training side fills both sides."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", null_every("o_orderkey", 7, F.col("o_totalprice")).alias("price"))
    learns = in_train(F.col("o_orderkey"), 70)
    filled = fill_mean_lazy(rows, "price", where=learns)
    return filled.select("o_orderkey", F.when(learns, "train").otherwise("test").alias("side"), F.round("price", 4).alias("price"))


RECODE_SQL = "CASE title " + " ".join(
    f"WHEN '{old}' THEN '{new}'" for old, new in TITLE_RECODE.items()) + " ELSE title END"


@query("recode_values", f"""
WITH {PASSENGERS_SQL},
t AS (SELECT PassengerId, regexp_extract(Name, '([A-Za-z]+)\\.', 1) AS title FROM passengers)
SELECT PassengerId, {RECODE_SQL} AS Title FROM t""")
def recode_values(spark, sf_dir):
    titled = passengers(spark, sf_dir).select("PassengerId", honorific(F.col("Name")).alias("Title"))
    return recode(titled, "Title", TITLE_RECODE)


@query("regex_title", f"""
WITH {PASSENGERS_SQL}
SELECT PassengerId, regexp_extract(Name, '([A-Za-z]+)\\.', 1) AS Title FROM passengers""")
def regex_title(spark, sf_dir):
    return passengers(spark, sf_dir).select("PassengerId", honorific(F.col("Name")).alias("Title"))


@query("substring_title", f"""
WITH {PASSENGERS_SQL}
SELECT PassengerId, list_extract(string_split(string_split(Name, '.')[1], ','), -1) AS Title
FROM passengers""")
def substring_title(spark, sf_dir):
    """The title by two cuts; keeps the blank in front."""
    return passengers(spark, sf_dir).select("PassengerId",
                                            honorific_by_split(F.col("Name")).alias("Title"))


@query("lookup_map", f"""
WITH {PASSENGERS_SQL},
t AS (SELECT PassengerId, Sex, regexp_extract(Name, '([A-Za-z]+)\\.', 1) AS title FROM passengers)
SELECT PassengerId, CASE Sex WHEN 'female' THEN 1 WHEN 'male' THEN 0 END AS Sex,
       CASE {RECODE_SQL} WHEN 'Mr' THEN 1 WHEN 'Miss' THEN 2 WHEN 'Mrs' THEN 3 WHEN 'Master' THEN 4
                         WHEN 'Rare' THEN 5 END AS Title
FROM t""")
def lookup_map(spark, sf_dir):
    """Strings to codes by a literal map; a string without a code gives null."""
    titled = passengers(spark, sf_dir).select("PassengerId", "Sex",
                                              honorific(F.col("Name")).alias("Title"))
    return recode(titled, "Title", TITLE_RECODE).withColumns(
        {"Sex": lookup(F.col("Sex"), SEX_CODES), "Title": lookup(F.col("Title"), TITLE_CODES)})


def split_sql(percent: int) -> str:
    return f"""
SELECT o_orderkey, CASE WHEN h0 % 100 < {percent} THEN 'train' ELSE 'test' END AS side
FROM {hashed_sql('orders', 'o_orderkey')}"""


def split_query(percent: int):
    def run(spark, sf_dir):
        side = F.when(in_train(F.col("o_orderkey"), percent), "train").otherwise("test")
        return table(spark, sf_dir, "orders").select("o_orderkey", side.alias("side"))
    return run


query("split_hash_70_30", split_sql(70))(split_query(70))
query("split_hash_80_20", split_sql(80))(split_query(80))


@query("split_random")
def split_random(spark, sf_dir):
    """Sizes of a seeded random split, which no other engine draws the same way."""
    sides = random_split(table(spark, sf_dir, "orders").select("o_orderkey"), [0.7, 0.3], 42)
    sizes = [s.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(name))
             for s, name in zip(sides, ("train", "test"))]
    return sizes[0].unionByName(sizes[1])


@query("kfold_hash", f"""
SELECT o_orderkey, CAST(h0 % 5 AS INTEGER) AS fold FROM {hashed_sql('orders', 'o_orderkey', FOLD_SEED)}""")
def kfold_hash(spark, sf_dir):
    return with_fold(table(spark, sf_dir, "orders").select("o_orderkey"), F.col("o_orderkey"), 5)


@query("kfold_sizes", f"""
WITH o AS {hashed_sql('orders', 'o_orderkey', FOLD_SEED)}
SELECT k, fold, count(*) AS n FROM (
  SELECT 3 AS k, CAST(h0 % 3 AS INTEGER) AS fold FROM o UNION ALL
  SELECT 5, CAST(h0 % 5 AS INTEGER) FROM o)
GROUP BY k, fold""")
def kfold_sizes(spark, sf_dir):
    """Rows per fold for three and five folds."""
    orders, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    folds = F.inline(F.array(*[
        F.struct(F.lit(k).alias("k"), fold_number(key, k).alias("fold"))
        for k in (3, 5)]))
    return orders.select(folds).groupBy("k", "fold").agg(F.count(F.lit(1)).alias("n"))


INDEX_SQL = """(SELECT {c} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS i
       FROM train GROUP BY {c})"""


@query("tabular_prep_full", f"""
WITH {PASSENGERS_SQL},
sided AS (SELECT *, h0 % 100 < 70 AS in_train FROM {hashed_sql('passengers', 'PassengerId')}),
means AS (SELECT CAST(avg(Age) AS FLOAT) AS age, CAST(avg(Fare) AS FLOAT) AS fare FROM sided WHERE in_train),
filled AS (SELECT PassengerId, Survived, Pclass, Sex, in_train, SibSp + Parch AS family,
                  CAST(COALESCE(s.Age, m.age) AS DOUBLE) AS age, CAST(COALESCE(s.Fare, m.fare) AS DOUBLE) AS fare,
                  COALESCE(Embarked, 'S') AS Embarked, regexp_extract(Name, '([A-Za-z]+)\\.', 1) AS title
           FROM sided s, means m),
banded AS (SELECT PassengerId, Survived, Pclass, Sex, Embarked, in_train, {RECODE_SQL} AS Title,
                  CASE WHEN age <= 16 THEN 0 WHEN age <= 32 THEN 1 WHEN age <= 48 THEN 2
                       WHEN age <= 64 THEN 3 ELSE 4 END AS Age,
                  CASE WHEN fare <= CAST(7.91 AS DOUBLE) THEN 0 WHEN fare <= CAST(14.454 AS DOUBLE) THEN 1
                       WHEN fare <= CAST(31 AS DOUBLE) THEN 2 ELSE 3 END AS Fare,
                  CASE WHEN family = 0 THEN 1 ELSE 0 END AS Alone FROM filled),
train AS (SELECT * FROM banded WHERE in_train)
SELECT PassengerId, Survived, Pclass, Age, Fare, Alone, Age * Pclass AS "Age*Class",
       e.i AS Embarked_indexed, t.i AS Title_indexed, s.i AS Sex_indexed
FROM banded b
LEFT JOIN {INDEX_SQL.format(c='Embarked')} e ON e.v = b.Embarked
LEFT JOIN {INDEX_SQL.format(c='Title')} t
  ON t.v = CASE WHEN b.Title IN (SELECT Title FROM train) THEN b.Title ELSE 'Rare' END
LEFT JOIN {INDEX_SQL.format(c='Sex')} s ON s.v = b.Sex""")
def tabular_prep_full(spark, sf_dir):
    """Preparation fitted on the training side and applied to all rows."""
    rows = passengers(spark, sf_dir)
    train, _ = hash_split(rows, F.col("PassengerId"), 70)
    return PassengerPrep().fit(train).transform(rows)
