"""Frequency indices and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabquorum.operators.encode import (assembler, chained, decode_prediction, label_indexer,
                                        string_indexer, vector_entries)
from tabquorum.operators.ranking import apply_index, decode_index, fit_index, frequency_index
from tabquorum.operators.splitting import hash_split
from tabquorum.sources import table

from .frames import hashed_sql
from .registry import query


def index_sql(source: str, key: str, column: str) -> str:
    return f"""
SELECT {key}, idx FROM {source} JOIN (
  SELECT {column} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({column} AS VARCHAR)) - 1
                             AS DOUBLE) AS idx
  FROM {source} GROUP BY {column}) ON v = {column}"""


@query("string_index_orders", index_sql("orders", "o_orderkey", "o_orderpriority"))
def string_index_orders(spark, sf_dir):
    """Priorities by frequency; equal counts are in text order."""
    orders = table(spark, sf_dir, "orders")
    indexed = string_indexer(["o_orderpriority"]).fit(orders).transform(orders)
    return indexed.select("o_orderkey", F.col("o_orderpriority_indexed").alias("idx"))


@query("string_index_parts", index_sql("part", "p_partkey", "p_type"))
def string_index_parts(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return frequency_index(parts, "p_type", "idx").select("p_partkey", "idx")


@query("string_index_many_values", index_sql("orders", "o_orderkey", "o_custkey"))
def string_index_many_values(spark, sf_dir):
    """More values than are broadcast: the rest go through the shuffled join."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return frequency_index(orders, "o_custkey", "idx", hot_labels=20).select(
        "o_orderkey", "idx")


@query("label_index_int", """
SELECT l_linenumber, i AS label, count(*) AS n FROM lineitem JOIN (
  SELECT l_linenumber AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(l_linenumber AS VARCHAR)) - 1
                                 AS DOUBLE) AS i
  FROM lineitem GROUP BY l_linenumber) ON v = l_linenumber
GROUP BY l_linenumber, i""")
def label_index_int(spark, sf_dir):
    """Classes of an int column by frequency, not by value."""
    lines = table(spark, sf_dir, "lineitem").select("l_linenumber")
    indexed = label_indexer("l_linenumber").fit(lines).transform(lines)
    return indexed.groupBy("l_linenumber", "label").agg(F.count(F.lit(1)).alias("n"))


@query("label_decode", """
SELECT CAST(l_linenumber AS VARCHAR) AS value, count(*) AS n FROM lineitem GROUP BY l_linenumber""")
def label_decode(spark, sf_dir):
    """Indices turned back into the values they stand for."""
    lines = table(spark, sf_dir, "lineitem").select("l_linenumber")
    model = label_indexer("l_linenumber").fit(lines)
    decoded = decode_prediction(model.transform(lines), model.labels, "label", "value")
    return decoded.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("assemble_vector", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, position, value FROM (
  SELECT *, 0 AS position, l_quantity AS value FROM lineitem UNION ALL
  SELECT *, 1, l_extendedprice FROM lineitem UNION ALL
  SELECT *, 2, l_discount FROM lineitem UNION ALL
  SELECT *, 3, CAST(l_linenumber AS DOUBLE) FROM lineitem)""")
def assemble_vector(spark, sf_dir):
    """A list of columns, in order, into one vector and back into rows."""
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]
    vectors = assembler(columns).transform(table(spark, sf_dir, "lineitem"))
    return vector_entries(vectors, keys)


@query("chained_stages", """
SELECT o_orderstatus, o_orderpriority, s.i AS status, p.i AS priority, count(*) AS n
FROM orders
JOIN (SELECT o_orderstatus AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) - 1 AS DOUBLE) AS i
      FROM orders GROUP BY o_orderstatus) s ON s.v = o_orderstatus
JOIN (SELECT o_orderpriority AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS DOUBLE) AS i
      FROM orders GROUP BY o_orderpriority) p ON p.v = o_orderpriority
GROUP BY ALL""")
def chained_stages(spark, sf_dir):
    """Indexing and assembling fitted and applied as one chain."""
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority")
    stages = chained(string_indexer(["o_orderstatus", "o_orderpriority"]),
                     assembler(["o_orderstatus_indexed", "o_orderpriority_indexed"]))
    out = stages.fit(orders).transform(orders)
    return (out.groupBy("o_orderstatus", "o_orderpriority",
                        F.col("o_orderstatus_indexed").alias("status"),
                        F.col("o_orderpriority_indexed").alias("priority"))
               .agg(F.count(F.lit(1)).alias("n")))


# --- an index fitted on training rows, applied to the others --------------------------------------

FIT_SQL = f"""sides AS (SELECT o_orderkey, o_custkey, h0 % 100 < 70 AS train FROM {hashed_sql('orders', 'o_orderkey')}),
fitted AS (SELECT o_custkey AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(o_custkey AS VARCHAR)) - 1 AS DOUBLE) AS position
           FROM sides WHERE train GROUP BY o_custkey)"""


def split_orders(spark, sf_dir):
    return hash_split(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("o_orderkey"), 70)


@query("index_keep_unseen", f"""WITH {FIT_SQL}
SELECT o_orderkey, coalesce(position, (SELECT CAST(count(*) AS DOUBLE) FROM fitted)) AS idx
FROM sides LEFT JOIN fitted ON v = o_custkey WHERE NOT train""")
def index_keep_unseen(spark, sf_dir):
    """Customers by their frequency in the training orders; new ones share one more position."""
    train, test = split_orders(spark, sf_dir)
    return apply_index(test, fit_index(train, "o_custkey"), "o_custkey", "idx", "keep", hot_labels=50).select("o_orderkey", "idx")


@query("index_skip_unseen", f"""WITH {FIT_SQL}
SELECT o_orderkey, position AS idx, CAST(o_custkey AS VARCHAR) AS customer FROM sides JOIN fitted ON v = o_custkey WHERE NOT train""")
def index_skip_unseen(spark, sf_dir):
    """The same without orders of new customers, and decoded again."""
    train, test = split_orders(spark, sf_dir)
    index = fit_index(train, "o_custkey")
    known = apply_index(test, index, "o_custkey", "idx", "skip", hot_labels=50)
    return decode_index(known, index, "idx", "customer", hot_labels=50).select("o_orderkey", "idx", "customer")
