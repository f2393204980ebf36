"""Sources, views and inline rows."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tabquorum.functions import band
from tabquorum.sources import (inline_table, new_shared_path, read_csv_typed, read_libsvm,
                               schema_of, table)

from .registry import query


@query("scan_csv_typed", """
SELECT CAST(c_custkey AS INTEGER) AS PassengerId, c_name || ', Mr. "X"' AS Name,
       CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS Fare,
       CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS Embarked
FROM customer""")
def scan_csv_typed(spark, sf_dir):
    """Write customers as CSV, with quotes, commas, empty and unparsable cells; read back."""
    key = F.col("c_custkey")
    text = table(spark, sf_dir, "customer").select(
        key.alias("id"),
        F.concat("c_name", F.lit(', Mr. "X"')).alias("name"),
        F.when(key % 7 == 0, F.concat(key.cast("string"), F.lit("+2")))
         .otherwise(F.col("c_acctbal").cast("string")).alias("fare"),
        F.when(key % 5 != 0, F.col("c_mktsegment")).alias("port"))
    path = new_shared_path(spark, "csv")
    text.write.option("header", True).csv(path)
    schema = schema_of(("PassengerId", "int"), ("Name", "string"), ("Fare", "double"),
                       ("Embarked", "string"))
    return read_csv_typed(spark, path, schema)


@query("scan_libsvm", """
SELECT CAST(label AS DOUBLE) AS label,
       CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS position,
       CAST(unnest(embedding) AS DOUBLE) AS value
FROM embeddings""")
def scan_libsvm(spark, sf_dir):
    """Write embeddings as LibSVM text and read them back as vectors."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    width = table(spark, sf_dir, "embeddings").agg(F.max(F.size("embedding"))).first()[0]
    path = new_shared_path(spark, "libsvm")
    vectors.write.format("libsvm").save(path)
    return read_libsvm(spark, path, width).select(
        "label", F.posexplode(vector_to_array("features")).alias("position", "value"))


@query("temp_view_query", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 100000""")
def temp_view_query(spark, sf_dir):
    """Register a view and query it by name."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("order_view")
    return spark.sql("SELECT o_orderkey, o_orderstatus, o_totalprice FROM order_view "
                     "WHERE o_totalprice > 100000")


@query("inline_rows_sorted", """
SELECT b.Name AS Band, count(*) AS Orders, round(avg(o_totalprice), 4) AS Score
FROM orders JOIN (VALUES (0, 'low'), (1, 'middle'), (2, 'high'), (3, 'top')) b(Code, Name)
  ON b.Code = CASE WHEN o_totalprice <= 79100 THEN 0 WHEN o_totalprice <= 144540 THEN 1
                   WHEN o_totalprice <= 310000 THEN 2 ELSE 3 END
GROUP BY b.Name ORDER BY Score DESC""")
def inline_rows_sorted(spark, sf_dir):
    """Names given as rows in the program, attached to aggregated orders, sorted by score."""
    names = inline_table(spark, [(0, "low"), (1, "middle"), (2, "high"), (3, "top")],
                         schema_of(("Code", "int"), ("Band", "string")))
    sums = (table(spark, sf_dir, "orders")
            .groupBy(band(F.col("o_totalprice"), (79100, 144540, 310000)).alias("Code"))
            .agg(F.count(F.lit(1)).alias("Orders"), F.round(F.avg("o_totalprice"), 4).alias("Score")))
    # Four literal rows: their size is fixed by this program.
    return (sums.join(F.broadcast(names), "Code").select("Band", "Orders", "Score")
                .orderBy(F.desc("Score"), "Band"))
