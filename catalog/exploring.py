"""Aggregates used to look at data before modelling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabquorum.functions import text_shape
from tabquorum.operators import explore
from tabquorum.sources import table

from .frames import null_every
from .registry import query


@query("global_mean", "SELECT round(avg(value), 8) AS mean_value FROM events")
def global_mean(spark, sf_dir):
    return (explore.global_mean(table(spark, sf_dir, "events"), "value", "mean_value")
            .select(F.round("mean_value", 8).alias("mean_value")))


@query("group_mean_parts", """
SELECT p_type, round(avg(p_retailprice), 6) AS mean_price FROM part GROUP BY p_type
ORDER BY mean_price DESC""")
def group_mean_parts(spark, sf_dir):
    return (explore.group_mean(table(spark, sf_dir, "part"), "p_type", "p_retailprice",
                               "mean_price")
            .withColumn("mean_price", F.round("mean_price", 6)))


@query("group_mean_events", """
SELECT event_type, round(avg(value), 6) AS mean_value FROM events GROUP BY event_type
ORDER BY mean_value DESC""")
def group_mean_events(spark, sf_dir):
    return (explore.group_mean(table(spark, sf_dir, "events"), "event_type", "value", "mean_value")
            .withColumn("mean_value", F.round("mean_value", 6)))


@query("distinct_values", "SELECT DISTINCT c_mktsegment FROM customer")
def distinct_values(spark, sf_dir):
    return explore.distinct_values(table(spark, sf_dir, "customer"), "c_mktsegment")


@query("crosstab", """
WITH l AS (SELECT CASE WHEN l_orderkey % 7 <> 0 THEN l_returnflag END AS Title,
                  CASE WHEN l_orderkey % 11 <> 0 THEN l_linestatus END AS Sex FROM lineitem)
SELECT COALESCE(Title, 'null') AS Title_Sex, count(*) FILTER (Sex = 'F') AS F,
       count(*) FILTER (Sex = 'O') AS O, count(*) FILTER (Sex IS NULL) AS "null"
FROM l GROUP BY 1""")
def crosstab(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").select(
        null_every("l_orderkey", 7, F.col("l_returnflag")).alias("Title"),
        null_every("l_orderkey", 11, F.col("l_linestatus")).alias("Sex"))
    return explore.crosstab(pairs, "Title", "Sex")


@query("text_shapes", r"""
WITH split AS (SELECT doc_id, text, list_filter(string_split_regex(text, '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS words
               FROM documents)
SELECT doc_id, CAST(length(text) AS DOUBLE) AS text_chars, CAST(len(words) AS DOUBLE) AS text_words,
       CASE WHEN len(words) > 0 THEN round(len(list_distinct(words)) / len(words), 8)
            WHEN text IS NOT NULL THEN 0 END AS distinct_word_share,
       CASE WHEN length(text) > 0 THEN round(length(regexp_replace(text, '[^A-Za-z]', '', 'g')) / length(text), 8)
            ELSE 0 END AS letter_share
FROM split""")
def text_shapes(spark, sf_dir):
    """Words and letters of every document."""
    shapes = table(spark, sf_dir, "documents").select(
        "doc_id", *[c.alias(n) for n, c in text_shape(F.col("text")).items()])
    return shapes.withColumns({n: F.round(n, 8) for n in ("distinct_word_share", "letter_share")})


@query("describe_typed", """
SELECT 'value' AS field, count(value) AS n, round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS stddev, min(value) AS min, max(value) AS max,
       CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM events
UNION ALL
SELECT 'user_id', count(user_id), round(avg(user_id), 6), round(stddev_samp(user_id), 6),
       CAST(min(user_id) AS DOUBLE), CAST(max(user_id) AS DOUBLE), NULL, NULL FROM events
UNION ALL
SELECT 'event_type', count(event_type), NULL, NULL, NULL, NULL, min(event_type), max(event_type)
FROM events""")
def describe_typed(spark, sf_dir):
    stats = explore.describe_typed(table(spark, sf_dir, "events"),
                                   ["value", "user_id", "event_type"])
    return stats.withColumnRenamed("column", "field").withColumns(
        {"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


@query("correlation", """
SELECT 'l_quantity' AS "left", 'revenue' AS "right",
       round(corr(l_quantity, l_quantity * l_extendedprice), 8) AS corr FROM lineitem
UNION ALL
SELECT 'l_discount', 'l_tax', round(corr(l_discount, l_tax), 8) FROM lineitem""")
def correlation(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn(
        "revenue", F.col("l_quantity") * F.col("l_extendedprice"))
    return (explore.correlation(rows, [("l_quantity", "revenue"), ("l_discount", "l_tax")])
            .withColumn("corr", F.round("corr", 8)))
