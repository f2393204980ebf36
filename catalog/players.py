"""The player flow: ratings of many columns, mean for missing ones, three bands, an ensemble on top."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabquorum.functions.fixed_values import OVERALL_EDGES, PLAYER_SKILLS
from tabquorum.operators import metrics
from tabquorum.operators.encode import vector_entries
from tabquorum.operators.splitting import hash_split
from tabquorum.plans import player_frame
from tabquorum.sources import table

from .ensembles import bag
from .registry import query

# Ratings derived from keys by rule, since no given table has them: skill i of a part is a mix of its key and size.
SKILL = "CAST((p_partkey * {a} + p_size * {b}) % 60 + 40 AS INTEGER)"


def skill(i: int) -> str:
    return SKILL.format(a=i + 3, b=i % 7 + 1)


def players(spark, sf_dir):
    """Player-shaped rows from parts; every ninth overall rating is missing."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id", "concat('Player ', p_partkey) AS Name", "CAST(p_partkey % 25 + 16 AS INT) AS Age", "p_type AS Nationality",
        "CASE WHEN p_partkey % 9 <> 0 THEN CAST(50 + p_size AS INT) END AS Overall", "CAST(p_size + 49 AS INT) AS Potential",
        "p_type AS Club", "CAST(p_partkey % 1000 AS INT) AS Value", *[f"{skill(i).replace('INTEGER', 'INT')} AS `{s}`" for i, s in enumerate(PLAYER_SKILLS)])


MEAN = "CAST(trunc((SELECT avg(50 + p_size) FROM part WHERE p_partkey % 9 <> 0)) AS INTEGER)"
BANDED = f"""SELECT p_partkey AS id, p_size, CASE WHEN o <= {OVERALL_EDGES[0]} THEN 0 WHEN o <= {OVERALL_EDGES[1]} THEN 1 ELSE 2 END AS band
FROM (SELECT *, CASE WHEN p_partkey % 9 <> 0 THEN 50 + p_size ELSE {MEAN} END AS o FROM part)"""


@query("player_features", f"""
WITH banded AS ({BANDED}), wide AS (SELECT id, band, [{', '.join(['p_partkey % 25 + 16', 'part.p_size + 49', 'p_partkey % 1000', *[skill(i).replace('p_size', 'part.p_size') for i in range(len(PLAYER_SKILLS))]])}] AS x
  FROM banded JOIN part ON p_partkey = id)
SELECT id, band, 0.5::DOUBLE AS weight, CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS position, CAST(unnest(x) AS DOUBLE) AS value FROM wide""")
def player_features(spark, sf_dir):
    """Prepared players: band, constant weight and every feature, in order."""
    rows = player_frame(players(spark, sf_dir))
    return vector_entries(rows, ["id", F.col("Overall").alias("band"), "weight"])


@query("player_bands", f"""
WITH banded AS ({BANDED}), ranks AS (SELECT band, row_number() OVER (ORDER BY count(*) DESC, CAST(band AS VARCHAR)) - 1 AS label FROM banded GROUP BY band)
SELECT band, CAST(label AS DOUBLE) AS label, count(*) AS n FROM banded JOIN ranks USING (band) GROUP BY ALL""")
def player_bands(spark, sf_dir):
    """Bands of the overall rating by their class index."""
    from tabquorum.operators.encode import label_indexer
    rows = player_frame(players(spark, sf_dir))
    return label_indexer("Overall").fit(rows).transform(rows).groupBy(F.col("Overall").alias("band"), "label").agg(F.count(F.lit(1)).alias("n"))


@query("player_bagging")
def player_bagging(spark, sf_dir):
    """Ten deep trees on weighted players, F1 and accuracy on the players held out."""
    from tabquorum.operators.encode import label_indexer
    rows = player_frame(players(spark, sf_dir))
    indexed = label_indexer("Overall").fit(rows).transform(rows).withColumnRenamed("id", "doc_id")
    train, test = hash_split(indexed, F.col("doc_id"), 70)
    told = bag(sampleRatioFeatures=0.7, weightCol="weight").fit(train).transform(test)
    return metrics.accuracy(told).join(metrics.weighted_f1(told), "n").select("accuracy", "f1", "n")
