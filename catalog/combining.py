"""How members are combined, checked on fixed rules over all of lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabquorum.functions import argmax_index, band, softmax, vote_scores
from tabquorum.operators.ensemble.boosting import member_say, reweighted, weighted_error
from tabquorum.operators.ensemble.gbm import class_shares, residuals

from .frames import LINES_SQL, line_rows
from .registry import query

RULES_SQL = f"""{LINES_SQL},
rules AS (SELECT id, y, CASE WHEN x0 <= 12 THEN 0 WHEN x0 <= 34 THEN 1 ELSE 2 END AS a,
                 CASE WHEN x1 <= 15 THEN 0 WHEN x1 <= 38 THEN 1 ELSE 2 END AS b,
                 CASE WHEN x0 + x1 <= 36 THEN 0 WHEN x0 + x1 <= 66 THEN 1 ELSE 2 END AS c FROM lines)"""


def rules(spark, sf_dir):
    """Three members that disagree often enough to give ties."""
    return line_rows(spark, sf_dir).select(
        "id", "label", band(F.col("x0"), (12, 34)).cast("double").alias("a"),
        band(F.col("x1"), (15, 38)).cast("double").alias("b"),
        band(F.col("x0") + F.col("x1"), (36, 66)).cast("double").alias("c"))


@query("vote_majority", f"""
WITH {RULES_SQL}
SELECT id, CAST(CASE WHEN a = b OR a = c THEN a WHEN b = c THEN b ELSE least(a, b, c) END AS DOUBLE)
  AS prediction FROM rules""")
def vote_majority(spark, sf_dir):
    """Most votes; the lowest class where all three differ."""
    votes = vote_scores([F.col("a"), F.col("b"), F.col("c")], 3)
    return rules(spark, sf_dir).select("id", argmax_index(votes).alias("prediction"))


def say_sql(k: int) -> str:
    return f"(CASE WHEN a = {k} THEN 1.0 ELSE 0 END + CASE WHEN b = {k} THEN 0.25 ELSE 0 END" \
           f" + CASE WHEN c = {k} THEN 0.5 ELSE 0 END)"


@query("vote_weighted", f"""
WITH {RULES_SQL},
scores AS (SELECT id, {say_sql(0)} AS s0, {say_sql(1)} AS s1, {say_sql(2)} AS s2 FROM rules)
SELECT id, CAST(CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END AS DOUBLE)
  AS prediction FROM scores""")
def vote_weighted(spark, sf_dir):
    """Votes with unequal say."""
    votes = vote_scores([F.col("a"), F.col("b"), F.col("c")], 3, [1.0, 0.25, 0.5])
    return rules(spark, sf_dir).select("id", argmax_index(votes).alias("prediction"))


@query("argmax_softmax", f"""
WITH {LINES_SQL},
raw AS (SELECT id, (25 - x0) / 10 AS s0, 0.5 AS s1, (x1 - 25) / 10 AS s2 FROM lines)
SELECT id, round(exp(s0) / (exp(s0) + exp(s1) + exp(s2)), 8) AS p0,
       round(exp(s1) / (exp(s0) + exp(s1) + exp(s2)), 8) AS p1,
       round(exp(s2) / (exp(s0) + exp(s1) + exp(s2)), 8) AS p2,
       CAST(CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END AS DOUBLE) AS prediction
FROM raw""")
def argmax_softmax(spark, sf_dir):
    scores = [(25 - F.col("x0")) / 10, F.lit(0.5), (F.col("x1") - 25) / 10]
    shares = [F.round(p, 8).alias(f"p{k}") for k, p in enumerate(softmax(scores))]
    return line_rows(spark, sf_dir).select(
        "id", *shares, argmax_index(F.array(*scores)).alias("prediction"))


@query("boosting_one_round", f"""
WITH {RULES_SQL},
e AS (SELECT avg(CASE WHEN y <> a THEN 1.0 ELSE 0.0 END) AS error FROM rules),
s AS (SELECT error, 0.8 * (ln((1 - error) / error) + ln(2)) AS say FROM e)
SELECT CAST(y AS DOUBLE) AS label, y <> a AS miss, round(any_value(error), 8) AS error,
       round(any_value(say), 8) AS say,
       round(sum(CASE WHEN y <> a THEN exp(say) ELSE 1.0 END / (1 - error + error * exp(say))), 4)
         AS weight
FROM rules, s GROUP BY y, y <> a""")
def boosting_one_round(spark, sf_dir):
    """Error, say and new weights of one boosting round with a rule as the member."""
    rows = rules(spark, sf_dir).withColumn("w", F.lit(1.0))
    error = weighted_error(rows, "label", "a", "w").first()["error"]
    say = member_say(error, 3, 0.8)
    scale = 1.0 / (1.0 - error + error * F.exp(F.lit(say)))
    new = reweighted("label", "a", "w", say, scale)
    return (rows.groupBy("label", (F.col("label") != F.col("a")).alias("miss"))
                .agg(F.round(F.sum(new), 4).alias("weight"))
                .withColumns({"error": F.round(F.lit(error), 8), "say": F.round(F.lit(say), 8)}))


@query("gbm_first_residuals", f"""
WITH {LINES_SQL},
shares AS (SELECT k, (SELECT count(*) FROM lines WHERE y = k) / (SELECT count(*) FROM lines) AS p
           FROM (SELECT unnest([0, 1, 2]) AS k))
SELECT k, CAST(y AS DOUBLE) AS label,
       round(sum(CASE WHEN y = k THEN 1 ELSE 0 END - p), 5) AS residual_sum,
       round(sum(power(CASE WHEN y = k THEN 1 ELSE 0 END - p, 2)), 5) AS residual_squares
FROM lines, shares GROUP BY k, y""")
def gbm_first_residuals(spark, sf_dir):
    """Class shares, their logarithms as scores, and the residuals per class and label."""
    rows = line_rows(spark, sf_dir).withColumn("w", F.lit(1.0))
    shares = class_shares(rows, "label", "w", 3).first()
    targets = residuals("label", [F.log(F.lit(s)) for s in shares])
    sums = [f(r).alias(f"{n}{k}") for k, r in enumerate(targets)
            for n, f in (("s", F.sum), ("q", lambda c: F.sum(c * c)))]
    per_label = rows.groupBy("label").agg(*sums)
    return per_label.select("label", F.inline(F.array(*[
        F.struct(F.lit(k).alias("k"), F.round(f"s{k}", 5).alias("residual_sum"),
                 F.round(f"q{k}", 5).alias("residual_squares")) for k in range(3)])))
