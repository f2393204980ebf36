"""Linear models and the network at their optimum, checked against Newton steps and forward passes."""

from __future__ import annotations

from pyspark.ml.classification import LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabquorum.operators import learners
from tabquorum.operators.certificates import (hinge_interval, hinge_objective, last_layer_gradient, logistic_gradient,
                                              network_scored)
from tabquorum.operators.encode import assembler
from tabquorum.sources import inline_table

from .ensembles import STUMP_FEATURES
from .frames import LINES_SQL, line_task, quality_task
from .registry import query

REG, NEWTON_STEPS, TOLERANCE = 0.01, 12, 1e-5


# --- logistic regression: three weights by Newton's method in SQL ------------------------------

def newton_sql(name: str, target: str) -> str:
    """CTE ``name`` with the weights b0 (intercept), b1, b2 that minimise the penalised mean loss."""
    ctes = [f"{name}_0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)"]
    for i in range(NEWTON_STEPS):
        ctes.append(f"""{name}_s{i} AS (
  SELECT b0, b1, b2, avg(p - t) AS g0, avg((p - t) * x0) + {REG} * b1 AS g1, avg((p - t) * x1) + {REG} * b2 AS g2,
         avg(p * (1 - p)) AS a, avg(p * (1 - p) * x0) AS b, avg(p * (1 - p) * x1) AS c,
         avg(p * (1 - p) * x0 * x0) + {REG} AS d, avg(p * (1 - p) * x0 * x1) AS e, avg(p * (1 - p) * x1 * x1) + {REG} AS f
  FROM (SELECT x0, x1, CASE WHEN {target} THEN 1.0 ELSE 0.0 END AS t, b0, b1, b2, 1 / (1 + exp(-(b0 + b1 * x0 + b2 * x1))) AS p
        FROM lines, {name}_{i}) GROUP BY b0, b1, b2)""")
        det = "(a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d))"
        ctes.append(f"""{name}_{i + 1} AS (SELECT
  b0 - ((d * f - e * e) * g0 + (c * e - b * f) * g1 + (b * e - c * d) * g2) / {det} AS b0,
  b1 - ((c * e - b * f) * g0 + (a * f - c * c) * g1 + (b * c - a * e) * g2) / {det} AS b1,
  b2 - ((b * e - c * d) * g0 + (b * c - a * e) * g1 + (a * d - b * b) * g2) / {det} AS b2 FROM {name}_s{i})""")
    ctes.append(f"{name} AS (SELECT * FROM {name}_{NEWTON_STEPS})")
    return ",\n".join(ctes)


def converged_logistic():
    return LogisticRegression(maxIter=500, tol=1e-12, regParam=REG, standardization=False)


def two_features(spark, sf_dir):
    return line_task(spark, sf_dir, STUMP_FEATURES)


@query("logistic_optimum", f"""WITH {LINES_SQL}, {newton_sql('m', 'y >= 1')}
SELECT unnest([0, 1, 2]) AS term, round(unnest([b0, b1, b2]), 4) AS weight, true AS at_optimum FROM m""")
def logistic_optimum(spark, sf_dir):
    """Weights of logistic regression at convergence, each with a gradient below the tolerance."""
    rows = two_features(spark, sf_dir).withColumn("label", (F.col("label") >= 1).cast("double"))
    model = converged_logistic().fit(rows)
    slopes = logistic_gradient(rows, model.coefficients, model.intercept, REG, standardised=False)
    weights = inline_table(spark, [(j, float(w)) for j, w in enumerate([model.intercept, *model.coefficients])], "term int, weight double")
    return slopes.join(weights, "term").select("term", F.round("weight", 4).alias("weight"),
                                               (F.abs("gradient") < TOLERANCE).alias("at_optimum"))


@query("one_vs_rest_optimum", f"""WITH {LINES_SQL},
{newton_sql('m0', 'y = 0')}, {newton_sql('m1', 'y = 1')}, {newton_sql('m2', 'y = 2')},
s AS (SELECT y, m0.b0 + m0.b1 * x0 + m0.b2 * x1 AS s0, m1.b0 + m1.b1 * x0 + m1.b2 * x1 AS s1, m2.b0 + m2.b1 * x0 + m2.b2 * x1 AS s2
      FROM lines, m0, m1, m2)
SELECT CAST(y AS DOUBLE) AS label, CAST(CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END AS DOUBLE) AS prediction,
       count(*) AS n FROM s GROUP BY ALL""")
def one_vs_rest_optimum(spark, sf_dir):
    """Three binary models at convergence, the largest score wins."""
    rows = two_features(spark, sf_dir)
    scored = OneVsRest(classifier=converged_logistic(), parallelism=3).fit(rows).transform(rows)
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


# --- support vector machine: the subgradients at the fitted weights hold zero -------------------

SVM_REG, SVM_SLACK, SVM_TOLERANCE = 0.1, 0.02, 0.02


@query("linear_svm_optimum", """SELECT unnest([0, 1, 2, 3, 4]) AS term, true AS at_optimum, true AS least_nearby""")
def linear_svm_optimum(spark, sf_dir):
    """Per weight: zero lies in its subgradients, and no step along it lowers the objective."""
    rows = line_task(spark, sf_dir, many_passes=True).withColumn("label", (F.col("label") >= 1).cast("double"))
    model = LinearSVC(maxIter=500, tol=1e-10, regParam=SVM_REG).fit(rows)
    weights, b = [float(c) for c in model.coefficients], float(model.intercept)
    between = hinge_interval(rows, weights, b, SVM_REG, slack=SVM_SLACK).select(
        "term", ((F.col("low") <= SVM_TOLERANCE) & (F.col("high") >= -SVM_TOLERANCE)).alias("at_optimum"))
    points = [(weights, b)]
    for j in range(len(weights) + 1):
        for step in (-0.05, 0.05):
            moved = [w + (step if j == k + 1 else 0.0) for k, w in enumerate(weights)]
            points.append((moved, b + (step if j == 0 else 0.0)))
    found = hinge_objective(rows, points, SVM_REG).select("point", "objective")
    least = found.where("point = 0").select(F.col("objective").alias("here"))
    nearby = found.where("point > 0").select(F.floor((F.col("point") - 1) / 2).cast("int").alias("term"), "objective").crossJoin(
        F.broadcast(least)).groupBy("term").agg((F.min(F.col("objective") - F.col("here")) >= -1e-9).alias("least_nearby"))
    return between.join(nearby, "term")


# --- the network, evaluated again as expressions -----------------------------------------------

@query("perceptron_forward", """SELECT count(*) AS n, CAST(0 AS BIGINT) AS mismatches, true AS shares_agree, true AS settled
FROM documents JOIN labels USING (doc_id)""")
def perceptron_forward(spark, sf_dir):
    """Forward pass of the fitted network over all labelled documents, and the slope of its loss."""
    rows = quality_task(spark, sf_dir)
    x = vector_to_array("features")
    scaled = rows.select("doc_id", "label", *[F.least(x[i] / top, F.lit(1.0)).alias(f"x{i}") for i, top in enumerate((20000.0, 4000.0, 1.0, 1.0))])
    rows = assembler(["x0", "x1", "x2", "x3"]).transform(scaled)
    layers = [4, 5, 4, 2]
    model = MultilayerPerceptronClassifier(layers=layers, blockSize=128, seed=1234, maxIter=100).fit(rows)
    weights = [float(w) for w in model.weights]
    scored = network_scored(model.transform(rows), weights, layers)
    slope = last_layer_gradient(scored, layers).select("n", (F.col("largest") < 0.05).alias("settled"))
    p = vector_to_array("probability")
    same = scored.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("told") != F.col("prediction")).alias("mismatches"),
                      (F.max(F.abs(p[0] - F.col("layer3")[0])) < 1e-9).alias("shares_agree"))
    return same.join(slope, "n")
