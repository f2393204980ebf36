"""Metrics over rule predictions on all of lineitem, and grids of rules."""

from __future__ import annotations

from pyspark.ml.classification import NaiveBayes
from pyspark.sql import functions as F

from tabquorum.functions import band, hash_bucket
from tabquorum.operators import metrics
from tabquorum.operators.splitting import FOLD_SEED
from tabquorum.plans import cross_validate, cv_results, param_grid

from .frames import LINES_SQL, hashed_sql, line_rows, line_task
from .registry import query

# Two rules that are deliberately imperfect: quantity alone decides.
BINARY_SQL = f"""{LINES_SQL},
scored AS (SELECT id, x0 AS score, CASE WHEN y >= 1 THEN 1 ELSE 0 END AS label,
                  CASE WHEN x0 > 15 THEN 1 ELSE 0 END AS prediction FROM lines)"""
CLASSES_SQL = f"""{LINES_SQL},
scored AS (SELECT id, y AS label, CASE WHEN x0 <= 12 THEN 0 WHEN x0 <= 34 THEN 1 ELSE 2 END
             AS prediction FROM lines)"""


def binary(spark, sf_dir):
    return line_rows(spark, sf_dir).select(
        "id", F.col("x0").alias("score"), (F.col("label") >= 1).cast("double").alias("label"),
        (F.col("x0") > 15).cast("double").alias("prediction"))


def three_classes(spark, sf_dir):
    return line_rows(spark, sf_dir).select(
        "id", "label", band(F.col("x0"), (12, 34)).cast("double").alias("prediction"))


@query("metric_accuracy", f"""
WITH {BINARY_SQL}
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 10) AS accuracy,
       round(1.0 - avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 10) AS error, count(*) AS n
FROM scored""")
def metric_accuracy(spark, sf_dir):
    return metrics.accuracy(binary(spark, sf_dir)).withColumns(
        {c: F.round(c, 10) for c in ("accuracy", "error")})


@query("metric_test_error", f"""
WITH {CLASSES_SQL}
SELECT count(*) FILTER (label <> prediction) AS mismatches, count(*) AS n,
       round(count(*) FILTER (label <> prediction) / count(*), 10) AS test_error FROM scored""")
def metric_test_error(spark, sf_dir):
    return metrics.test_error(three_classes(spark, sf_dir)).withColumn(
        "test_error", F.round("test_error", 10))


@query("mismatching_rows", f"""
WITH {CLASSES_SQL}
SELECT id, CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction
FROM scored WHERE label <> prediction""")
def mismatching_rows(spark, sf_dir):
    return metrics.mismatches(three_classes(spark, sf_dir))


@query("metric_confusion", f"""
WITH {CLASSES_SQL}
SELECT CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction, count(*) AS n
FROM scored GROUP BY label, prediction""")
def metric_confusion(spark, sf_dir):
    return metrics.confusion(three_classes(spark, sf_dir))


@query("metric_f1", f"""
WITH {CLASSES_SQL},
per AS (SELECT c, (SELECT count(*) FROM scored WHERE label = c) AS l,
               (SELECT count(*) FROM scored WHERE prediction = c) AS p,
               (SELECT count(*) FROM scored WHERE label = c AND prediction = c) AS tp
        FROM (SELECT DISTINCT label AS c FROM scored))
SELECT round(sum(l * 2.0 * tp / (l + p)) / sum(l), 10) AS f1, CAST(sum(l) AS BIGINT) AS n FROM per""")
def metric_f1(spark, sf_dir):
    return metrics.weighted_f1(three_classes(spark, sf_dir)).withColumn("f1", F.round("f1", 10))


@query("metric_mse", f"""
WITH {LINES_SQL}
SELECT round(avg((l.y - (x0 / 25)) * (l.y - (x0 / 25))), 10) AS mse, count(*) AS n FROM lines l""")
def metric_mse(spark, sf_dir):
    rows = line_rows(spark, sf_dir).select("label", (F.col("x0") / 25).alias("prediction"))
    return metrics.mean_squared_error(rows).withColumn("mse", F.round("mse", 10))


@query("metric_auc", f"""
WITH {BINARY_SQL},
per AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
        FROM scored GROUP BY score),
ranked AS (SELECT *, COALESCE(sum(pos + neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                                   AND 1 PRECEDING), 0) + (pos + neg + 1) / 2 AS r
           FROM per)
SELECT round((sum(pos * r) - sum(pos) * (sum(pos) + 1) / 2) / (sum(pos) * sum(neg)), 10) AS auc,
       CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives FROM ranked""")
def metric_auc(spark, sf_dir):
    """Scores shared by many rows."""
    return metrics.area_under_roc(binary(spark, sf_dir)).withColumn("auc", F.round("auc", 10))


@query("metric_auc_many_scores", """
WITH scored AS (SELECT o_totalprice AS score, CASE WHEN o_orderkey % 1000 * 500 < o_totalprice
                                                   THEN 1 ELSE 0 END AS label FROM orders),
ranked AS (SELECT label, rank() OVER (ORDER BY score)
                         + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r FROM scored)
SELECT round((sum(r) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2)
             / (sum(label) * sum(1 - label)), 10) AS auc,
       CAST(sum(label) AS BIGINT) AS positives, CAST(sum(1 - label) AS BIGINT) AS negatives
FROM ranked""")
def metric_auc_many_scores(spark, sf_dir):
    """Almost every row its own score."""
    from tabquorum.sources import table
    price = F.col("o_totalprice")
    rows = table(spark, sf_dir, "orders").select(
        price.alias("score"),
        (F.col("o_orderkey") % 1000 * 500 < price).cast("double").alias("label"))
    return metrics.area_under_roc(rows).withColumn("auc", F.round("auc", 10))


# --- grids of rules: every point is one more aggregate column of the same single scan --------

LOWER, UPPER = (8, 12, 16), (30, 34)
GRID = [(a, b) for a in LOWER for b in UPPER]
GRID_SQL = f"""grid AS (
  SELECT a, b FROM (SELECT unnest({list(LOWER)}) AS a), (SELECT unnest({list(UPPER)}) AS b))"""
HIT_SQL = "CASE WHEN y = CASE WHEN x0 <= a THEN 0 WHEN x0 <= b THEN 1 ELSE 2 END THEN 1.0 ELSE 0.0 END"


def point_accuracies():
    """One accuracy per grid point, as columns ``p0``, ``p1``, ..."""
    return [F.avg((band(F.col("x0"), point) == F.col("label")).cast("double")).alias(f"p{i}")
            for i, point in enumerate(GRID)]


def point_rows():
    """The columns of ``point_accuracies`` as one row per grid point."""
    return F.inline(F.array(*[
        F.struct(F.concat_ws(",", F.lit(f"lower={a}"), F.lit(f"upper={b}")).alias("point"),
                 F.lit(i).alias("position"), F.col(f"p{i}").alias("accuracy"))
        for i, (a, b) in enumerate(GRID)]))


@query("param_grid_scores", f"""
WITH {LINES_SQL}, {GRID_SQL}
SELECT 'lower=' || a || ',upper=' || b AS point, round(avg({HIT_SQL}), 10) AS accuracy
FROM lines, grid GROUP BY a, b""")
def param_grid_scores(spark, sf_dir):
    """All combinations of two parameters, each point scored on the whole table."""
    return (line_rows(spark, sf_dir).agg(*point_accuracies()).select(point_rows())
            .select("point", F.round("accuracy", 10).alias("accuracy")))


SMOOTHING = (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)
BAYES_FOLDS = 3


@query("cv_naive_bayes", f"""
WITH {LINES_SQL},
folded AS MATERIALIZED (SELECT row_number() OVER () AS r, x0, x1, x2, x3, y, h0 % {BAYES_FOLDS} AS fold FROM {hashed_sql('lines', 'id', FOLD_SEED)}),
points AS (SELECT unnest({list(SMOOTHING)})::DOUBLE AS s, unnest({[f"smoothing={s}" for s in SMOOTHING]}) AS point),
sums AS (SELECT f.fold, y, count(*) AS n, sum(x0) AS s0, sum(x1) AS s1, sum(x2) AS s2, sum(x3) AS s3
         FROM (SELECT unnest(range({BAYES_FOLDS})) AS fold) f JOIN folded d ON d.fold <> f.fold GROUP BY f.fold, y),
fitted AS (SELECT fold, s, point, y, ln(n + s) - ln(sum(n) OVER (PARTITION BY fold, s) + 3 * s) AS pi,
                  ln(s0 + s) - ln(s0 + s1 + s2 + s3 + 4 * s) AS t0, ln(s1 + s) - ln(s0 + s1 + s2 + s3 + 4 * s) AS t1,
                  ln(s2 + s) - ln(s0 + s1 + s2 + s3 + 4 * s) AS t2, ln(s3 + s) - ln(s0 + s1 + s2 + s3 + 4 * s) AS t3
           FROM sums, points),
guessed AS (SELECT f.fold, f.s, f.point, d.r, d.y, arg_max(f.y, pi + x0 * t0 + x1 * t1 + x2 * t2 + x3 * t3) AS guess
            FROM folded d JOIN fitted f ON f.fold = d.fold GROUP BY f.fold, f.s, f.point, d.r, d.y),
scored AS (SELECT s, point, fold, avg(CASE WHEN y = guess THEN 1.0 ELSE 0.0 END) AS a FROM guessed GROUP BY s, point, fold),
means AS (SELECT s, point, round(avg(a), 10) AS metric FROM scored GROUP BY s, point)
SELECT point, metric, row_number() OVER (ORDER BY metric DESC, s) = 1 AS is_best FROM means""")
def cv_naive_bayes(spark, sf_dir):
    """A grid, three hash folds and the chosen point, through the tuning plans."""
    bayes = NaiveBayes()
    model = cross_validate(bayes, param_grid({bayes.smoothing: SMOOTHING}), line_task(spark, sf_dir),
                           metric="accuracy", folds=BAYES_FOLDS, key="id", parallelism=4)
    return cv_results(spark, model).select("point", F.round("metric", 10).alias("metric"), "is_best")


@query("cv_metrics_rule", f"""
WITH {LINES_SQL}, {GRID_SQL},
folds AS (SELECT a, b, h0 % 5 AS fold, avg({HIT_SQL}) AS accuracy
          FROM {hashed_sql('lines', 'id')}, grid GROUP BY ALL),
means AS (SELECT a, b, avg(accuracy) AS metric FROM folds GROUP BY a, b)
SELECT 'lower=' || a || ',upper=' || b AS point, round(metric, 10) AS metric,
       row_number() OVER (ORDER BY metric DESC, a, b) = 1 AS is_best
FROM means""")
def cv_metrics_rule(spark, sf_dir):
    """Mean over folds per grid point, and the first point with the largest mean."""
    per_fold = (line_rows(spark, sf_dir)
                .groupBy(hash_bucket(F.col("id"), 5).alias("fold")).agg(*point_accuracies()))
    means = per_fold.agg(*[F.avg(f"p{i}").alias(f"p{i}") for i in range(len(GRID))])
    top = F.greatest(*[F.col(f"p{i}") for i in range(len(GRID))])
    first = F.array_position(F.array(*[F.col(f"p{i}") for i in range(len(GRID))]), top) - 1
    return (means.withColumn("best", first).select("best", point_rows())
            .select("point", F.round("accuracy", 10).alias("metric"),
                    (F.col("position") == F.col("best")).alias("is_best")))
