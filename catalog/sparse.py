"""Sparse text to forests: LibSVM lines with classes 2 and 4, a label map learned on training rows."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tabquorum.operators import learners, metrics
from tabquorum.operators.ranking import apply_index, decode_index, fit_index
from tabquorum.operators.splitting import hash_split
from tabquorum.sources import new_shared_path, read_libsvm

from .ensembles import STUMP_FEATURES
from .frames import LINES_SQL, hashed_sql, line_rows
from .registry import query
from .trees import BINS, grown_sql

DEPTH = 4

SPARSE_SQL = f"""{LINES_SQL},
coded AS (SELECT x0, x1, CASE WHEN y >= 1 THEN 4 ELSE 2 END AS code, h0 % 100 < 70 AS train FROM {hashed_sql('lines', 'id')}),
codes AS (SELECT code, row_number() OVER (ORDER BY count(*) DESC, code) - 1 AS y FROM coded WHERE train GROUP BY code),
learned AS (SELECT x0, x1, code, codes.y FROM coded JOIN codes USING (code) WHERE train)"""


def walked_sql(depth: int) -> str:
    """CTE ``scored``: the rows held out with the output (``guess``) of their leaf in the tree ``t``."""
    ctes = ["w_0 AS (SELECT x0, x1, code, 0 AS node FROM coded WHERE NOT train)"]
    for i in range(depth):
        ctes.append(f"""w_{i + 1} AS (SELECT r.* EXCLUDE (node), CASE WHEN b.f IS NULL THEN r.node
            WHEN CASE WHEN b.f = 0 THEN x0 ELSE x1 END <= b.v THEN 2 * r.node + 1 ELSE 2 * r.node + 2 END AS node
            FROM w_{i} r LEFT JOIN t_b{i} b ON b.node = r.node)""")
    return ",\n".join([*ctes, f"scored AS (SELECT code, guess FROM w_{depth} JOIN t_out USING (node))"])


def sparse_sides(spark, sf_dir):
    """Line items as LibSVM text (index:value, zeros left out), read back as sparse vectors: rows to
    learn from and rows held out."""
    out = []
    for part in hash_split(line_rows(spark, sf_dir), F.col("id"), 70):
        line = F.concat_ws(" ", F.when(F.col("label") >= 1, "4").otherwise("2"), *[
            F.when(F.col(x) != 0, F.concat(F.lit(f"{i + 1}:"), F.col(x).cast("int").cast("string"))) for i, x in enumerate(STUMP_FEATURES)])
        path = new_shared_path(spark, "libsvm")
        part.select(line.alias("value")).write.text(path)
        out.append(read_libsvm(spark, path, len(STUMP_FEATURES)))
    return out


@query("sparse_forest", f"""WITH {SPARSE_SQL}, {grown_sql('t', 'learned', DEPTH)}, {walked_sql(DEPTH)}
SELECT CAST(code AS DOUBLE) AS label, CAST(codes.code AS DOUBLE) AS prediction, count(*) AS n
FROM (SELECT code AS told, guess FROM scored) s JOIN codes ON codes.y = s.guess GROUP BY ALL""".replace(
    "SELECT CAST(code AS DOUBLE) AS label", "SELECT CAST(told AS DOUBLE) AS label"))
def sparse_forest(spark, sf_dir):
    """A forest on sparse vectors; classes 2 and 4 are indexed by a map fitted on the rows learned
    from, and predictions are led back through it."""
    train, test = sparse_sides(spark, sf_dir)
    index = fit_index(train, "label")
    forest = RandomForestClassifier(maxDepth=DEPTH, maxBins=BINS, numTrees=10, seed=learners.SEED, bootstrap=False,
                                    featureSubsetStrategy="all", labelCol="y")
    model = forest.fit(apply_index(train, index, "label", "y"))
    told = decode_index(model.transform(apply_index(test, index, "label", "y")), index, "prediction", "code")
    return metrics.confusion(told.withColumn("code", F.col("code").cast("double")), "label", "code")


@query("sparse_forest_regression", f"""WITH {SPARSE_SQL}, {grown_sql('t', 'learned', DEPTH, 'code')}, {walked_sql(DEPTH)}
SELECT round(avg((code - guess) * (code - guess)), 8) AS mse, count(*) AS n FROM scored""")
def sparse_forest_regression(spark, sf_dir):
    """Mean squared error of a regressing forest on the class numbers themselves."""
    train, test = sparse_sides(spark, sf_dir)
    forest = RandomForestRegressor(maxDepth=DEPTH, maxBins=BINS, numTrees=10, seed=learners.SEED, bootstrap=False,
                                   featureSubsetStrategy="all")
    return metrics.mean_squared_error(forest.fit(train).transform(test)).withColumn("mse", F.round("mse", 8))
