"""Trees deeper than one split: grown again in SQL, and scored by walking their node tables.

On two features with few distinct values, and without sampling, a tree of any depth has a closed
form: SQL grows it level by level from grouped sums, and boosted trees round by round. Sampled
forests are checked through their node tables: a walk over all rows must give ``transform``'s rows.
"""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor,
                                   RandomForestRegressor)
from pyspark.sql import functions as F

from tabquorum.operators import learners, metrics
from tabquorum.operators.ensemble import BaggingClassifier, BoostingClassifier, GradientBoostingClassifier
from tabquorum.operators.splitting import hash_split
from tabquorum.operators.trees import structure_lines, table_scores, tree_header, tree_table, walked

from .ensembles import CELLS_SQL, STUMP_FEATURES
from .frames import LINES_SQL, line_task, quality_task
from .registry import query

BINS = 256      # more than the distinct values, so that every value is a candidate cut


# --- growth in SQL ---------------------------------------------------------------------------

def grown_sql(name: str, source: str, depth: int, target: str | None = None) -> str:
    """Rows of ``source`` with their leaf (``node``) in a tree of ``depth``, as the CTE ``name``, and
    its leaves' outputs as ``name``_out: least squares on ``target``, or Gini on classes y of 0..2."""
    sums = ({"s": f"sum({target})"} if target else {f"c{k}": f"count(*) FILTER (y = {k})" for k in range(3)})
    ctes = [f"{name}_0 AS (SELECT *, 0 AS node FROM {source})"]
    for i in range(depth):
        cells = ", ".join(f"{v} AS {k}" for k, v in sums.items())
        runs = ", ".join(f"sum({k}) OVER (PARTITION BY node, f ORDER BY v) AS l{k}, sum({k}) OVER (PARTITION BY node, f) AS t{k}"
                         for k in ["n", *sums])
        gain = " + ".join(f"l{k} * l{k} / ln + (t{k} - l{k}) * (t{k} - l{k}) / (tn - ln) - t{k} * t{k} / tn" for k in sums)
        ctes += [
            f"""{name}_c{i} AS (SELECT node, 0 AS f, x0 AS v, count(*)::DOUBLE AS n, {cells} FROM {name}_{i} GROUP BY node, x0 UNION ALL
                SELECT node, 1, x1, count(*)::DOUBLE, {cells} FROM {name}_{i} GROUP BY node, x1)""",
            f"{name}_r{i} AS (SELECT node, f, v, {runs} FROM {name}_c{i})",
            f"{name}_g{i} AS (SELECT node, f, v, {gain} AS gain FROM {name}_r{i} WHERE ln < tn)",
            f"""{name}_b{i} AS (SELECT node, f, v FROM {name}_g{i} WHERE gain > 1e-7
                QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 7) DESC, f, v) = 1)""",
            f"""{name}_{i + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node), CASE WHEN b.f IS NULL THEN r.node
                WHEN CASE WHEN b.f = 0 THEN x0 ELSE x1 END <= b.v THEN 2 * r.node + 1 ELSE 2 * r.node + 2 END AS node
                FROM {name}_{i} r LEFT JOIN {name}_b{i} b ON b.node = r.node)"""]
    value = f"avg({target})" if target else "arg_max(y, n)"
    leaves = (f"SELECT node, {value} AS guess FROM {name}_{depth} GROUP BY node" if target else
              f"SELECT node, {value} AS guess FROM (SELECT node, y, count(*) AS n FROM {name}_{depth} GROUP BY node, y) GROUP BY node")
    return ",\n".join([*ctes, f"{name} AS (SELECT * FROM {name}_{depth})", f"{name}_out AS ({leaves})"])


TREE_DEPTH = 5
TREE_SQL = f"""WITH {LINES_SQL}, {grown_sql('t', 'lines', TREE_DEPTH)},
predicted AS (SELECT y, guess AS prediction FROM t JOIN t_out USING (node)){CELLS_SQL}"""


@query("decision_tree_deep", TREE_SQL)
def decision_tree_deep(spark, sf_dir):
    """A tree of depth 5, every split of which SQL finds again."""
    task = line_task(spark, sf_dir, STUMP_FEATURES)
    tree = DecisionTreeClassifier(maxDepth=TREE_DEPTH, maxBins=BINS, seed=learners.SEED)
    return metrics.confusion(tree.fit(task).transform(task))


@query("forest_unsampled", TREE_SQL)
def forest_unsampled(spark, sf_dir):
    """A forest without sampling: its votes are those of the one tree SQL grows."""
    task = line_task(spark, sf_dir, STUMP_FEATURES)
    forest = RandomForestClassifier(maxDepth=TREE_DEPTH, maxBins=BINS, numTrees=10, seed=learners.SEED,
                                    bootstrap=False, featureSubsetStrategy="all")
    return metrics.confusion(forest.fit(task).transform(task))


# A target with few exact values: the discount in percent times the value band.
VALUE_SQL = f"{LINES_SQL}, valued AS (SELECT *, x2 * y + x3 AS t FROM lines)"


def value_task(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    whole = line_task(spark, sf_dir)
    x = vector_to_array("features")
    from tabquorum.operators.encode import assembler
    rows = whole.select("id", x[0].alias("x0"), x[1].alias("x1"), (x[2] * F.col("label") + x[3]).alias("label"))
    return assembler(STUMP_FEATURES).transform(rows).select("id", "features", "label")


def by_prediction(scored):
    """Rows, their mean target and squared error for each predicted value."""
    return scored.groupBy(F.round("prediction", 7).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("label"), 7).alias("mean"),
        F.round(F.avg(F.pow(F.col("label") - F.col("prediction"), 2)), 6).alias("mse"))


BY_PREDICTION_SQL = """
SELECT round(p, 7) AS prediction, count(*) AS n, round(avg(t), 7) AS mean, round(avg((t - p) * (t - p)), 6) AS mse
FROM predicted GROUP BY round(p, 7)"""
VALUE_TREE_SQL = f"""WITH {VALUE_SQL}, {grown_sql('t', 'valued', TREE_DEPTH, 't')},
predicted AS (SELECT t, guess AS p FROM t JOIN t_out USING (node)){BY_PREDICTION_SQL}""".replace("SELECT t, guess", "SELECT t.t, guess")


@query("regression_tree_deep", VALUE_TREE_SQL)
def regression_tree_deep(spark, sf_dir):
    """A regression tree of depth 5."""
    task = value_task(spark, sf_dir)
    tree = DecisionTreeRegressor(maxDepth=TREE_DEPTH, maxBins=BINS, seed=learners.SEED)
    return by_prediction(tree.fit(task).transform(task))


@query("forest_regressor_unsampled", VALUE_TREE_SQL)
def forest_regressor_unsampled(spark, sf_dir):
    """Mean of ten regression trees without sampling."""
    task = value_task(spark, sf_dir)
    forest = RandomForestRegressor(maxDepth=TREE_DEPTH, maxBins=BINS, numTrees=10, seed=learners.SEED,
                                   bootstrap=False, featureSubsetStrategy="all")
    return by_prediction(forest.fit(task).transform(task))


BOOST_TREES, BOOST_DEPTH, BOOST_STEP = 4, 3, 0.1


def boosted_trees_sql(source: str, start: str, residual: str) -> str:
    """CTEs up to ``f{BOOST_TREES}``: scores after a first tree on ``start`` and shrunken trees on residuals."""
    ctes = [f"f0 AS (SELECT *, 0.0::DOUBLE AS score, ({start})::DOUBLE AS target FROM {source})"]
    for m in range(BOOST_TREES):
        step = 1.0 if m == 0 else BOOST_STEP
        ctes += [grown_sql(f"m{m}", f"f{m}", BOOST_DEPTH, "target"),
                 f"""g{m} AS (SELECT m.* EXCLUDE (node, score, target), score + {step} * guess AS score
                     FROM m{m} m JOIN m{m}_out USING (node))""",
                 f"f{m + 1} AS MATERIALIZED (SELECT *, ({residual})::DOUBLE AS target FROM g{m})"]
    return ",\n".join(ctes)


@query("boosted_regressor_rounds", f"""WITH {VALUE_SQL},
{boosted_trees_sql('valued', 't', '2 * (t - score)')},
predicted AS (SELECT t, score AS p FROM f{BOOST_TREES}){BY_PREDICTION_SQL}""")
def boosted_regressor_rounds(spark, sf_dir):
    """Four boosted regression trees of depth 3."""
    task = value_task(spark, sf_dir)
    model = GBTRegressor(maxDepth=BOOST_DEPTH, maxBins=BINS, maxIter=BOOST_TREES, stepSize=BOOST_STEP, seed=learners.SEED)
    return by_prediction(model.fit(task).transform(task))


@query("boosted_trees_rounds", f"""WITH {LINES_SQL},
signed AS (SELECT *, CASE WHEN y >= 1 THEN 1 ELSE -1 END AS side FROM lines),
{boosted_trees_sql('signed', 'side', '4 * side / (1 + exp(2 * side * score))')}
SELECT CASE WHEN side > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS label, round(score, 7) AS margin,
       CASE WHEN score > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction, count(*) AS n
FROM f{BOOST_TREES} GROUP BY ALL""")
def boosted_trees_rounds(spark, sf_dir):
    """Four boosted trees of depth 3 for two classes, with their margins."""
    from pyspark.ml.functions import vector_to_array
    task = line_task(spark, sf_dir, STUMP_FEATURES).withColumn("label", (F.col("label") >= 1).cast("double"))
    model = GBTClassifier(maxDepth=BOOST_DEPTH, maxBins=BINS, maxIter=BOOST_TREES, stepSize=BOOST_STEP, seed=learners.SEED)
    scored = model.fit(task).transform(task)
    margin = F.round(vector_to_array("rawPrediction")[1], 7)
    return scored.groupBy("label", margin.alias("margin"), "prediction").agg(F.count(F.lit(1)).alias("n"))


# --- node tables of sampled models, walked over all rows ----------------------------------------

def walk_query(name: str, make, kind: str, task, keys: str, sql_rows: str, doc: str) -> None:
    def run(spark, sf_dir):
        rows = task(spark, sf_dir)
        model = make().fit(rows)
        nodes = tree_table(spark, model)
        walked_rows = table_scores(walked(rows, nodes, [keys]), [keys], kind, getattr(model, "start", ()))
        told = model.transform(rows).select(keys, F.col("prediction").alias("told"))
        differs = F.abs(F.col("told") - F.col("prediction")) > 1e-9 * (1 + F.abs(F.col("told")))
        return walked_rows.join(told, keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(differs).alias("mismatches"))
    run.__doc__ = doc
    query(name, f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS mismatches FROM {sql_rows}")(run)


def length_task(spark, sf_dir):
    return quality_task(spark, sf_dir).withColumn("label", F.col("doc_id") % 97 * 1.0)


DOCS_SQL = "documents JOIN labels USING (doc_id)"
for _name, _make, _kind in (
        ("decision_tree", lambda: DecisionTreeClassifier(maxDepth=5, seed=learners.SEED), "votes"),
        ("random_forest", lambda: learners.random_forest()[0], "votes"), ("forest_100", learners.forest_100, "votes"),
        ("boosted_trees", lambda: learners.boosted_trees()[0], "sign"), ("boosted_trees_30", learners.boosted_trees_30, "sign"),
        ("bagging", lambda: BaggingClassifier(baseLearner=learners.deep_tree(), maxIter=10, parallelism=4,
                                              sampleRatioFeatures=0.7, idCol="doc_id"), "ballots"),
        ("boosting", lambda: BoostingClassifier(baseLearner=learners.deep_tree(), maxIter=10), "ballots"),
        ("gbm", lambda: GradientBoostingClassifier(baseLearner=learners.regression_tree(), maxIter=10, learningRate=0.1,
                                                   parallelism=4), "classes")):
    walk_query(f"walk_{_name}", _make, _kind, quality_task, "doc_id", DOCS_SQL, f"The node table of {_name}, walked over all documents.")
for _name, _make, _kind in (("tree_regressor", learners.regression_tree, "mean"),
                            ("forest_regressor", learners.forest_100_regressor, "mean"),
                            ("boosted_regressor", learners.boosted_trees_30_regressor, "sum")):
    walk_query(f"walk_{_name}", _make, _kind, length_task, "doc_id", DOCS_SQL, f"The node table of {_name}, walked over all documents.")

def pruned_sql(name: str, depth: int) -> str:
    """Leaves of ``name`` with class counts, after leaves of one class under one parent are merged."""
    ctes = [f"""p0 AS (SELECT node, guess, count(*) FILTER (y = 0) AS c0, count(*) FILTER (y = 1) AS c1, count(*) FILTER (y = 2) AS c2
            FROM {name} JOIN {name}_out USING (node) GROUP BY node, guess)"""]
    for i in range(depth):
        ctes += [f"s{i} AS (SELECT (node - 1) // 2 AS up FROM p{i} WHERE node > 0 GROUP BY up HAVING count(*) = 2 AND min(guess) = max(guess))",
                 f"""p{i + 1} AS (SELECT CASE WHEN up IS NULL THEN node ELSE up END AS node, guess, sum(c0) AS c0, sum(c1) AS c1, sum(c2) AS c2
                 FROM p{i} LEFT JOIN s{i} ON (node - 1) // 2 = up AND node > 0 GROUP BY ALL)"""]
    return ",\n".join(ctes)


@query("tree_node_counts", f"""WITH {LINES_SQL}, {grown_sql('t', 'lines', 3)}, {pruned_sql('t', 3)}
SELECT CAST(c0 + c1 + c2 AS BIGINT) AS n, CAST(c0 AS DOUBLE) AS c0, CAST(c1 AS DOUBLE) AS c1, CAST(c2 AS DOUBLE) AS c2 FROM p3""")
def tree_node_counts(spark, sf_dir):
    """Rows and class counts of every leaf of a tree of depth 3, from its node table."""
    task = line_task(spark, sf_dir, STUMP_FEATURES)
    nodes = tree_table(spark, DecisionTreeClassifier(maxDepth=3, maxBins=BINS, seed=learners.SEED).fit(task))
    return nodes.where("left IS NULL").select(F.col("rows").alias("n"), *[F.get("stats", F.lit(k)).alias(f"c{k}") for k in range(3)])


@query("model_structure")
def model_structure(spark, sf_dir):
    """A fitted forest as text rows, its header first."""
    train, _ = hash_split(quality_task(spark, sf_dir), F.col("doc_id"), 70)
    model = learners.forest_100().fit(train)
    return structure_lines(tree_header(spark, model), tree_table(spark, model))
