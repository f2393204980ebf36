"""Node tables of fitted trees, scored by walking them."""

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tabquorum.operators.ensemble import BaggingClassifier, BoostingClassifier, GradientBoostingClassifier
from tabquorum.operators.trees import structure_lines, table_scores, tree_header, tree_table, walked


@pytest.fixture(scope="module")
def two(squares):
    return squares.withColumn("label", (F.col("label") > 0).cast("double")).cache()


MODELS = {
    "tree": (lambda: DecisionTreeClassifier(maxDepth=5, seed=1), "votes"),
    "forest": (lambda: RandomForestClassifier(numTrees=7, maxDepth=4, seed=1), "votes"),
    "regression tree": (lambda: DecisionTreeRegressor(maxDepth=5, seed=1), "mean"),
    "regression forest": (lambda: RandomForestRegressor(numTrees=7, seed=1), "mean"),
    "boosted": (lambda: GBTClassifier(maxIter=5, maxDepth=3, seed=1), "sign"),
    "boosted values": (lambda: GBTRegressor(maxIter=5, maxDepth=3, seed=1), "sum"),
    "bag": (lambda: BaggingClassifier(baseLearner=DecisionTreeClassifier(maxDepth=4, seed=1), maxIter=5, sampleRatioFeatures=0.5,
                                      sampleRatio=0.5, idCol="id"), "ballots"),
    "boosting": (lambda: BoostingClassifier(baseLearner=DecisionTreeClassifier(maxDepth=2, seed=1), maxIter=4), "ballots"),
    "gbm": (lambda: GradientBoostingClassifier(baseLearner=DecisionTreeRegressor(maxDepth=2, seed=1), maxIter=3, learningRate=0.5), "classes"),
}


@pytest.mark.parametrize("name", MODELS)
def test_walking_the_table_is_transform(spark, two, squares, name):
    make, kind = MODELS[name]
    rows = squares if name in ("tree", "forest", "bag", "boosting", "gbm") else two
    model = make().fit(rows)
    told = {r.id: r.prediction for r in model.transform(rows).select("id", "prediction").collect()}
    got = table_scores(walked(rows, tree_table(spark, model), ["id"]), ["id"], kind, getattr(model, "start", ()))
    assert {r.id: r.prediction for r in got.collect()} == pytest.approx(told)


def test_categories_lead_left(spark, squares):
    """Splits on categorical features list the values that go left."""
    rows = squares.withColumn("label", (F.col("a") % 3 == 1).cast("double"))
    indexed = VectorIndexer(inputCol="features", outputCol="coded", maxCategories=18).fit(rows).transform(rows)
    model = DecisionTreeClassifier(featuresCol="coded", maxDepth=4, maxBins=32, seed=1).fit(indexed)
    nodes = tree_table(spark, model)
    assert nodes.where("categories IS NOT NULL AND threshold IS NULL").count() > 0
    told = {r.id: r.prediction for r in model.transform(indexed).select("id", "prediction").collect()}
    got = table_scores(walked(indexed, nodes, ["id"], "coded"), ["id"], "votes")
    assert {r.id: r.prediction for r in got.collect()} == told


def test_a_tree_that_is_one_leaf(spark, two):
    rows = two.where("label = 1")
    nodes = tree_table(spark, DecisionTreeClassifier(seed=1).fit(rows))
    assert [(r.node, r.left, r.depth, r.rows) for r in nodes.collect()] == [(0, None, 0, rows.count())]
    got = table_scores(walked(rows, nodes, ["id"]), ["id"], "votes")
    assert {r.prediction for r in got.collect()} == {1.0} and got.count() == rows.count()


def test_structure_has_a_header_and_every_node(spark, squares):
    model = MODELS["forest"][0]().fit(squares)
    header, nodes = tree_header(spark, model), tree_table(spark, model)
    lines = structure_lines(header, nodes).collect()
    assert lines[0].tree is None and "trees=7 classes=3 features=2" in lines[0].text
    assert len(lines) == 1 + nodes.count() == 1 + sum(t.numNodes for t in model.trees)
    inner = [r.text for r in lines[1:] if r.text.startswith("if")]
    assert len(inner) == nodes.where("left IS NOT NULL").count() and all(" then " in t for t in inner)
    assert tree_header(spark, MODELS["gbm"][0]().fit(squares)).first().trees == 9


def test_leaves_hold_the_rows_that_reach_them(spark, squares):
    nodes = tree_table(spark, DecisionTreeClassifier(maxDepth=5, seed=1).fit(squares))
    leaves = nodes.where("left IS NULL")
    assert leaves.agg(F.sum("rows")).first()[0] == squares.count() == nodes.where("node = 0").first().rows
    assert all(sum(r.stats) == r.rows for r in leaves.collect())


def test_unknown_kind(spark, two):
    nodes = tree_table(spark, DecisionTreeClassifier(maxDepth=1, seed=1).fit(two))
    with pytest.raises(ValueError):
        table_scores(walked(two, nodes, ["id"]), ["id"], "other")
