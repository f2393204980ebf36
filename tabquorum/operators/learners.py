"""Spark's own learners with the parameters and grids the comparison uses."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
    MultilayerPerceptronClassifier, NaiveBayes, OneVsRest, RandomForestClassifier)
from pyspark.ml.param import Param
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor

Grid = Mapping[Param, list]

# PySpark's default seed is a string hash that changes with every Python process.
SEED = 42


def logistic() -> LogisticRegression:
    return LogisticRegression(maxIter=10, tol=1e-6, fitIntercept=True)


def one_vs_rest(parallelism: int = 1) -> tuple[OneVsRest, Grid]:
    inner = logistic()
    return (OneVsRest(classifier=inner, parallelism=parallelism), {inner.regParam: [0.1, 0.01]})


def linear_svm() -> tuple[LinearSVC, Grid]:
    svm = LinearSVC(maxIter=10, regParam=0.1)
    return svm, {svm.regParam: [0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5]}


def naive_bayes() -> tuple[NaiveBayes, Grid]:
    bayes = NaiveBayes()
    return bayes, {bayes.smoothing: [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]}


def decision_tree() -> tuple[DecisionTreeClassifier, Grid]:
    tree = DecisionTreeClassifier(seed=SEED)
    return tree, {tree.maxBins: [5, 7]}


def deep_tree() -> DecisionTreeClassifier:
    """Member of the bagging and boosting ensembles, and the stacker."""
    return DecisionTreeClassifier(maxDepth=20, maxBins=30, seed=SEED)


def random_forest() -> tuple[RandomForestClassifier, Grid]:
    forest = RandomForestClassifier(numTrees=10, seed=SEED)
    return forest, {forest.maxBins: [25, 28, 31], forest.maxDepth: [4, 6, 8],
                    forest.impurity: ["entropy", "gini"]}


def perceptron(inputs: int = 8, classes: int = 2) -> tuple[MultilayerPerceptronClassifier, Grid]:
    return MultilayerPerceptronClassifier(layers=[inputs, 5, 4, classes], blockSize=128,
                                          seed=1234, maxIter=100), {}


def boosted_trees() -> tuple[GBTClassifier, Grid]:
    trees = GBTClassifier(maxIter=10, featureSubsetStrategy="auto", seed=SEED)
    return trees, {trees.maxDepth: [2, 5], trees.maxIter: [10, 100]}


def forest_100() -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=100, featureSubsetStrategy="auto", impurity="gini",
                                  maxDepth=4, maxBins=32, seed=SEED)


def forest_100_regressor() -> RandomForestRegressor:
    return RandomForestRegressor(numTrees=100, featureSubsetStrategy="auto", maxDepth=4,
                                 maxBins=32, seed=SEED)


def boosted_trees_30() -> GBTClassifier:
    return GBTClassifier(maxIter=30, maxDepth=5, seed=SEED)


def boosted_trees_30_regressor() -> GBTRegressor:
    return GBTRegressor(maxIter=30, maxDepth=5, seed=SEED)


def regression_tree() -> DecisionTreeRegressor:
    return DecisionTreeRegressor(seed=SEED)
