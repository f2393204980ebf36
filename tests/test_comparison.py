"""Prefixes of boosted models, and a comparison that is cut off and resumed."""

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, NaiveBayes
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from tabquorum.operators.ensemble import BaggingClassifier, BoostingClassifier, GradientBoostingClassifier
from tabquorum.operators.metrics import accuracy, weighted_f1
from tabquorum.plans import Comparison, cross_validate, param_grid, prefix
from tabquorum.plans.comparison import fit_groups, fitted_points, passes, scores
from tabquorum.sources import exists, new_shared_path


def boosted(kind):
    return {"gbt": GBTClassifier(maxDepth=2, seed=1), "gbt_value": GBTRegressor(maxDepth=2, seed=1),
            "boosting": BoostingClassifier(baseLearner=DecisionTreeClassifier(maxDepth=2, seed=1)),
            "gbm": GradientBoostingClassifier(baseLearner=DecisionTreeRegressor(maxDepth=2, seed=1), learningRate=0.5)}[kind]


@pytest.fixture(scope="module")
def two(squares):
    return squares.withColumn("label", (F.col("label") > 0).cast("double"))


@pytest.mark.parametrize("kind", ["gbt", "gbt_value", "boosting", "gbm"])
def test_a_prefix_is_the_shorter_fit(two, kind):
    rows = two.select("id", "features", "label")
    told = lambda model: [r.prediction for r in model.transform(rows).orderBy("id").select("prediction").collect()]
    estimator = boosted(kind)
    long = estimator.copy({estimator.maxIter: 5}).fit(rows)
    for rounds in (1, 3):
        short = prefix(long, rounds)
        assert told(short) == told(estimator.copy({estimator.maxIter: rounds}).fit(rows))
    assert told(prefix(long, 99)) == told(long)


def test_prefix_needs_rounds(two):
    with pytest.raises(TypeError):
        prefix(NaiveBayes().fit(two), 1)


def test_points_that_differ_in_rounds_share_a_fit(two):
    gbt = boosted("gbt")
    grid = param_grid({gbt.maxDepth: [1, 2], gbt.maxIter: [1, 4]})
    assert sorted(map(sorted, fit_groups(gbt, grid))) == [[0, 1], [2, 3]]
    tree = DecisionTreeClassifier()
    assert fit_groups(tree, param_grid({tree.maxDepth: [1, 2]})) == [[0], [1]]
    for group in fit_groups(gbt, grid):
        models = fitted_points(gbt, grid, group, two)
        for metric, of in (("accuracy", accuracy), ("f1", weighted_f1)):
            for i, value in scores(models, two, "label", metric).items():
                alone = gbt.fit(two, dict(grid[i])).transform(two)
                assert value == pytest.approx(of(alone).first()[metric])


class Cut(Exception):
    pass


def test_a_cut_comparison_resumes_to_the_same_rows(spark, two):
    def entrants():
        gbt, tree, bayes = boosted("gbt"), DecisionTreeClassifier(seed=1), NaiveBayes()
        return {"Boosted": (gbt, param_grid({gbt.maxDepth: [1, 2], gbt.maxIter: [1, 3]})),
                "Tree": (tree, param_grid({tree.maxDepth: [1, 4]})), "Bayes": (bayes, [{}])}

    train, test = two.where("id % 4 <> 0"), two.where("id % 4 = 0")
    whole = Comparison(new_shared_path(spark, "comparison"), entrants(), "id", folds=2, parallelism=2)
    board = [tuple(r) for r in whole.run(train, test).collect()]
    assert whole.fits == (2 + 2 + 1) * 2 + 3      # four boosted points take two fits a fold

    def stop(done):
        if done == 5:
            raise Cut

    folder = new_shared_path(spark, "comparison")
    with pytest.raises(Cut):
        Comparison(folder, entrants(), "id", folds=2, after_fit=stop).run(train, test)
    again = Comparison(folder, entrants(), "id", folds=2)
    assert [tuple(r) for r in again.run(train, test).collect()] == board
    assert again.fits == whole.fits - 5
    ordered = lambda c: sorted(map(tuple, c.results(spark).collect()))
    assert ordered(again) == ordered(whole) and len(ordered(whole)) == (4 + 2 + 1) * 2
    done = Comparison(folder, entrants(), "id", folds=2)
    assert [tuple(r) for r in done.run(train, test).collect()] == board and done.fits == 0


def test_points_agree_with_cross_validation(spark, two):
    tree = DecisionTreeClassifier(seed=1)
    grid = param_grid({tree.maxDepth: [1, 2, 4]})
    mine = Comparison(new_shared_path(spark, "comparison"), {"Tree": (tree, grid)}, "id", folds=3, metric="f1")
    mine.run(two, two)
    theirs = cross_validate(tree, grid, two, metric="f1", folds=3, key="id")
    rows = mine.points(spark).orderBy("position").collect()
    assert [r.metric for r in rows] == pytest.approx(theirs.avgMetrics)
    assert [r.is_best for r in rows].index(True) == theirs.avgMetrics.index(max(theirs.avgMetrics))


def test_a_fit_reads_only_its_folds(spark, two):
    c = Comparison(new_shared_path(spark, "comparison"), {}, "id", folds=3)
    c._write_features(two, two)
    plan = c._rows(two, F.col("_fold") != 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_fold" in plan and c._rows(two).count() == two.count()


def test_long_fits_begin_first_and_last_fits_do_not_wait(spark, two):
    gbt, tree = boosted("gbt"), DecisionTreeClassifier(seed=1)
    entrants = {"Tree": (tree, param_grid({tree.maxDepth: [1, 4]})), "Boosted": (gbt, param_grid({gbt.maxDepth: [1], gbt.maxIter: [9]}))}
    assert passes(gbt, entrants["Boosted"][1][0]) == 9 and passes(tree, {tree.maxDepth: 4}) == 4
    folder, seen = new_shared_path(spark, "comparison"), []

    def look(done):
        there = lambda kind, n: exists(spark, f"{c._path(kind, n)}/_SUCCESS")
        seen.append((there("scores", "Boosted"), there("scores", "Tree")))

    c = Comparison(folder, entrants, "id", folds=2, after_fit=look)
    c.run(two, two)
    assert seen == [(False, False)] * 2 + [(True, False)] * 5 + [(True, True)]


def test_a_grid_of_bags_is_grown_by_one_fit_a_fold(spark, two, monkeypatch):
    bag = BaggingClassifier(baseLearner=DecisionTreeClassifier(maxDepth=3, seed=1), maxIter=2, idCol="id")
    grid = param_grid({bag.sampleRatio: [0.3, 0.7], bag.replacement: [True, False]})
    theirs = cross_validate(bag, grid, two, metric="f1", folds=2, key="id")
    seen, together, plain = [], [], BaggingClassifier._fit_together
    monkeypatch.setattr(DecisionTreeClassifier, "fit", lambda self, *rest: seen.append(self))
    monkeypatch.setattr(BaggingClassifier, "_fit_together", lambda self, points, df: together.append(len(points)) or plain(self, points, df))
    mine = Comparison(new_shared_path(spark, "comparison"), {"Bag": (bag, grid)}, "id", folds=2, metric="f1", parallelism=4)
    mine.run(two, two)
    assert seen == [] and sorted(together) == [1, 4, 4] and mine.fits == 2 * 4 + 1
    assert [r.metric for r in mine.points(spark).orderBy("position").collect()] == pytest.approx(theirs.avgMetrics)
