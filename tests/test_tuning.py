import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabquorum.operators import learners
from tabquorum.operators.ensemble import BaggingClassifier, GradientBoostingClassifier
from tabquorum.operators.splitting import with_fold
from tabquorum.plans import (best_point, cross_validate, cross_validated_score, cv_results,
                             fit_predict, leaderboard, param_grid)
from tabquorum.plans.tuning import FOLD, class_totals, evaluator


def test_grid_is_the_product_and_empty_is_one_point():
    tree = DecisionTreeClassifier()
    points = param_grid({tree.maxDepth: [1, 2], tree.impurity: ["gini", "entropy"]})
    assert len(points) == 4 and len({tuple(sorted((p.name, v) for p, v in x.items())) for x in points}) == 4
    assert param_grid({}) == [{}]


def test_cross_validation_picks_the_better_depth(spark, squares):
    tree = DecisionTreeClassifier(seed=1)
    model = cross_validate(tree, param_grid({tree.maxDepth: [1, 5]}), squares, metric="accuracy",
                           folds=3, key="id", parallelism=2)
    rows = cv_results(spark, model).collect()
    assert [r.point for r in rows] == ["maxDepth=1", "maxDepth=5"]
    assert [r.is_best for r in rows] == [False, True] and best_point(model) == 1
    assert model.bestModel.getOrDefault("maxDepth") == 5


def test_grid_over_ensemble_and_member(squares):
    base = DecisionTreeClassifier(seed=1)
    bag = BaggingClassifier(baseLearner=base, maxIter=2, idCol="id")
    grid = param_grid({bag.sampleRatio: [0.5, 1.0], base.maxDepth: [1, 4]})
    model = cross_validate(bag, grid, squares, metric="f1", folds=2, key="id", parallelism=4)
    assert len(model.avgMetrics) == 4 and max(model.avgMetrics[1], model.avgMetrics[3]) == max(model.avgMetrics)
    assert model.bestModel.getSampleRatio() in (0.5, 1.0)


def test_gbm_grid_and_chosen_values(squares):
    gbm = GradientBoostingClassifier(baseLearner=learners.regression_tree(), parallelism=3)
    grid = param_grid({gbm.learningRate: [0.1, 1.0], gbm.maxIter: [1, 2]})
    model = cross_validate(gbm, grid, squares, metric="accuracy", folds=2, key="id", parallelism=2)
    assert model.bestModel.getLearningRate() in (0.1, 1.0)
    assert len(model.bestModel.weights) == model.bestModel.getMaxIter()


def test_score_fit_predict_and_leaderboard(spark, squares):
    train, test = squares.where("id % 3 <> 0"), squares.where("id % 3 = 0")
    score, model = cross_validated_score(DecisionTreeClassifier(seed=1), [{}], train, test, folds=2)
    direct = fit_predict(DecisionTreeClassifier(seed=1), train, test)
    hits = direct.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert score == pytest.approx(hits) and len(model.avgMetrics) == 1
    board = leaderboard(spark, {"a": 0.5, "c": 0.9, "b": 0.9})
    assert [r.Model for r in board.collect()] == ["b", "c", "a"]
    assert board.schema == T.StructType([T.StructField("Model", T.StringType()),
                                         T.StructField("Score", T.DoubleType(), False)])


def test_grids_have_the_documented_sizes():
    sizes = [len(param_grid(g)) for _, g in (
        learners.one_vs_rest(), learners.linear_svm(), learners.naive_bayes(),
        learners.decision_tree(), learners.random_forest(), learners.perceptron(),
        learners.boosted_trees())]
    assert sizes == [2, 7, 6, 2, 18, 1, 4] and sum(sizes) == 40


def test_naive_bayes_points_share_one_pass(squares, monkeypatch):
    """Each fit sees two rows a class, and gives what Spark's own cross-validation gives."""
    from pyspark.ml.classification import NaiveBayes
    bayes, seen, plain = NaiveBayes(), [], NaiveBayes.fit
    grid = param_grid({bayes.smoothing: [0.0, 0.5, 1.0]})
    monkeypatch.setattr(NaiveBayes, "fit", lambda self, df, *rest: seen.append(df.count()) or plain(self, df, *rest))
    model = cross_validate(bayes, grid, squares, metric="accuracy", folds=3, key="id", parallelism=2)
    assert len(seen) == 10 and max(seen) <= 6
    folded, theirs = with_fold(squares, F.col("id"), 3), []
    for fold in range(3):
        train, rest = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
        theirs.append([evaluator("accuracy").evaluate(plain(bayes, train, point).transform(rest)) for point in grid])
    assert model.avgMetrics == pytest.approx([sum(x) / 3 for x in zip(*theirs)])
    whole = plain(bayes, squares, grid[best_point(model)])
    assert model.bestModel.pi.toArray() == pytest.approx(whole.pi.toArray())
    assert model.bestModel.theta.toArray() == pytest.approx(whole.theta.toArray())
    assert not model.bestModel.isDefined(model.bestModel.weightCol)


def test_folds_without_rows_and_negative_features_are_told(spark, squares):
    from pyspark.ml.classification import NaiveBayes
    with pytest.raises(ValueError, match="is empty"):
        cross_validate(NaiveBayes(), [{}], squares.where("id = 3"), metric="accuracy", folds=2, key="id")
    below = squares.select("id", "label", array_to_vector(F.array(F.lit(-1.0), F.lit(2.0))).alias("features"))
    assert class_totals(with_fold(below, F.col("id"), 2, FOLD), "label", "features") is None
    with pytest.raises(Exception):
        cross_validate(NaiveBayes(), [{}], below, metric="accuracy", folds=2, key="id")
