"""The whole comparisons: seven learners over 40 grid points, and the grids of the four ensembles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabquorum.operators import learners
from tabquorum.operators.splitting import hash_split
from tabquorum.plans import Comparison, param_grid
from tabquorum.sources import new_shared_path

from .ensembles import bag, boost, gradient, stack
from .frames import quality_task
from .registry import query

THREADS = 8


def seven_learners():
    made = {"Logistic Regression": learners.one_vs_rest(), "Support Vector Machine": learners.linear_svm(),
            "Naive Bayes": learners.naive_bayes(), "Decision Tree": learners.decision_tree(),
            "Random Forest": learners.random_forest(), "Perceptron": learners.perceptron(4),
            "Gradient Boost Tree": learners.boosted_trees()}
    return {name: (estimator, param_grid(grid)) for name, (estimator, grid) in made.items()}


def ensemble_grids():
    """(estimator, grid, metric) of each ensemble."""
    b, o, g = bag(), boost(), gradient()
    return {
        "bagging": (b, param_grid({b.sampleRatioFeatures: [0.3, 0.7, 1.0], b.replacementFeatures: [False],
                                   b.replacement: [True, False], b.sampleRatio: [0.3, 0.7, 1.0]}), "f1"),
        "boosting": (o, param_grid({o.learningRate: [0.3, 0.8, 1.0]}), "f1"),
        "gbm": (g, param_grid({g.learningRate: [0.1, 1.0], g.maxIter: [1, 10]}), "accuracy"),
        "stacking": (stack(), [{}], "f1"),
    }


def compared(spark, sf_dir, entrants, folds, metric):
    """A comparison on the labelled documents, run to its end."""
    train, test = hash_split(quality_task(spark, sf_dir), F.col("doc_id"), 70)
    comparison = Comparison(new_shared_path(spark, "comparison"), entrants, "doc_id", folds, metric, parallelism=THREADS)
    return comparison, comparison.run(train, test)


@query("leaderboard")
def model_leaderboard(spark, sf_dir):
    """Seven learners over their whole grids, three folds, scored on the documents held out."""
    return compared(spark, sf_dir, seven_learners(), 3, "accuracy")[1]


def grid_query(kind: str) -> None:
    def run(spark, sf_dir):
        estimator, grid, metric = ensemble_grids()[kind]
        comparison, _ = compared(spark, sf_dir, {kind: (estimator, grid)}, 5, metric)
        return comparison.points(spark).select("point", "metric", "std", "is_best")
    run.__doc__ = f"The whole grid of {kind} over five folds, and the chosen point."
    query(f"cv_{kind}")(run)


for _kind in ("bagging", "boosting", "gbm", "stacking"):
    grid_query(_kind)
