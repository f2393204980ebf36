"""Headline queries on one machine; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. BENCH_FULL=1 adds the comparison
of seven learners over their whole grids (40 points, 3 folds) and the grids of the four ensembles
(5 folds).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from catalog import CATALOG  # noqa: E402
from catalog.frames import line_task  # noqa: E402
from tabquorum.operators import learners  # noqa: E402
from tabquorum.operators.ensemble import (BaggingClassifier, BoostingClassifier,  # noqa: E402
                                          GradientBoostingClassifier, StackingClassifier)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Results are consumed by the no-op sink, so every column of every row is computed.
QUERIES = ["tabular_prep_full", "impute_train_stats_on_test", "crosstab", "describe_typed",
           "group_mean_events", "string_index_orders", "string_index_many_values",
           "assemble_vector", "split_hash_70_30", "metric_f1", "metric_auc",
           "metric_auc_many_scores", "cv_metrics_rule", "vote_majority", "naive_bayes_predict",
           "decision_tree", "random_forest", "forest_100", "logistic_regression", "linear_svm",
           "boosted_trees", "boosted_trees_30", "bagging_stumps_replacement", "boosting_stumps",
           "gbm_stumps", "stacking_stumps"]


def ensembles():
    """The ensembles with ten members and the base learners of the comparison."""
    bases = [DecisionTreeClassifier(seed=learners.SEED), RandomForestClassifier(seed=learners.SEED)]
    return {
        "bagging_10_deep": BaggingClassifier(baseLearner=learners.deep_tree(), maxIter=10,
                                             parallelism=4),
        "boosting_10_deep": BoostingClassifier(baseLearner=learners.deep_tree(), maxIter=10),
        "gbm_10_rounds": GradientBoostingClassifier(baseLearner=learners.regression_tree(),
                                                    maxIter=10, parallelism=4),
        "stacking_2_bases": StackingClassifier(baseLearners=bases, stacker=learners.deep_tree(),
                                               parallelism=4, idCol="id"),
    }


def main() -> None:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
             .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", CPUS).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, run):
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)

    CATALOG["band_three"].run(spark, SF_DIR).collect()  # the first job pays for start-up
    for name in QUERIES:
        timed(name, lambda: CATALOG[name].run(spark, SF_DIR)
              .write.format("noop").mode("overwrite").save())
    task, fits = line_task(spark, SF_DIR), ensembles()
    for name, estimator in fits.items():
        timed(name, lambda: estimator.fit(task))
    if os.environ.get("BENCH_FULL") == "1":
        for name in ("leaderboard", "cv_bagging", "cv_boosting", "cv_gbm", "cv_stacking"):
            timed(name, lambda: CATALOG[name].run(spark, SF_DIR).collect())
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": SF_DIR.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
