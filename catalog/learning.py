"""Spark's learners: parameters where they have a closed form, hold-out scores elsewhere."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes, OneVsRest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabquorum.operators import learners, metrics
from tabquorum.operators.splitting import hash_split
from tabquorum.plans import fit_predict
from tabquorum.sources import dealt, inline_table, schema_of

from .frames import LINE_FEATURES, LINES_SQL, line_task, quality_task
from .registry import query

# --- naive Bayes, which is grouped sums -------------------------------------------------------

BAYES_SQL = f"""{LINES_SQL},
long AS (SELECT y, 0 AS j, x0 AS v FROM lines UNION ALL SELECT y, 1, x1 FROM lines UNION ALL
         SELECT y, 2, x2 FROM lines UNION ALL SELECT y, 3, x3 FROM lines),
pi AS (SELECT y, ln(count(*) + 1) - ln((SELECT count(*) FROM lines) + 3) AS pi FROM lines GROUP BY y),
theta AS (SELECT y, j, ln(sum(v) + 1) - ln(sum(sum(v)) OVER (PARTITION BY y) + 4) AS theta
          FROM long GROUP BY y, j)"""


@query("naive_bayes_params", f"""
WITH {BAYES_SQL}
SELECT CAST(y AS INTEGER) AS class, j AS feature, round(pi, 6) AS pi, round(theta, 6) AS theta
FROM theta JOIN pi USING (y)""")
def naive_bayes_params(spark, sf_dir):
    model = NaiveBayes(smoothing=1.0).fit(line_task(spark, sf_dir))
    rows = [(k, j, round(float(model.pi[k]), 6), round(float(model.theta[k, j]), 6))
            for k in range(3) for j in range(len(LINE_FEATURES))]
    return inline_table(spark, rows, schema_of(("class", "int"), ("feature", "int"),
                                               ("pi", "double"), ("theta", "double")))


@query("naive_bayes_predict", f"""
WITH {BAYES_SQL},
wide AS (SELECT y, any_value(pi) AS pi, max(theta) FILTER (j = 0) AS t0, max(theta) FILTER (j = 1) AS t1,
                max(theta) FILTER (j = 2) AS t2, max(theta) FILTER (j = 3) AS t3
         FROM theta JOIN pi USING (y) GROUP BY y),
guessed AS (SELECT l.y, (SELECT arg_max(w.y, w.pi + x0 * t0 + x1 * t1 + x2 * t2 + x3 * t3) FROM wide w)
              AS prediction FROM lines l)
SELECT CAST(y AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction, count(*) AS n
FROM guessed GROUP BY y, prediction""")
def naive_bayes_predict(spark, sf_dir):
    task = line_task(spark, sf_dir)
    return metrics.confusion(fit_predict(NaiveBayes(smoothing=1.0), task, task))


# --- classifiers on a hold-out ----------------------------------------------------------------

def split(spark, sf_dir):
    return hash_split(quality_task(spark, sf_dir), F.col("doc_id"), 70)


def classifier_query(name: str, make, doc: str):
    def run(spark, sf_dir):
        train, test = split(spark, sf_dir)
        return metrics.accuracy(fit_predict(make(), train, test))
    run.__doc__ = doc
    query(name)(run)


classifier_query("logistic_regression", learners.logistic, "Logistic regression.")
classifier_query("one_vs_rest", lambda: OneVsRest(classifier=learners.logistic()),
                 "One binary model per class.")
classifier_query("linear_svm", lambda: learners.linear_svm()[0], "Linear support vector machine.")
classifier_query("decision_tree", lambda: learners.decision_tree()[0], "Decision tree.")
classifier_query("random_forest", lambda: learners.random_forest()[0], "Ten trees.")
classifier_query("forest_100", learners.forest_100, "A hundred trees of depth 4.")
classifier_query("perceptron", lambda: learners.perceptron(4)[0], "Two hidden layers.")
classifier_query("boosted_trees", lambda: learners.boosted_trees()[0], "Ten boosted trees.")
classifier_query("boosted_trees_30", learners.boosted_trees_30, "Thirty boosted trees of depth 5.")


# --- regressors: the length of a document from its other measures -----------------------------

def regressor_query(name: str, make, doc: str):
    def run(spark, sf_dir):
        from tabquorum.functions import text_shape
        from tabquorum.sources import table
        docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
        shaped = docs.select("doc_id", F.col("n_chars").cast("double").alias("label"),
                             *[c.alias(n) for n, c in text_shape(F.col("text")).items()])
        rows = VectorAssembler(inputCols=["text_words", "distinct_word_share", "letter_share"],
                               outputCol="features").transform(shaped)
        train, test = hash_split(dealt(rows.select("doc_id", "label", "features"), "doc_id"),
                                 F.col("doc_id"), 70)
        return metrics.mean_squared_error(fit_predict(make(), train, test))
    run.__doc__ = doc
    query(name)(run)


regressor_query("forest_regressor", learners.forest_100_regressor, "Mean of a hundred trees.")
regressor_query("boosted_regressor", learners.boosted_trees_30_regressor, "Thirty boosted trees.")
regressor_query("tree_regressor", learners.regression_tree, "One regression tree.")


@query("fit_predict")
def fit_predict_rows(spark, sf_dir):
    """Predictions for every held-out document."""
    train, test = split(spark, sf_dir)
    return fit_predict(DecisionTreeClassifier(maxDepth=4, seed=learners.SEED), train, test).select(
        "doc_id", "label", "prediction")
