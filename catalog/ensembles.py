"""The four ensembles end to end.

With one-split members on two integer features every step has a closed form, so the SQL
below derives the same members, weights and votes from sums over the whole table. The deep
members of the comparison have no such form and are checked in the tests.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import (DecisionTreeClassifier, NaiveBayes,
                                       RandomForestClassifier)
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from tabquorum.functions.hashing import member_seed
from tabquorum.operators import learners, metrics
from tabquorum.operators.ensemble import (BaggingClassifier, BoostingClassifier,
                                          GradientBoostingClassifier, StackingClassifier)
from tabquorum.operators.ensemble.gbm import LARGEST_STEP, STEP_PASSES, STEP_POINTS
from tabquorum.operators.splitting import hash_split
from tabquorum.sources import inline_table, schema_of

from .frames import LINES_SQL, hashed_sql, line_task, quality_task
from .registry import query

STUMP_FEATURES = ("x0", "x1")


def stump():
    """One split; enough bins that every distinct value of the features is a candidate."""
    return DecisionTreeClassifier(maxDepth=1, maxBins=64, seed=learners.SEED)


# --- one-split members in SQL ----------------------------------------------------------------

def side_sql(name: str) -> str:
    """Is a row on the left of the split of member ``name``?"""
    return f"CASE WHEN {name}.f = 0 THEN x0 ELSE x1 END <= {name}.v"


def class_stump_sql(name: str, source: str, weight: str, features: str = "0, 1") -> str:
    """Member ``name``: feature (of those given), cut, and majority class on both sides, by Gini impurity."""
    return f"""
{name}_cells AS (SELECT 0 AS f, x0 AS v, y, sum({weight}) AS w FROM {source} GROUP BY x0, y UNION ALL
                 SELECT 1, x1, y, sum({weight}) FROM {source} GROUP BY x1, y),
{name}_total AS (SELECT y, sum({weight}) AS w FROM {source} GROUP BY y),
{name}_cuts AS (SELECT DISTINCT f, v FROM {name}_cells c
                WHERE f IN ({features}) AND v < (SELECT max(v) FROM {name}_cells m WHERE m.f = c.f)),
{name}_sides AS (SELECT c.f, c.v, t.y, COALESCE(sum(e.w), 0) AS l, t.w - COALESCE(sum(e.w), 0) AS r
                 FROM {name}_cuts c CROSS JOIN {name}_total t
                 LEFT JOIN {name}_cells e ON e.f = c.f AND e.v <= c.v AND e.y = t.y
                 GROUP BY c.f, c.v, t.y, t.w),
{name} AS (SELECT f, v, arg_max(y, l) AS ly, arg_max(y, r) AS ry,
                  sum(l * l) / sum(l) + sum(r * r) / sum(r) AS purity
           FROM {name}_sides GROUP BY f, v ORDER BY purity DESC, f, v LIMIT 1)"""


def value_stump_sql(name: str, source: str, target: str) -> str:
    """Member ``name`` for a numeric target: least squares, means on both sides."""
    return f"""
{name}_cells AS (SELECT 0 AS f, x0 AS v, count(*) AS n, sum({target}) AS s FROM {source} GROUP BY x0 UNION ALL
                 SELECT 1, x1, count(*), sum({target}) FROM {source} GROUP BY x1),
{name}_run AS (SELECT f, v, sum(n) OVER (PARTITION BY f ORDER BY v) AS ln, sum(s) OVER (PARTITION BY f ORDER BY v) AS ls,
                      sum(n) OVER (PARTITION BY f) AS n, sum(s) OVER (PARTITION BY f) AS s FROM {name}_cells),
{name} AS (SELECT f, v, ls / ln AS lm, (s - ls) / (n - ln) AS rm FROM {name}_run WHERE ln < n
           ORDER BY ls * ls / ln + (s - ls) * (s - ls) / (n - ln) DESC, f, v LIMIT 1)"""


CELLS_SQL = """
SELECT CAST(y AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction, count(*) AS n
FROM predicted GROUP BY y, prediction"""


@query("decision_stump", f"""
WITH {LINES_SQL}, {class_stump_sql('t', 'lines', '1')},
predicted AS (SELECT y, CASE WHEN {side_sql('t')} THEN ly ELSE ry END AS prediction FROM lines, t)
{CELLS_SQL}""")
def decision_stump(spark, sf_dir):
    task = line_task(spark, sf_dir, STUMP_FEATURES)
    return metrics.confusion(stump().fit(task).transform(task))


# --- bagging ---------------------------------------------------------------------------------

BAG_RATIO, BAG_SEED, BAG_MEMBERS = 0.7, 11, 3


def poisson_sql(uniform: str, rate: float) -> str:
    reached = [sum(math.exp(-rate) * rate ** j / math.factorial(j) for j in range(k + 1))
               for k in range(12)]
    return " + ".join(f"CASE WHEN {uniform} >= {c!r} THEN 1 ELSE 0 END" for c in reached)


def bag_sql(sampled: str, spaces: list[str] | None = None) -> str:
    """Members on samples whose row counts are given by ``sampled`` with {u} for the uniform, each on all
    features or on its own."""
    u = "(h0 / 4294967296)"
    ctes = [LINES_SQL]
    for m in range(BAG_MEMBERS):
        hashed = hashed_sql("lines", "id", member_seed(BAG_SEED, m))
        ctes.append(f"s{m} AS MATERIALIZED (SELECT *, {sampled.format(u=u)} AS w FROM {hashed})")
        ctes.append(class_stump_sql(f"t{m}", f"(SELECT * FROM s{m} WHERE w > 0)", "w", spaces[m] if spaces else "0, 1"))
    votes = ", ".join(f"CASE WHEN {side_sql(f't{m}')} THEN t{m}.ly ELSE t{m}.ry END AS p{m}"
                      for m in range(BAG_MEMBERS))
    ctes.append(f"voted AS (SELECT y, {votes} FROM lines, t0, t1, t2)")
    ctes.append("""predicted AS (SELECT y, CASE WHEN p0 = p1 OR p0 = p2 THEN p0 WHEN p1 = p2 THEN p1
                                   ELSE least(p0, p1, p2) END AS prediction FROM voted)""")
    return "WITH " + ",\n".join(ctes) + CELLS_SQL


def stump_bag(replacement: bool, features: float = 1.0):
    return BaggingClassifier(baseLearner=stump(), maxIter=BAG_MEMBERS, sampleRatio=BAG_RATIO, replacement=replacement,
                             sampleRatioFeatures=features, parallelism=3, seed=BAG_SEED, idCol="id")


def bagged(spark, sf_dir, replacement: bool, features: float = 1.0):
    task = line_task(spark, sf_dir, STUMP_FEATURES)
    return metrics.confusion(stump_bag(replacement, features).fit(task).transform(task))


@query("bagging_stumps_replacement", bag_sql(poisson_sql("{u}", BAG_RATIO)))
def bagging_stumps_replacement(spark, sf_dir):
    """Three members on Poisson row samples, majority vote."""
    return bagged(spark, sf_dir, True)


@query("bagging_stumps_subset", bag_sql(f"CASE WHEN {{u}} < {BAG_RATIO} THEN 1 ELSE 0 END"))
def bagging_stumps_subset(spark, sf_dir):
    """Three members on row subsets without replacement."""
    return bagged(spark, sf_dir, False)


HALF = BaggingClassifier(sampleRatioFeatures=0.5, seed=BAG_SEED)
SPACES = [", ".join(map(str, HALF._subspace(m, len(STUMP_FEATURES)))) for m in range(BAG_MEMBERS)]


@query("bagging_stumps_subspace", bag_sql(poisson_sql("{u}", BAG_RATIO), SPACES))
def bagging_stumps_subspace(spark, sf_dir):
    """Three members on Poisson row samples, each on one of the two features."""
    return bagged(spark, sf_dir, True, 0.5)


# --- boosting --------------------------------------------------------------------------------

BOOST_ROUNDS, BOOST_RATE = 3, 0.8


def boost_ctes() -> str:
    ctes, source = [LINES_SQL], "lines"
    for m in range(BOOST_ROUNDS):
        weight = "1.0::DOUBLE" if m == 0 else "w"
        ctes.append(class_stump_sql(f"t{m}", source, weight))
        ctes.append(f"""g{m} AS (SELECT x0, x1, y, {weight} AS w,
                        CASE WHEN {side_sql(f't{m}')} THEN t{m}.ly ELSE t{m}.ry END <> y AS miss FROM {source}, t{m})""")
        ctes.append(f"e{m} AS (SELECT sum(w) FILTER (miss) / sum(w) AS error FROM g{m})")
        ctes.append(f"a{m} AS (SELECT error, {BOOST_RATE} * (ln((1 - error) / error) + ln(2)) AS say FROM e{m})")
        ctes.append(f"w{m} AS (SELECT x0, x1, y, CASE WHEN miss THEN w * exp(say) ELSE w END AS w FROM g{m}, a{m})")
        source = f"w{m}"
    return "WITH " + ",\n".join(ctes)


def boost_vote_sql(k: int) -> str:
    return " + ".join(
        f"CASE WHEN CASE WHEN {side_sql(f't{m}')} THEN t{m}.ly ELSE t{m}.ry END = {k} THEN a{m}.say ELSE 0 END"
        for m in range(BOOST_ROUNDS))


def boosted(spark, sf_dir):
    task = line_task(spark, sf_dir, STUMP_FEATURES)
    model = BoostingClassifier(baseLearner=stump(), maxIter=BOOST_ROUNDS,
                               learningRate=BOOST_RATE).fit(task)
    return model, task


@query("boosting_stumps", boost_ctes() + f""",
scores AS (SELECT y, {boost_vote_sql(0)} AS s0, {boost_vote_sql(1)} AS s1, {boost_vote_sql(2)} AS s2
           FROM lines, t0, t1, t2, a0, a1, a2),
predicted AS (SELECT y, CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END
                AS prediction FROM scores){CELLS_SQL}""")
def boosting_stumps(spark, sf_dir):
    """Three boosting rounds and their weighted vote."""
    model, task = boosted(spark, sf_dir)
    return metrics.confusion(model.transform(task))


@query("boosting_stumps_rounds", boost_ctes() + "\n" + " UNION ALL ".join(
    f"SELECT {m} AS round, round(error, 8) AS error, round(say, 8) AS say FROM a{m}"
    for m in range(BOOST_ROUNDS)))
def boosting_stumps_rounds(spark, sf_dir):
    """Weighted error and say of every round."""
    model, _ = boosted(spark, sf_dir)
    rows = [(m, round(e, 8), round(s, 8)) for m, (e, s) in enumerate(zip(model.errors, model.says))]
    return inline_table(spark, rows, schema_of(("round", "int"), ("error", "double"),
                                               ("say", "double")))


# --- gradient boosting -----------------------------------------------------------------------

GBM_ROUNDS, GBM_RATE = 2, 0.5


def gbm_sql() -> str:
    ctes = [LINES_SQL, """f0 AS (SELECT x0, x1, y, (SELECT ln(count(*) / (SELECT count(*) FROM lines)) FROM lines WHERE y = 0) AS s0,
             (SELECT ln(count(*) / (SELECT count(*) FROM lines)) FROM lines WHERE y = 1) AS s1,
             (SELECT ln(count(*) / (SELECT count(*) FROM lines)) FROM lines WHERE y = 2) AS s2 FROM lines)"""]
    for m in range(GBM_ROUNDS):
        shares = ", ".join(f"CASE WHEN y = {k} THEN 1 ELSE 0 END - exp(s{k}) / (exp(s0) + exp(s1) + exp(s2)) AS r{k}"
                           for k in range(3))
        ctes.append(f"r{m} AS (SELECT *, {shares} FROM f{m})")
        for k in range(3):
            ctes.append(value_stump_sql(f"t{m}{k}", f"r{m}", f"r{k}"))
        steps = ", ".join(
            f"s{k} + {GBM_RATE} * (2.0 / 3.0)::DOUBLE * CASE WHEN {side_sql(f't{m}{k}')} THEN t{m}{k}.lm ELSE t{m}{k}.rm END AS s{k}"
            for k in range(3))
        ctes.append(f"f{m + 1} AS (SELECT x0, x1, y, {steps} FROM f{m}, t{m}0, t{m}1, t{m}2)")
    ctes.append(f"""predicted AS (SELECT y, CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END
                    AS prediction, exp(s0) / (exp(s0) + exp(s1) + exp(s2)) AS p0 FROM f{GBM_ROUNDS})""")
    return "WITH " + ",\n".join(ctes) + """
SELECT CAST(y AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction, count(*) AS n,
       round(avg(p0), 8) AS mean_p0 FROM predicted GROUP BY y, prediction"""


@query("gbm_stumps", gbm_sql())
def gbm_stumps(spark, sf_dir):
    """Two rounds of three one-split regressors."""
    from pyspark.ml.functions import vector_to_array
    task = line_task(spark, sf_dir, STUMP_FEATURES)
    base = DecisionTreeRegressor(maxDepth=1, maxBins=64, seed=learners.SEED)
    model = GradientBoostingClassifier(baseLearner=base, maxIter=GBM_ROUNDS, parallelism=3,
                                       learningRate=GBM_RATE).fit(task)
    p0 = vector_to_array("probability")[0]
    return (model.transform(task).groupBy("label", "prediction")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(p0), 8).alias("mean_p0")))


STEP_ROUNDS, STEP_RATE = 2, 0.5


def step_search_sql(name: str, source: str, k: int) -> str:
    """CTE ``name`` with the step of class ``k``: the bracket of the slope's change of sign, cut into ten
    parts nine times. ``source`` has y, s0, s1, s2 and the regressors' outputs h0, h1, h2."""
    others = " + ".join(f"exp(s{j})" for j in range(3) if j != k)
    ctes = [f"{name}_cells AS (SELECT s{k} AS s, h{k} AS h, {others} AS others, CASE WHEN y = {k} THEN 1 ELSE 0 END AS own, count(*) AS n FROM {source} GROUP BY ALL)",
            f"{name}_0 AS (SELECT 0.0::DOUBLE AS low, {LARGEST_STEP}::DOUBLE AS high)"]
    for i in range(STEP_PASSES):
        ctes.append(f"""{name}_p{i} AS (SELECT j, any_value(low + (high - low) * j / {STEP_POINTS}) AS point,
            sum(n * (1 / (1 + others * exp(-(s + (low + (high - low) * j / {STEP_POINTS}) * h))) - own) * h) AS slope
            FROM {name}_cells, {name}_{i}, (SELECT unnest(range({STEP_POINTS + 1})) AS j) GROUP BY j)""")
        ctes.append(f"""{name}_{i + 1} AS (SELECT coalesce(CASE WHEN first = 0 THEN (SELECT point FROM {name}_p{i} WHERE j = 0) ELSE
              (SELECT point FROM {name}_p{i} WHERE j = first - 1) END, (SELECT max(point) FROM {name}_p{i})) AS low,
            coalesce((SELECT point FROM {name}_p{i} WHERE j = first), (SELECT max(point) FROM {name}_p{i})) AS high
            FROM (SELECT min(j) FILTER (slope >= 0) AS first FROM {name}_p{i}))""")
    return ",\n".join([*ctes, f"{name} AS (SELECT (low + high) / 2 AS step FROM {name}_{STEP_PASSES})"])


def step_weights_sql() -> str:
    ctes = [LINES_SQL, """f0 AS (SELECT x0, x1, y, (SELECT ln(count(*) / (SELECT count(*) FROM lines)) FROM lines WHERE y = 0) AS s0,
             (SELECT ln(count(*) / (SELECT count(*) FROM lines)) FROM lines WHERE y = 1) AS s1,
             (SELECT ln(count(*) / (SELECT count(*) FROM lines)) FROM lines WHERE y = 2) AS s2 FROM lines)"""]
    for m in range(STEP_ROUNDS):
        shares = ", ".join(f"CASE WHEN y = {k} THEN 1 ELSE 0 END - exp(s{k}) / (exp(s0) + exp(s1) + exp(s2)) AS r{k}" for k in range(3))
        ctes.append(f"r{m} AS (SELECT *, {shares} FROM f{m})")
        ctes += [value_stump_sql(f"t{m}{k}", f"r{m}", f"r{k}") for k in range(3)]
        outs = ", ".join(f"CASE WHEN {side_sql(f't{m}{k}')} THEN t{m}{k}.lm ELSE t{m}{k}.rm END AS h{k}" for k in range(3))
        ctes.append(f"h{m} AS MATERIALIZED (SELECT x0, x1, y, s0, s1, s2, {outs} FROM f{m}, t{m}0, t{m}1, t{m}2)")
        ctes += [step_search_sql(f"w{m}{k}", f"h{m}", k) for k in range(3)]
        moved = ", ".join(f"s{k} + {STEP_RATE} * w{m}{k}.step * h{k} AS s{k}" for k in range(3))
        ctes.append(f"f{m + 1} AS MATERIALIZED (SELECT x0, x1, y, {moved} FROM h{m}, w{m}0, w{m}1, w{m}2)")
    return "WITH " + ",\n".join(ctes) + "\n" + " UNION ALL ".join(
        f"SELECT {m} AS round, {k} AS class, round(step, 4) AS weight FROM w{m}{k}" for m in range(STEP_ROUNDS) for k in range(3))


@query("gbm_step_weights", step_weights_sql())
def gbm_step_weights(spark, sf_dir):
    """The searched step of every round and class, as rows."""
    task = line_task(spark, sf_dir, STUMP_FEATURES)
    base = DecisionTreeRegressor(maxDepth=1, maxBins=64, seed=learners.SEED)
    model = GradientBoostingClassifier(baseLearner=base, maxIter=STEP_ROUNDS, parallelism=3, learningRate=STEP_RATE,
                                       optimizedWeights=True).fit(task)
    rows = [(m, k, round(w, 4)) for m, weights in enumerate(model.weights) for k, w in enumerate(weights)]
    return inline_table(spark, rows, schema_of(("round", "int"), ("class", "int"), ("weight", "double")))


# --- stacking --------------------------------------------------------------------------------

STACK_SEED = 5


def bayes_sql(name: str, source: str) -> str:
    """Multinomial naive Bayes with smoothing 1 over two features: prior and likelihoods."""
    return f"""
{name} AS (SELECT y, ln(count(*) + 1) - ln((SELECT count(*) FROM {source}) + 3) AS pi,
                  ln(sum(x0) + 1) - ln(sum(x0) + sum(x1) + 2) AS th0,
                  ln(sum(x1) + 1) - ln(sum(x0) + sum(x1) + 2) AS th1 FROM {source} GROUP BY y)"""


def bayes_guess_sql(name: str) -> str:
    return f"(SELECT arg_max(b.y, b.pi + x0 * b.th0 + x1 * b.th1) FROM {name} b)"


def stack_sql() -> str:
    ctes = [LINES_SQL, f"folded AS MATERIALIZED (SELECT *, h0 % 2 AS fold FROM {hashed_sql('lines', 'id', STACK_SEED)})"]
    for f, rows in ((0, "fold <> 0"), (1, "fold <> 1"), (2, "true")):
        source = f"(SELECT * FROM folded WHERE {rows})"
        ctes.append(class_stump_sql(f"t{f}", source, "1"))
        ctes.append(bayes_sql(f"b{f}", source))

    def outputs(f: int, where: str) -> str:
        return (f"SELECT CASE WHEN {side_sql(f't{f}')} THEN t{f}.ly ELSE t{f}.ry END AS x0, "
                f"{bayes_guess_sql(f'b{f}')} AS x1, y FROM folded, t{f} WHERE {where}")
    ctes.append(f"meta AS MATERIALIZED ({outputs(0, 'fold = 0')} UNION ALL {outputs(1, 'fold = 1')})")
    ctes.append(class_stump_sql("top", "meta", "1"))
    ctes.append(f"final AS ({outputs(2, 'true')})")
    ctes.append(f"predicted AS (SELECT y, CASE WHEN {side_sql('top')} THEN ly ELSE ry END AS prediction FROM final, top)")
    return "WITH " + ",\n".join(ctes) + CELLS_SQL


@query("stacking_stumps", stack_sql())
def stacking_stumps(spark, sf_dir):
    """A tree and naive Bayes, stacked by a tree over their out-of-fold classes."""
    task = line_task(spark, sf_dir, STUMP_FEATURES)
    stack = StackingClassifier(baseLearners=[stump(), NaiveBayes(smoothing=1.0)], stacker=stump(),
                               numFolds=2, parallelism=4, seed=STACK_SEED, idCol="id")
    return metrics.confusion(stack.fit(task).transform(task))


# --- the ensembles of the comparison, on a hold-out ------------------------------------------

def held_out(estimator, spark, sf_dir):
    """Accuracy, error and F1 on the documents not used for fitting."""
    train, test = hash_split(quality_task(spark, sf_dir), F.col("doc_id"), 70)
    predicted = estimator.fit(train).transform(test)
    f1 = metrics.weighted_f1(predicted)
    return metrics.accuracy(predicted).join(f1, "n").select("accuracy", "error", "f1", "n")


def bag(**settings):
    return BaggingClassifier(baseLearner=learners.deep_tree(), maxIter=10, parallelism=4, idCol="doc_id", **settings)


def boost(**settings):
    return BoostingClassifier(baseLearner=learners.deep_tree(), maxIter=10, **settings)


def gradient(**settings):
    return GradientBoostingClassifier(baseLearner=learners.regression_tree(), maxIter=10, parallelism=4, **settings)


def stack():
    bases = [DecisionTreeClassifier(seed=learners.SEED), RandomForestClassifier(seed=learners.SEED)]
    return StackingClassifier(baseLearners=bases, stacker=learners.deep_tree(), parallelism=4, idCol="doc_id")


@query("bagging")
def bagging(spark, sf_dir):
    """Ten deep trees on row samples and most of the features."""
    return held_out(bag(sampleRatioFeatures=0.7), spark, sf_dir)


@query("boosting")
def boosting(spark, sf_dir):
    """Ten rounds of deep trees."""
    return held_out(boost(), spark, sf_dir)


@query("gbm")
def gbm(spark, sf_dir):
    """Ten rounds of regression trees."""
    return held_out(gradient(learningRate=1.0), spark, sf_dir)


@query("stacking")
def stacking(spark, sf_dir):
    """A tree and a forest, stacked by a deep tree."""
    return held_out(stack(), spark, sf_dir)
