import math

import numpy as np
import pytest
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from tabquorum.operators.ensemble import bagging, gbm, grown
from tabquorum.operators.ensemble import (BaggingClassifier, BoostingClassifier,
                                          GradientBoostingClassifier, StackingClassifier)
from tabquorum.operators.ensemble.common import class_count, configured
from tabquorum.sources import new_shared_path, shared_root


def tree(depth=3):
    return DecisionTreeClassifier(maxDepth=depth, seed=1)


def classes(df):
    return [r.prediction for r in df.orderBy("id").select("prediction").collect()]


def accuracy(df):
    return df.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


# --- bagging -------------------------------------------------------------------------------

def test_a_bag_of_one_whole_member_is_the_member(squares):
    bag = BaggingClassifier(baseLearner=tree(), maxIter=1, replacement=False)
    assert classes(bag.fit(squares).transform(squares)) == classes(tree().fit(squares).transform(squares))


@pytest.mark.parametrize("id_col", ["id", None])
@pytest.mark.parametrize("features", [1.0, 0.5])
def test_bag_repeats_under_its_seed(squares, id_col, features):
    def run(seed):
        bag = BaggingClassifier(baseLearner=tree(5), maxIter=3, sampleRatio=0.3, seed=seed,
                                sampleRatioFeatures=features, parallelism=3, idCol=id_col)
        return classes(bag.fit(squares).transform(squares))
    assert run(1) == run(1)
    assert run(1) != run(2)


def test_bag_with_id_ignores_the_partitioning(squares):
    bag = BaggingClassifier(baseLearner=tree(), maxIter=3, sampleRatio=0.5, idCol="id")
    one, other = bag.fit(squares.repartition(7)), bag.fit(squares.coalesce(1))
    assert classes(one.transform(squares)) == classes(other.transform(squares))


def test_bag_votes_shares_and_columns(squares):
    model = BaggingClassifier(baseLearner=tree(), maxIter=5, sampleRatio=0.3,
                              sampleRatioFeatures=0.5, idCol="id", parallelism=4).fit(squares)
    out = model.transform(squares)
    assert out.columns == [*squares.columns, "prediction", "rawPrediction", "probability"]
    row = out.select(vector_to_array("rawPrediction").alias("v"),
                     vector_to_array("probability").alias("p")).first()
    assert sum(row.v) == 5 and sum(row.p) == pytest.approx(1.0)
    assert [len(s) for s in model.subspaces] == [1] * 5
    assert (model.getSampleRatio(), model.getReplacement(), model.getSampleRatioFeatures(),
            model.getReplacementFeatures()) == (0.3, True, 0.5, False)


def test_bag_of_a_learner_without_weights_repeats_rows(squares):
    net = MultilayerPerceptronClassifier(layers=[2, 3], maxIter=15, seed=1)
    out = BaggingClassifier(baseLearner=net, maxIter=2, idCol="id").fit(squares).transform(squares)
    assert set(classes(out)) <= {0.0, 1.0, 2.0}
    with pytest.raises(ValueError):
        BaggingClassifier(baseLearner=net, weightCol="a").fit(squares)


def test_feature_draws_with_replacement_are_distinct(squares):
    bag = BaggingClassifier(baseLearner=tree(), replacementFeatures=True, sampleRatioFeatures=1.0)
    for member in range(20):
        space = bag._subspace(member, 6)
        assert space == sorted(set(space)) and 1 <= len(space) <= 6


def test_bag_of_other_learners(squares):
    bag = BaggingClassifier(baseLearner=NaiveBayes(), maxIter=2, idCol="id", parallelism=2)
    assert accuracy(bag.fit(squares).transform(squares)) > 0.3


# --- boosting ------------------------------------------------------------------------------

def test_one_round_of_boosting_is_the_base(squares):
    model = BoostingClassifier(baseLearner=tree(), maxIter=1).fit(squares)
    assert classes(model.transform(squares)) == classes(tree().fit(squares).transform(squares))


def test_boosting_beats_its_base_and_follows_samme(squares):
    base = accuracy(tree(2).fit(squares).transform(squares))
    model = BoostingClassifier(baseLearner=tree(2), maxIter=6, learningRate=0.8).fit(squares)
    assert accuracy(model.transform(squares)) > base
    assert model.errors[0] == pytest.approx(1 - base)
    for error, say in zip(model.errors, model.says):
        assert say == pytest.approx(0.8 * (math.log((1 - error) / error) + math.log(2)))


def test_boosting_is_the_same_with_written_snapshots(squares):
    def run(interval):
        model = BoostingClassifier(baseLearner=tree(2), maxIter=5, checkpointInterval=interval).fit(squares)
        return model.errors
    assert run(1) == pytest.approx(run(0))
    assert run(2) == pytest.approx(run(0))


def test_boosting_stops_at_a_perfect_member(squares):
    model = BoostingClassifier(baseLearner=tree(12), maxIter=5).fit(squares)
    assert len(model.members) == 1 and model.errors == [0.0]
    assert accuracy(model.transform(squares)) == 1.0


def test_boosting_keeps_a_first_member_no_better_than_guessing(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(i, Vectors.dense(1.0), float(i % 2)) for i in range(10)]
    frame = spark.createDataFrame(rows, ["id", "features", "label"])
    model = BoostingClassifier(baseLearner=tree(), maxIter=3).fit(frame)
    assert len(model.members) == 1 and set(classes(model.transform(frame))) == {0.0}


def test_boosting_uses_and_needs_weights(squares):
    weighted = squares.withColumn("w", F.when(F.col("label") == 2, 50.0).otherwise(1.0))
    model = BoostingClassifier(baseLearner=tree(1), maxIter=1, weightCol="w").fit(weighted)
    hits = model.transform(weighted).where("label = 2").agg(F.avg((F.col("prediction") == 2).cast("double")))
    assert hits.first()[0] == 1.0
    with pytest.raises(ValueError):
        BoostingClassifier(baseLearner=MultilayerPerceptronClassifier(layers=[2, 3])).fit(squares)


# --- gradient boosting ---------------------------------------------------------------------

def log_loss(df):
    p = F.element_at(vector_to_array("probability"), (F.col("label") + 1).cast("int"))
    return df.agg(F.avg(-F.log(p))).first()[0]


@pytest.mark.parametrize("optimized", [False, True])
def test_gbm_loss_falls_with_every_round(squares, optimized):
    losses = []
    for rounds in (1, 3):
        model = GradientBoostingClassifier(
            baseLearner=DecisionTreeRegressor(maxDepth=2, seed=1), maxIter=rounds, parallelism=3,
            learningRate=0.5, optimizedWeights=optimized, checkpointInterval=2).fit(squares)
        losses.append(log_loss(model.transform(squares)))
        assert len(model.weights) == rounds and all(len(w) == 3 for w in model.weights)
    assert losses == sorted(losses, reverse=True)
    assert losses[0] < 1.1


def test_gbm_is_the_same_with_written_snapshots(squares):
    def run(interval):
        model = GradientBoostingClassifier(
            baseLearner=DecisionTreeRegressor(maxDepth=2, seed=1), maxIter=3, learningRate=1.0,
            checkpointInterval=interval).fit(squares)
        return log_loss(model.transform(squares))
    assert run(1) == pytest.approx(run(0), abs=1e-9)


def test_gbm_with_a_class_absent_from_the_rows(squares):
    marked = squares.where("label < 2").withMetadata("label", {"ml_attr": {"vals": ["x", "y", "z"]}})
    model = GradientBoostingClassifier(baseLearner=DecisionTreeRegressor(maxDepth=2, seed=1),
                                       maxIter=2, learningRate=1.0).fit(marked)
    assert model.numClasses == 3 and accuracy(model.transform(marked)) > 0.8


# --- stacking ------------------------------------------------------------------------------

@pytest.mark.parametrize("method", ["class", "probability"])
def test_stacking(squares, method):
    stack = StackingClassifier(baseLearners=[tree(2), LogisticRegression(maxIter=5)], stacker=tree(3),
                               parallelism=4, stackMethod=method, idCol="id", numFolds=2)
    model = stack.fit(squares)
    out = model.transform(squares)
    assert out.columns == [*squares.columns, "prediction"] and accuracy(out) > 0.6
    assert classes(stack.fit(squares.repartition(5)).transform(squares)) == classes(out)


def test_stacker_rows_come_from_models_that_did_not_see_them(squares, monkeypatch):
    """Every fold fit must be on rows of the other folds only."""
    from tabquorum.functions import hash_word
    from tabquorum.operators.ensemble import stacking
    seen = []
    real = stacking.with_meta

    def spy(df, models, method, features):
        folds = {r[0] for r in df.select(hash_word(F.col("_key"), 0, 4) % 2).distinct().collect()} \
            if "_key" in df.columns else None
        seen.append((folds, [m.uid for m in models], df.count()))
        return real(df, models, method, features)
    monkeypatch.setattr(stacking, "with_meta", spy)
    stack = StackingClassifier(baseLearners=[tree(2)], stacker=tree(2), numFolds=2, idCol="id", seed=4)
    fitted = {}
    base_fit = DecisionTreeClassifier.fit

    def fit(self, rows, params=None):
        model = base_fit(self, rows, params)
        if "_key" in rows.columns:
            fitted[id(model)] = {r[0] for r in rows.select(hash_word(F.col("_key"), 0, 4) % 2).distinct().collect()}
            seen.append(("fit", fitted[id(model)], rows.count()))
        return model
    monkeypatch.setattr(DecisionTreeClassifier, "fit", fit)
    stack.fit(squares)
    fits = [s for s in seen if s[0] == "fit"]
    uses = [s for s in seen if s[0] != "fit"]
    assert [f[1] for f in fits] == [{1}, {0}, {0, 1}]
    assert [u[0] for u in uses] == [{0}, {1}]
    assert sum(u[2] for u in uses) == squares.count()
    assert squares.select(hash_word(F.col("id"), 0, 4) % 2).distinct().count() == 2


def test_stacking_rejects_unknown_settings(squares):
    for bad in ({"stackMethod": "other"}, {"numFolds": 1}):
        with pytest.raises(ValueError):
            StackingClassifier(baseLearners=[tree()], stacker=tree(), **bad).fit(squares)


# --- common --------------------------------------------------------------------------------

def test_class_count_prefers_metadata(squares):
    assert class_count(squares, "label") == 3
    assert class_count(squares.where("label = 0"), "label") == 2
    marked = squares.withMetadata("label", {"ml_attr": {"vals": list("abcd")}})
    assert class_count(marked, "label") == 4


def test_copy_reaches_the_nested_learner(squares):
    base = tree(2)
    bag = BaggingClassifier(baseLearner=base, maxIter=1, replacement=False)
    copied = bag.copy({base.maxDepth: 6, bag.maxIter: 2})
    assert copied.getBaseLearner().getMaxDepth() == 6 and copied.getMaxIter() == 2
    assert base.getMaxDepth() == 2 and bag.getMaxIter() == 1
    stack = StackingClassifier(baseLearners=[base], stacker=tree())
    assert stack.copy({base.maxDepth: 7}).getBaseLearners()[0].getMaxDepth() == 7


def test_columns_with_awkward_names_survive(squares):
    named = squares.withColumnsRenamed({"a": "Age*Class", "b": "a.b c"})
    model = BaggingClassifier(baseLearner=tree(), maxIter=2, idCol="id").fit(named)
    assert model.transform(named).columns[1:3] == ["Age*Class", "a.b c"]


def test_other_column_names(squares):
    renamed = squares.withColumnsRenamed({"features": "f", "label": "y"})
    model = BoostingClassifier(baseLearner=tree(2), maxIter=2, featuresCol="f", labelCol="y",
                               predictionCol="guess").fit(renamed)
    assert "guess" in model.transform(renamed).columns
    assert configured(tree(), "y", "f", "g", "w").getWeightCol() == "w"


def test_no_scratch_is_left_behind(spark, squares):
    import os
    root = shared_root(spark)
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    BaggingClassifier(baseLearner=NaiveBayes(), maxIter=1).fit(squares)
    BoostingClassifier(baseLearner=tree(2), maxIter=3, checkpointInterval=1).fit(squares)
    assert set(os.listdir(root)) == before


# --- the searched step -----------------------------------------------------------------------

def test_searched_steps_minimise_the_loss(spark):
    from tabquorum.operators.ensemble.gbm import LARGEST_STEP, searched_steps
    rows = [(float(y), 1.0 + (i % 2), -0.3, 0.4, 0.2 * (1 if y == 0 else -1) * (1 if i % 5 else -1), (-1.0 if y else 1.0) * 0.5)
            for i in range(60) for y in (0, 1)]
    df = spark.createDataFrame(rows, ["label", "w", "f0", "f1", "h0", "h1"])
    steps = searched_steps(df, "label", "w", ["f0", "f1"], ["h0", "h1"])

    def loss(k, step):
        total = 0.0
        for y, w, f0, f1, h0, h1 in rows:
            f = [f0 + (step * h0 if k == 0 else 0), f1 + (step * h1 if k == 1 else 0)]
            total -= w * (f[int(y)] - math.log(math.exp(f[0]) + math.exp(f[1])))
        return total

    assert 0 < steps[0] < LARGEST_STEP
    assert loss(0, steps[0]) <= min(loss(0, steps[0] + d) for d in (-0.01, 0.01)) + 1e-9
    assert steps[1] == 0.0 and loss(1, 0.0) < loss(1, 0.1)      # class 1's output points away: no step


def test_the_step_search_passes_over_cells(squares, monkeypatch):
    """Trees give few different scores and steps: the passes read these, not the rows."""
    seen, plain = [], gbm.step_slopes
    monkeypatch.setattr(gbm, "step_slopes", lambda df, *rest: seen.append(df.count()) or plain(df, *rest))
    base = DecisionTreeRegressor(maxDepth=1, seed=1)
    GradientBoostingClassifier(baseLearner=base, maxIter=1, optimizedWeights=True).fit(squares)
    assert len(seen) == gbm.STEP_PASSES and max(seen) <= 3 * 2 ** 3 < squares.count()


def test_members_of_a_small_bag_take_one_task_a_pass(squares, monkeypatch):
    seen, plain = [], DecisionTreeClassifier.fit
    monkeypatch.setattr(DecisionTreeClassifier, "fit", lambda self, df, *rest: seen.append(df.rdd.getNumPartitions()) or plain(self, df, *rest))
    rows = squares.select("id", "features", "label")
    bag = BaggingClassifier(baseLearner=tree(), maxIter=2, sampleRatio=0.7, idCol="id")
    told = [classes(bag.fit(rows.repartition(n)).transform(rows)) for n in (1, 6)]
    assert seen == [1] * 4 and told[0] == told[1]


# --- members grown together ----------------------------------------------------------------

def nodes(model, spark):
    """The node rows of each member, as Spark stores them."""
    out = []
    for member in model.members:
        path = new_shared_path(spark, "member")
        member.write().save(path)
        out.append(sorted(map(tuple, spark.read.parquet(f"{path}/data").collect())))
    return out


@pytest.fixture(scope="module")
def noisy(spark):
    """Four numeric features, one with many zeros and one constant; labels that no tree learns quickly."""
    u = lambda k: F.xxhash64("id", F.lit(k)).bitwiseAND(0xFFFFFF) / float(1 << 24)
    x = F.array(u(1), F.when(u(2) < 0.6, 0.0).otherwise(u(2) - 0.8), F.floor(u(3) * 9), F.lit(2.5))
    label = (F.sin(9 * x[0]) + x[2] / 4 + u(4) > 1.2).cast("double") + (u(5) < 0.1).cast("double")
    out = spark.range(1500).select("id", array_to_vector(x).alias("features"), label.alias("label")).cache()
    out.count()
    return out


@pytest.mark.parametrize("base", [dict(maxDepth=20, maxBins=30), dict(maxDepth=0),
                                  dict(maxDepth=6, maxBins=8, minInstancesPerNode=7, minInfoGain=0.002, minWeightFractionPerNode=0.01)])
def test_bags_of_a_grid_grow_the_trees_of_their_fits(spark, noisy, base, monkeypatch):
    bag = BaggingClassifier(baseLearner=DecisionTreeClassifier(seed=3, **base), maxIter=2, idCol="id", seed=5)
    grid = [{bag.sampleRatio: r, bag.replacement: p, bag.sampleRatioFeatures: f} for r, p, f in
            ((1.0, True, 1.0), (0.6, False, 0.6), (0.9, True, 0.5), (1.0, False, 1.0))]
    apart = [bag.fit(noisy, point) for point in grid]
    seen, plain = [], DecisionTreeClassifier.fit
    monkeypatch.setattr(DecisionTreeClassifier, "fit", lambda self, *rest: seen.append(self) or plain(self, *rest))
    together = dict(bag.fitMultiple(noisy.repartition(5), grid))
    assert seen == [] and sorted(together) == [0, 1, 2, 3]
    for i, model in enumerate(apart):
        assert nodes(together[i], spark) == nodes(model, spark) and together[i].subspaces == model.subspaces
        for a, b in zip(model.members, together[i].members, strict=True):
            assert (a.numFeatures, a.numClasses, a.getMaxDepth(), a.getSeed(), a.getPredictionCol()) == (
                b.numFeatures, b.numClasses, b.getMaxDepth(), b.getSeed(), b.getPredictionCol())
        rows = [m.transform(noisy).orderBy("id").select("prediction", "rawPrediction").collect() for m in (model, together[i])]
        assert rows[0] == rows[1]
    member = together[0].members[0]
    assert "told" in member.copy({member.predictionCol: "told"}).transform(noisy).columns


def test_grids_of_bags_are_grown_by_few_jobs_in_groups(noisy, monkeypatch):
    bag = BaggingClassifier(baseLearner=tree(), maxIter=2, idCol="id")
    calls, plain = [], grown.grow_all
    monkeypatch.setattr(grown, "grow_all", lambda *a: calls.append(len(a[-1])) or plain(*a))
    monkeypatch.setattr(bagging, "TREE_ROWS", 4 * 1500)
    models = bag.fit(noisy, [{bag.sampleRatio: r} for r in (0.3, 0.5, 0.7)])
    assert calls == [4, 2] and [m.getSampleRatio() for m in models] == [0.3, 0.5, 0.7]


def test_other_bags_are_fitted_member_by_member(noisy, monkeypatch):
    monkeypatch.setattr(grown, "grow_all", None)
    for bag in (BaggingClassifier(baseLearner=NaiveBayes(modelType="gaussian"), maxIter=1, idCol="id"),
                BaggingClassifier(baseLearner=DecisionTreeClassifier(impurity="entropy"), maxIter=1, idCol="id"),
                BaggingClassifier(baseLearner=tree(), maxIter=1, idCol="id", weightCol="w")):
        (i, model), = bag.fitMultiple(noisy.withColumn("w", F.lit(2.0)), [{}])
        assert i == 0 and len(model.members) == 1
    monkeypatch.setattr(bagging, "TASK_VALUES", 1000)
    assert len(dict(BaggingClassifier(baseLearner=tree(), maxIter=1, idCol="id").fitMultiple(noisy, [{}, {}]))) == 2


@pytest.mark.parametrize("label", [None, 0.5, -1.0])
def test_labels_a_fit_refuses_are_refused(noisy, label):
    wrong = noisy.withColumn("label", F.when(F.col("id") == 3, F.lit(label).cast("double")).otherwise(F.col("label")))
    with pytest.raises(Exception, match="labels must be whole numbers"):
        list(BaggingClassifier(baseLearner=tree(), maxIter=1, replacement=False, idCol="id").fitMultiple(wrong, [{}]))


def test_thresholds_follow_the_running_weight():
    """The cuts of a walk over all values, and few rows more than needed for them."""
    draw = np.random.default_rng(4)
    for values, splits in ((400, 29), (31, 29), (30, 29), (29, 29), (2, 5), (1, 5), (3000, 7)):
        weights = draw.integers(1, 30, values) * draw.choice([1, 40], values, p=[0.95, 0.05]).astype(float)
        at = np.sort(draw.normal(size=values))
        want, seen, target = [], weights[0], weights.sum() / (splits + 1)
        for i in range(1, values):
            before, seen = seen, seen + weights[i]
            if values - 1 <= splits or abs(before - target) < abs(seen - target):
                want.append((at[i - 1] + at[i]) / 2)
                target += weights.sum() / (splits + 1)
        assert grown.thresholds(at, weights, splits).tolist() == want


def test_thresholds_of_many_rows_come_from_some():
    draw = np.random.default_rng(4)
    rows, = grown.rows_of(draw.normal(size=(40_000, 1)), draw.integers(0, 2, 40_000), draw.integers(-2**63, 2**63, (40_000, 1)))
    plan = grown.plan_of(DecisionTreeClassifier(maxDepth=1, maxBins=5), 1.0, False, [0], 2)
    seen, plain = [], grown.thresholds
    grown.thresholds = lambda *a: seen.append(plain(*a)) or seen[-1]
    try:
        root = grown.grow(rows, plan)[0]
    finally:
        grown.thresholds = plain
    assert root.rows.tolist() == [40_000] and root.stats.sum() == 40_000
    assert seen[0] == pytest.approx([-0.84, -0.25, 0.25, 0.84], abs=0.06)
