"""Decision trees of many bags grown by one task.

Spark's tree fit starts a job or two for each level of a tree, and some for its start. On training rows
that fit into one task these jobs are far shorter than what it takes to start them, and a grid of bags
needs thousands. Here a task reads the rows once, with a hash for each draw (the members of one number, of all
bags of one seed), and grows all trees. The trees are the ones Spark's fit grows (Gini impurity, numeric features,
whole weights, so that all sums are exact): the same thresholds, splits, ties, leaves and pruning. Only
where a member has more rows than Spark takes for thresholds (10,000, or the square of ``maxBins``) are other
rows taken: by a hash of the row's key instead of by partition.

Trees go to the shared folder in the form Spark stores a forest in, and are read back as its models.
"""

from __future__ import annotations

import copy
import json
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param
from pyspark.sql import DataFrame

from ...functions.hashing import WORD, poisson_steps
from ...sources.inline import inline_table
from ...sources.shared import new_shared_path, release

try:  # rows reach Python as Arrow batches
    import pyarrow as pa
except ModuleNotFoundError:
    pa = None

# Tasks get the functions themselves, so executors need numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODES = """treeID int, nodeData struct<id:int, prediction:double, impurity:double, impurityStats:array<double>, rawCount:bigint,
gain:double, leftChild:int, rightChild:int, split:struct<featureIndex:int, leftCategoriesOrThreshold:array<double>, numCategories:int>>"""
ROWS_FOR_THRESHOLDS = 10_000
# Nodes whose cells are summed at once: 4,096 with 32 bins and two classes are 2 MB for a feature.
NODES_AT_ONCE = 1 << 12
MOST_CLASSES = 100      # without metadata, as in Spark
INVALID, EPSILON = -np.finfo(float).max, np.finfo(float).eps


@dataclass(frozen=True)
class TreePlan:
    """One tree: which of the draw's rows it sees and how it grows."""
    ratio: float
    steps: tuple[float, ...]    # with replacement, where the uniform reaches one row more
    space: tuple[int, ...]
    classes: int | None
    max_depth: int
    max_bins: int
    min_rows: int
    min_share: float
    min_gain: float


def plan_of(tree: DecisionTreeClassifier, ratio: float, replacement: bool, space: Sequence[int], classes: int | None) -> TreePlan:
    return TreePlan(ratio, tuple(poisson_steps(ratio)) if replacement else (), tuple(space), classes, tree.getMaxDepth(), tree.getMaxBins(), tree.getMinInstancesPerNode(),
                    tree.getMinWeightFractionPerNode(), tree.getMinInfoGain())


@dataclass
class Rows:
    """The training rows in a task. A feature is its sorted values and each row's place among them."""
    values: list[np.ndarray]
    places: list[np.ndarray]
    label: np.ndarray
    draw: np.ndarray        # uniform, decides the sample
    other: np.ndarray       # uniform, decides which rows the thresholds come from


def rows_of(x: np.ndarray, label: np.ndarray, hashed: np.ndarray) -> Iterator[Rows]:
    """The rows with each draw."""
    found = [np.unique(column, return_inverse=True) for column in x.T]
    values, places = [v for v, _ in found], [p.astype(np.int32) for _, p in found]
    for column in hashed.T:
        words = column.astype(np.int64).view(np.uint64)
        yield Rows(values, places, label, (words & np.uint64(WORD - 1)) / WORD, (words >> np.uint64(32)) / WORD)


def read_rows(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns x (array of doubles), y and h (array of a hash for each draw). What Spark's fit refuses is refused."""
    x, y, h = [], [], []
    for batch in batches:
        lists = batch.column("x")
        widths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, int)
        labels = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
        if lists.null_count or len(set(widths)) > 1 or not np.isfinite(flat := lists.flatten().to_numpy(zero_copy_only=False)).all():
            raise ValueError("features must be vectors of one size without null, NaN or infinite values")
        if batch.column("y").null_count or not (np.isfinite(labels) & (labels >= 0) & (labels == np.floor(labels))).all():
            raise ValueError("labels must be whole numbers from 0, without nulls")
        if len(labels):
            x.append(flat.reshape(len(labels), -1))
            y.append(labels.astype(np.int64))
            h.append(batch.column("h").flatten().to_numpy().reshape(len(labels), -1))
    if not y:
        raise ValueError("no training rows")
    return np.concatenate(x), np.concatenate(y), np.concatenate(h)


def counts_of(rows: Rows, plan: TreePlan) -> np.ndarray:
    """How often each row is drawn."""
    if plan.steps:
        return np.searchsorted(plan.steps, rows.draw, side="right").astype(float)
    return (rows.draw < plan.ratio).astype(float) if plan.ratio < 1.0 else np.ones(len(rows.label))


def thresholds(values: np.ndarray, weights: np.ndarray, splits: int) -> np.ndarray:
    """Up to ``splits`` cuts between sorted distinct values: all, or about equal weights between them."""
    if len(values) < 2:
        return np.zeros(0)
    middles = (values[:-1] + values[1:]) / 2.0
    if len(middles) <= splits:
        return middles
    reached = np.cumsum(weights)
    # The value before place i is a cut if its running weight is nearer to the target than the next one's.
    halves, stride = (reached[:-1] + reached[1:]) / 2.0, float(reached[-1]) / (splits + 1)
    out, i, target = [], 1, stride
    while i < len(values):
        i = max(i, int(np.searchsorted(halves, target)) - 1)
        while i < len(values) and not abs(reached[i - 1] - target) < abs(reached[i] - target):
            i += 1
        if i < len(values):
            out.append(middles[i - 1])
            target += stride
            i += 1
    return np.array(out)


def gini(counts: Sequence[np.ndarray], total: np.ndarray) -> np.ndarray:
    """Impurity from the weights of the classes; 0 without rows. Subtracted class by class, as Spark does."""
    out = np.ones_like(total)
    with np.errstate(divide="ignore", invalid="ignore"):
        for count in counts:
            share = count / total
            out -= share * share
    return np.where(total == 0, 0.0, out)


@dataclass
class Level:
    """The nodes of one level: class weights (class, node), rows, and what became of each."""
    stats: np.ndarray
    rows: np.ndarray
    impurity: np.ndarray
    gain: np.ndarray
    feature: np.ndarray     # within the tree's space; -1: a leaf
    cut: np.ndarray
    left: np.ndarray        # place of the left child in the next level; the right one follows
    prediction: np.ndarray


def best_splits(slot, label, weight, bins, cuts, stats, impurity, plan: TreePlan, least: float):
    """(gain, feature, number of the cut) of each node; the first of equals, feature by feature."""
    nodes, classes = stats.shape[1], stats.shape[0]
    best = np.full(nodes, -np.inf), np.full(nodes, -1), np.zeros(nodes, int)
    for f, (place, cut) in enumerate(zip(bins, cuts, strict=True)):
        if not len(cut):
            continue
        size = len(cut) + 1
        cell = slot * size + place
        summed = np.bincount(label * (nodes * size) + cell, weight, classes * nodes * size).reshape(classes, nodes, size)
        left = np.cumsum(summed, axis=2)[:, :, :-1]
        right = stats[:, :, None] - left
        n_left, n_right = left.sum(axis=0), right.sum(axis=0)
        total = n_left + n_right
        gain = impurity[:, None] - n_left / total * gini(left, n_left) - n_right / total * gini(right, n_right)
        bad = (n_left < max(least, 1.0)) | (n_right < max(least, 1.0)) | (gain < plan.min_gain)
        if plan.min_rows > 1:
            some = np.cumsum(np.bincount(cell, minlength=nodes * size).reshape(nodes, size), axis=1)
            bad |= (some[:, :-1] < plan.min_rows) | (some[:, -1:] - some[:, :-1] < plan.min_rows)
        gain[bad] = INVALID
        at = gain.argmax(axis=1)
        most = gain[np.arange(nodes), at]
        better = most > best[0]
        for held, new in zip(best, (most, f, at), strict=True):
            held[better] = new[better] if isinstance(new, np.ndarray) else new
    # Without any cut Spark takes the node for one without a valid split.
    return np.where(best[1] < 0, INVALID, best[0]), best[1], best[2]


def grow(rows: Rows, plan: TreePlan) -> list[Level]:
    """The levels of one tree, before pruning."""
    counts = counts_of(rows, plan)
    seen = np.flatnonzero(counts)
    if not len(seen):
        raise ValueError("a member's sample has no rows")
    weight, label = counts[seen], rows.label[seen]
    classes = int(label.max()) + 1 if plan.classes is None else plan.classes
    if label.max() >= classes or plan.classes is None and classes > MOST_CLASSES:
        raise ValueError(f"a label is {label.max()}, but there are {min(classes, MOST_CLASSES)} classes")
    bins_most = min(plan.max_bins, len(seen))
    enough = max(bins_most * bins_most, ROWS_FOR_THRESHOLDS)
    shown = counts if enough >= len(seen) else np.where(rows.other < enough / len(seen), counts, 0.0)
    cuts, bins = [], []
    for f in plan.space:
        there = np.bincount(rows.places[f], shown, len(rows.values[f]))
        have = there > 0
        cuts.append(thresholds(rows.values[f][have], there[have], bins_most - 1))
        bins.append(np.searchsorted(cuts[-1], rows.values[f])[rows.places[f][seen]])
    table, least = np.stack(bins), plan.min_share * weight.sum()
    flat, first = np.concatenate(cuts), np.cumsum([0, *map(len, cuts)])

    slot = np.zeros(len(seen), dtype=np.int64)
    stats, size = np.bincount(label, weight, classes)[:, None], np.array([len(seen)])
    open_ = np.ones(1, dtype=bool)
    levels: list[Level] = []
    while True:
        depth, nodes = len(levels), stats.shape[1]
        impurity = gini(stats, stats.sum(axis=0))
        level = Level(stats, size, impurity.copy(), np.full(nodes, -1.0), np.full(nodes, -1), np.zeros(nodes), np.full(nodes, -1),
                      stats.argmax(axis=0).astype(float))
        levels.append(level)
        # ``slot`` counts the open nodes only, and only their rows are still there.
        which = np.flatnonzero(open_)
        if not len(which):
            return levels
        gain, feature, cut = np.zeros(len(which)), np.full(len(which), -1), np.zeros(len(which), int)
        for low in range(0, len(which), NODES_AT_ONCE):
            part = which[low: low + NODES_AT_ONCE]
            take = slice(None) if len(part) == len(which) else np.flatnonzero((slot >= low) & (slot < low + len(part)))
            gain[low: low + len(part)], feature[low: low + len(part)], cut[low: low + len(part)] = best_splits(
                slot[take] - low, label[take], weight[take], table[:, take], cuts, stats[:, part], impurity[part], plan, least)
        splits = (gain > 0) & (depth < plan.max_depth)
        level.impurity[which[gain == INVALID]] = -1.0
        inner = which[splits]
        level.gain[inner], level.feature[inner] = gain[splits], feature[splits]
        level.cut[inner] = flat[first[feature[splits]] + cut[splits]]
        level.left[inner] = 2 * np.arange(len(inner))
        if not len(inner):
            return levels
        number = np.cumsum(splits) - 1
        kept = np.flatnonzero(splits[slot])
        was = slot[kept]
        child = 2 * number[was] + (table[feature[was], kept] > cut[was])
        label, weight, table = label[kept], weight[kept], table[:, kept]
        stats = np.bincount(label * (2 * len(inner)) + child, weight, classes * 2 * len(inner)).reshape(classes, -1)
        size = np.bincount(child, minlength=2 * len(inner))
        open_ = (depth + 1 < plan.max_depth) & (np.abs(gini(stats, stats.sum(axis=0))) >= EPSILON)
        going, place = open_[child], np.cumsum(open_) - 1
        slot, label, weight, table = place[child[going]], label[going], weight[going], table[:, going]


def pruned(levels: list[Level]) -> None:
    """Two leaves of one class below one node become one leaf, from the bottom up."""
    for level, below in reversed(list(zip(levels, levels[1:]))):
        inner = np.flatnonzero(level.left >= 0)
        left = level.left[inner]
        same = (below.left[left] < 0) & (below.left[left + 1] < 0) & (below.prediction[left] == below.prediction[left + 1])
        level.prediction[inner[same]] = below.prediction[left[same]]
        level.left[inner[same]], level.gain[inner[same]], level.feature[inner[same]] = -1, -1.0, -1


def node_batch(number: int, levels: list[Level]) -> pa.RecordBatch:
    """The nodes as rows, numbered level by level without those cut off."""
    kept, picked, first = np.arange(1), [], 1
    for level in levels:
        left = level.left[kept]
        inner = left >= 0
        ids = np.where(inner, first + 2 * (np.cumsum(inner) - 1), -1)
        picked.append((level, kept, ids))
        first += 2 * int(inner.sum())
        kept = np.stack([left[inner], left[inner] + 1], axis=1).ravel()
    join = lambda of: np.concatenate([of(level, kept, ids) for level, kept, ids in picked])
    left, stats = join(lambda _, __, ids: ids).astype(np.int32), join(lambda v, k, _: v.stats[:, k].T)
    inner, n = left >= 0, len(left)
    cut = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(inner)]).astype(np.int32)), pa.array(join(lambda v, k, _: v.cut[k])[inner]))
    split = pa.StructArray.from_arrays([pa.array(join(lambda v, k, _: v.feature[k]).astype(np.int32)), cut, pa.array(np.full(n, -1, np.int32))],
                                       ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    columns = {"id": np.arange(n, dtype=np.int32), "prediction": join(lambda v, k, _: v.prediction[k]), "impurity": join(lambda v, k, _: v.impurity[k]),
               "impurityStats": pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * stats.shape[1]), pa.array(stats.ravel())),
               "rawCount": join(lambda v, k, _: v.rows[k]).astype(np.int64), "gain": join(lambda v, k, _: v.gain[k]), "leftChild": left,
               "rightChild": np.where(inner, left + 1, -1).astype(np.int32), "split": split}
    node = pa.StructArray.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()], list(columns))
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, number, np.int32)), node], ["treeID", "nodeData"])


def grown(batches: Iterator[pa.RecordBatch], plans: Sequence[Sequence[tuple[int, TreePlan]]]) -> Iterator[pa.RecordBatch]:
    """Node rows of all (number, plan) of each draw, on the rows of the task."""
    for rows, some in zip(rows_of(*read_rows(batches)), plans, strict=True):
        for number, plan in some:
            levels = grow(rows, plan)
            pruned(levels)
            yield node_batch(number, levels)


class GrownTree(DecisionTreeClassificationModel):
    """A grown tree. The JVM is told its parameters once, and again only if they change: on few rows telling
    them before each use takes longer than the use."""

    told = None

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.told != self._paramMap:
            self._transfer_params_to_java()
            self.told = dict(self._paramMap)
        return DataFrame(self._java_obj.transform(dataset._jdf), dataset.sparkSession)


def _models(roots: Sequence, trees: Sequence[tuple[DecisionTreeClassifier, Mapping[Param, object], int, TreePlan]], jvm) -> list[GrownTree]:
    """The model of each root, with the parameters its fit would have left."""
    out, first = [], {}
    for root, (learner, values, _, plan) in zip(roots, trees, strict=True):
        classes = plan.classes or len(root.impurityStats().stats())
        java = jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel(learner.uid, root, len(plan.space), classes)
        if learner.uid not in first:
            first[learner.uid] = GrownTree(java)
            first[learner.uid]._java_obj = None     # else the JVM's tree goes with this one
        model = copy.copy(first[learner.uid])
        model._java_obj, model._paramMap, model._defaultParamMap = java, {}, dict(model._defaultParamMap)
        learner._copyValues(model, dict(values))
        if not (learner.isSet(learner.thresholds) or learner.isSet(learner.leafCol)):
            java.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol()).setRawPredictionCol("").setProbabilityCol("")
            model.told = dict(model._paramMap)
        out.append(model)
    return out


def grow_all(train: DataFrame, features: str, label: str, key: str,
             trees: Sequence[tuple[DecisionTreeClassifier, Mapping[Param, object], int, TreePlan]]) -> list[GrownTree]:
    """The fitted models of (learner, its own parameters, seed of the draw, plan), by one job of one task."""
    spark = train.sparkSession
    plans: dict[int, list[tuple[int, TreePlan]]] = {}
    for number, (_, _, seed, plan) in enumerate(trees):
        plans.setdefault(seed, []).append((number, plan))
    hashes, some = ", ".join(f"xxhash64(k, {seed}L)" for seed in plans), list(plans.values())
    rows = train.select(vector_to_array(features).alias("x"), train[label].alias("y"), train[key].alias("k")).coalesce(1)
    path = new_shared_path(spark, "trees")
    try:
        rows.selectExpr("x", "y", f"array({hashes}) AS h").mapInArrow(lambda batches: grown(batches, some), NODES).write.parquet(f"{path}/data")
        about = {"timestamp": 0, "sparkVersion": spark.version, "defaultParamMap": {}}
        kind = "org.apache.spark.ml.classification.{}ClassificationModel"
        tree = json.dumps(about | {"class": kind.format("DecisionTree"), "uid": "tree", "paramMap": {}})
        inline_table(spark, [(i, tree, 1.0) for i in range(len(trees))], "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        forest = json.dumps(about | {"class": kind.format("RandomForest"), "uid": "forest", "paramMap": {"impurity": "gini"}, "numFeatures": 1,
                                     "numClasses": 2, "numTrees": len(trees)})
        inline_table(spark, [(forest,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        loaded = spark._jvm.org.apache.spark.ml.classification.RandomForestClassificationModel.load(path).trees()
    finally:
        release(spark, path)
    return _models([t.rootNode() for t in loaded], trees, spark._jvm)
