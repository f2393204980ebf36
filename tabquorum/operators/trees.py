"""Fitted trees as tables: one row per node, and scoring by walking that table.

Any of Spark's tree models and the ensembles of this package over trees become rows (tree, weight,
class, depth, node, left, right, feature, threshold, categories, value, impurity, gain, rows, stats).
Leaves have no left, right, feature. A table outlives the session that fitted the model, can be
joined, compared and read by another engine.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.inline import inline_table
from ..sources.shared import new_shared_path
from .ensemble import BaggingModel, BoostingModel, GradientBoostingModel



def _node_columns(node: str) -> list[Column]:
    """The columns of a stored node; ``node`` is the prefix of its fields."""
    field = lambda name: F.col(f"{node}{name}")
    inner, numeric = field("leftChild") >= 0, field("split.numCategories") < 0
    split = field("split.leftCategoriesOrThreshold")
    return [field("id").alias("node"), F.when(inner, field("leftChild")).alias("left"),
            F.when(inner, field("rightChild")).alias("right"), F.when(inner, field("split.featureIndex")).alias("feature"),
            F.when(inner & numeric, F.get(split, F.lit(0))).alias("threshold"),
            F.when(inner & ~numeric, split).alias("categories"), field("prediction").alias("value"),
            field("impurity").alias("impurity"), field("gain").alias("gain"), field("rawCount").alias("rows"),
            field("impurityStats").alias("stats")]


def _stored(spark: SparkSession, model: Model) -> tuple[DataFrame, list[tuple]]:
    """Node rows (number within the model first) of one of Spark's models, and (number, weight, depth)."""
    path = new_shared_path(spark, "model")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" not in data.columns:
        return data.select(F.lit(0).alias("number"), *_node_columns("")), [(0, 1.0, model.depth)]
    weights = model.treeWeights
    return (data.select(F.col("treeID").alias("number"), *_node_columns("nodeData.")),
            [(i, float(w), tree.depth) for i, (w, tree) in enumerate(zip(weights, model.trees, strict=True))])


def _members(model: Model) -> list[tuple[Model, float, int | None, Sequence[int] | None]]:
    """(model, weight, class, feature numbers) of each member of an ensemble of this package."""
    if isinstance(model, BaggingModel):
        return [(m, 1.0, None, s) for m, s in zip(model.members, model.subspaces, strict=True)]
    if isinstance(model, BoostingModel):
        return [(m, say, None, None) for m, say in zip(model.members, model.says, strict=True)]
    if isinstance(model, GradientBoostingModel):
        rate = model.getLearningRate()
        return [(m, rate * w, k, None) for models, weights in zip(model.rounds, model.weights, strict=True)
                for k, (m, w) in enumerate(zip(models, weights, strict=True))]
    return [(model, 1.0, None, None)]


def tree_table(spark: SparkSession, model: Model) -> DataFrame:
    """All nodes of a fitted tree or ensemble of trees, as rows.

    ``weight`` is the factor of the tree's output in the ensemble's score (for gradient boosting,
    step and learning rate), ``class`` the class the tree adds to (gradient boosting only), ``depth``
    the depth of the tree, ``rows`` and ``stats`` the training rows that reached the node. The model
    is written to the shared folder, which the result reads.
    """
    frames, heads, first = [], [], 0
    for member, factor, group, space in _members(model):
        nodes, trees = _stored(spark, member)
        if space is not None:
            nodes = nodes.withColumn("feature", F.get(F.array(*[F.lit(int(i)) for i in space]), F.col("feature")))
        frames.append(nodes.withColumn("tree", F.col("number") + first).drop("number"))
        heads += [(first + i, factor * w, group, depth) for i, w, depth in trees]
        first += len(trees)
    table = inline_table(spark, heads, "tree int, weight double, class int, depth int")
    return table.join(reduce(DataFrame.union, frames), "tree")


def tree_header(spark: SparkSession, model: Model) -> DataFrame:
    """One row about the whole model: kind, trees, classes, features and the scores it starts from."""
    members = _members(model)
    trees = sum(len(getattr(m, "trees", [m])) for m, *_ in members)
    start = [float(x) for x in getattr(model, "start", [])]
    return inline_table(spark, [(type(model).__name__, trees, getattr(model, "numClasses", None),
                                 int(model.numFeatures) if hasattr(model, "numFeatures") else int(members[0][0].numFeatures), start)],
                        "kind string, trees int, classes int, features int, start array<double>")


def structure_lines(header: DataFrame, nodes: DataFrame) -> DataFrame:
    """The whole model as text rows (tree, node, text), the header first with null tree and node."""
    label = F.concat_ws(" ", "kind", F.concat(F.lit("trees="), "trees"), F.concat(F.lit("classes="), F.coalesce("classes", F.lit(0))),
                        F.concat(F.lit("features="), "features"), F.concat(F.lit("start="), F.array_join(F.transform("start", lambda x: x.cast("string")), ",")))
    rule = F.when(F.col("threshold").isNotNull(), F.concat(F.lit("<= "), "threshold")).otherwise(
        F.concat(F.lit("in {"), F.array_join(F.transform("categories", lambda x: x.cast("string")), ","), F.lit("}")))
    text = F.when(F.col("left").isNull(), F.concat(F.lit("predict "), "value")).otherwise(
        F.concat(F.lit("if x"), "feature", F.lit(" "), rule, F.lit(" then "), "left", F.lit(" else "), "right"))
    none = F.lit(None).cast("int")
    return header.select(none.alias("tree"), none.alias("node"), label.alias("text")).union(
        nodes.select("tree", "node", F.concat(text, F.lit(" weight "), "weight").alias("text")))


def walked(df: DataFrame, nodes: DataFrame, keys: Sequence[str], features: str = "features") -> DataFrame:
    """The leaf of every row in every tree: keys, tree, weight, class, value and stats.

    Each level is one join of (row, tree) pairs with the node table, which has the size of the model;
    at a threshold, smaller or equal values go left, as do the listed categories.
    """
    size = nodes.agg(F.max("depth").alias("depth"), F.max("tree").alias("last")).first()
    inner = nodes.where("left IS NOT NULL").select("tree", F.col("node").alias("at"), "left", "right", "feature", "threshold", "categories")
    state = df.select(*keys, vector_to_array(features).alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(size["last"]))).alias("tree"), F.lit(0).alias("at"))
    x = F.get("_x", F.col("feature"))
    left = F.when(F.col("threshold").isNotNull(), x <= F.col("threshold")).otherwise(F.array_contains("categories", x))
    for _ in range(size["depth"]):
        state = state.join(inner, ["tree", "at"], "left").select(*keys, "_x", "tree", F.when(
            F.col("left").isNull(), F.col("at")).when(left, F.col("left")).otherwise(F.col("right")).alias("at"))
    leaves = nodes.select("tree", F.col("node").alias("at"), "weight", "class", "value", "stats")
    return state.join(leaves, ["tree", "at"]).select(*keys, "tree", "weight", "class", "value", "stats")


def table_scores(leaves: DataFrame, keys: Sequence[str], kind: str, start: Sequence[float] = ()) -> DataFrame:
    """One row per row: its prediction from its leaves, added in the order of the trees.

    ``kind`` is ``votes`` (classes by the shares of the leaves, a classifying tree or forest),
    ``ballots`` (the classes of the leaves, weighted), ``mean`` (a regressing tree or forest), ``sum``
    (boosted regression), ``sign`` (boosted classification into two classes) or ``classes``
    (weighted sums per class added to ``start``). Ties go to the lowest class.
    """
    rows = leaves.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("tree", "weight", "class", "value", "stats"))).alias("l"))
    add = lambda f: F.aggregate("l", F.lit(0.0), lambda a, t: a + f(t))
    zeros = F.transform(F.get("l", F.lit(0))["stats"], lambda s: F.lit(0.0))
    best = lambda scores: (F.array_position(scores, F.array_max(scores)) - 1).cast("double")
    total = lambda s: F.aggregate(s, F.lit(0.0), lambda a, v: a + v)
    if kind == "votes":
        score = best(F.aggregate("l", zeros, lambda a, t: F.zip_with(a, t["stats"], lambda p, q: p + q / total(t["stats"]))))
    elif kind == "ballots":
        score = best(F.transform(zeros, lambda _, k: add(lambda t: F.when(t["value"] == k, t["weight"]).otherwise(0.0))))
    elif kind == "mean":
        score = add(lambda t: t["value"]) / F.size("l")
    elif kind == "sum":
        score = add(lambda t: t["weight"] * t["value"])
    elif kind == "sign":
        score = F.when(add(lambda t: t["weight"] * t["value"]) > 0, 1.0).otherwise(0.0)
    elif kind == "classes":
        score = best(F.array(*[F.lit(float(f)) + add(lambda t, k=k: F.when(t["class"] == k, t["weight"] * t["value"]).otherwise(0.0))
                               for k, f in enumerate(start)]))
    else:
        raise ValueError(f"unknown kind {kind}")
    return rows.select(*keys, score.alias("prediction"))
