"""Subtree sums of a forest by parallel tree contraction, in join rounds.

Each round rakes all leaves into their parents and compresses chains: of the nodes with one
child left, an independent set (local minima of a hash that changes each round) is spliced out.
A live node carries its sum so far; an edge carries what spliced-out nodes add on the way up. The
number of rounds grows with the logarithm of the number of nodes, chains included. Then the
removed nodes are put back in reverse order: a raked node's total was known when it went, a
spliced one's is what it held plus the total of the child it pointed to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabquorum.sources.shared import materialize, release

LIVE, RAKED, SPLICED = 0, 1, 2


def _draw(node: str, number: int) -> Column:
    return F.struct(F.xxhash64(F.lit(number), F.col(node)), F.col(node))


def subtree_sums(forest: DataFrame, values: Sequence[str]) -> DataFrame:
    """(id, *values): the sums of ``values`` (long) over the subtree of each node, itself included.

    ``forest`` has id (long, unique, not null), parent (an id, null for a root), n_children and
    the values; it must give the same rows each time it is read. Sums of children are aggregated
    before they are shuffled, and no two rows of the other joins share a key, so a node with very
    many children holds up no task. An empty forest gives no rows.
    """
    spark = forest.sparkSession
    own, edge = [f"v{i}" for i in range(len(values))], [f"e{i}" for i in range(len(values))]
    live = forest.select("id", "parent", F.col("n_children").alias("k"),
                         *[F.col(v).alias(a) for v, a in zip(values, own, strict=True)],
                         *[F.lit(0).cast("long").alias(e) for e in edge])
    rounds: list[tuple[DataFrame, str]] = []
    while True:
        table, path = materialize(_round(live, own, edge, len(rounds)), "contraction")
        rounds.append((table, path))
        if table.where("state = 2 OR state = 0 AND parent IS NOT NULL").isEmpty():
            break
        live = _spliced(table, own, edge)
    totals, paths = None, []
    for table, _ in reversed(rounds):
        known = table.where("state = 1 OR state = 0 AND parent IS NULL AND k = 0").select("id", *own)
        totals = known if totals is None else totals.union(known)
        gone = table.where("state = 2").select(F.col("id").alias("node"), F.col("only").alias("id"), *[
            (F.col(a) + F.col(f"only_{e}")).alias(f"r{i}") for i, (a, e) in enumerate(zip(own, edge, strict=True))])
        back = gone.join(totals, "id").select(F.col("node").alias("id"), *[
            (F.col(f"r{i}") + F.col(a)).alias(a) for i, a in enumerate(own)])
        totals, path = materialize(totals.union(back), "totals")
        paths.append(path)
    for path in [p for _, p in rounds] + paths[:-1]:
        release(spark, path)
    return totals.select("id", *[F.col(a).alias(v) for v, a in zip(values, own, strict=True)])


def _round(live: DataFrame, own: Sequence[str], edge: Sequence[str], number: int) -> DataFrame:
    """Live nodes after a rake, with their state; raked leaves and spliced nodes among them."""
    stays = F.col("k") > 0
    below = live.where("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(
        *[F.sum(F.when(~stays, F.col(a) + F.col(e))).alias(f"s_{a}") for a, e in zip(own, edge, strict=True)],
        F.count(F.when(stays, 1)).alias("left"), F.max(F.when(stays, F.col("id"))).alias("only"),
        *[F.max(F.when(stays, F.col(e))).alias(f"only_{e}") for e in edge])
    rows = live.join(below, live["id"] == below["of"], "left").drop("of")
    leaf = (F.col("k") == 0) & F.col("parent").isNotNull()
    chain = (F.col("left") == 1) & F.col("parent").isNotNull()
    first = (_draw("id", number) < _draw("parent", number)) & (_draw("id", number) < _draw("only", number))
    return rows.select(
        "id", "parent", F.coalesce("left", F.lit(0)).cast("long").alias("k"),
        *[(F.col(a) + F.coalesce(f"s_{a}", F.lit(0))).alias(a) for a in own], *edge,
        F.when(leaf, RAKED).when(chain & first, SPLICED).otherwise(LIVE).alias("state"),
        "only", *[f"only_{e}" for e in edge])


def _spliced(table: DataFrame, own: Sequence[str], edge: Sequence[str]) -> DataFrame:
    """The live nodes of the next round: children of spliced nodes move up to their grandparents."""
    moved = table.where("state = 2").select(
        F.col("only").alias("child"), F.col("parent").alias("up"),
        *[(F.col(a) + F.col(e)).alias(f"add_{e}") for a, e in zip(own, edge, strict=True)])
    rows = table.where("state = 0").drop("only", *[f"only_{e}" for e in edge])
    rows = rows.join(moved, rows["id"] == moved["child"], "left")
    return rows.select("id", F.coalesce("up", "parent").alias("parent"), "k", *own, *[
        (F.col(e) + F.coalesce(f"add_{e}", F.lit(0))).alias(e) for e in edge])
