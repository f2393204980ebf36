"""Prefix trie of conversations, with subtree totals by tree contraction.

A turn's key is a hash of its place, role and text; the key of a prefix is the exclusive or of
its turns' keys (128 bits), so prefixes of one conversation are running values, and a prefix's
parent is itself without its last turn's key. Nodes are the distinct prefixes. A conversation of
any length is dealt over tasks: places are numbered in sorted ranges, running keys in chunks.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabquorum.sources.shared import materialize, release

from .contraction import subtree_sums

CHUNK = 256                # turns of a chunk of running keys
LIST_BYTES = 1 << 16       # bytes of a piece of a list of ids


def _number(batches):
    """Places of turns within this sorted range: (conv, range, place, k1, k2, size)."""
    from pyspark import TaskContext
    part, last, place = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        convs, places = batch.column("conv").to_pylist(), []
        for conv in convs:
            place = place + 1 if conv == last else 1
            last = conv
            places.append(place)
        yield pa.RecordBatch.from_pydict({
            "conv": batch.column("conv"), "part": pa.array([part] * len(convs), pa.int32()),
            "place": pa.array(places, pa.int64()), **{c: batch.column(c) for c in ("k1", "k2", "size")}})


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, place, k1, k2, size) of each turn: its place in the conversation from 1, two hashes
    of role and text, and the text's code points.

    Turns are ordered by turn (null first), then role, then text; null roles and texts are empty;
    rows without conv_id are no conversation's. Texts are shuffled once.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = rows.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    rows = rows.select("conv", F.xxhash64(F.lit(1), "role", "text").alias("k1"), F.xxhash64(F.lit(2), "text", "role").alias("k2"),
                       F.length("text").cast("long").alias("size"))
    rows, _ = materialize(rows.mapInArrow(_number, "conv bigint, part int, place bigint, k1 bigint, k2 bigint, size bigint"), "turns")
    counts = rows.groupBy("conv", "part").agg(F.max("place").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # only the first conversation of a range can go on from the one before: one row a range at most
    moved = counts.select("conv", "part", before.alias("before")).where("before > 0")
    rows = rows.join(F.broadcast(moved), ["conv", "part"], "left")
    return rows.select("conv", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "k1", "k2", "size")


def rebuilt_turns(turns: DataFrame, stride: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from the first conversation of their ``stride``.

    Of conversation c the first h = crc32(c) % ``heads`` turns are those of c - c % ``stride``
    (all, if it has fewer; none, if there is none), then come its own turns after its first h.
    Returns the turns as (conv, place, k1, k2, size, last) and all conversations as (conv, n).
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    convs = turns.groupBy("conv").agg(F.max("place").alias("n_own")).select(
        "conv", "n_own", h.alias("h"), (F.col("conv") - F.col("conv") % stride).alias("base"))
    bases = convs.select(F.col("conv").alias("base"), F.col("n_own").alias("n_base"))
    convs = convs.join(bases, "base", "left").withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0)))).select(
        "conv", "base", "h", "m", (F.col("m") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("n"))
    convs, _ = materialize(convs, "conversations")
    first = turns.where(F.col("place") < heads).withColumnRenamed("conv", "base")
    taken = convs.join(first, "base").where("place <= m").select("conv", "n", "place", "k1", "k2", "size")
    own = turns.join(convs.select("conv", "h", "m", "n"), "conv").where("place > h").select(
        "conv", "n", (F.col("place") - F.col("h") + F.col("m")).alias("place"), "k1", "k2", "size")
    rows = taken.union(own).select("conv", "place", "k1", "k2", "size", (F.col("place") == F.col("n")).alias("last"))
    return rows, convs.select("conv", "n")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, p1, p2, q1, q2, size, last): the key of each prefix and of its parent."""
    x1, x2 = F.xxhash64(F.col("place"), F.col("k1")), F.xxhash64(F.col("k2"), F.col("place"))
    rows = turns.withColumns({"x1": x1, "x2": x2, "chunk": F.floor((F.col("place") - 1) / CHUNK)})
    run = Window.partitionBy("conv", "chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"p{i}": F.expr(f"bit_xor(x{i})").over(run) for i in (1, 2)})
    # chunks after the first start from the keys of those before: one row a chunk
    long = turns.withColumns({"x1": x1, "x2": x2, "chunk": F.floor((F.col("place") - 1) / CHUNK) + 1}).groupBy("conv", "chunk").agg(
        F.count("*").alias("n"), F.expr("bit_xor(x1)").alias("y1"), F.expr("bit_xor(x2)").alias("y2")).where(F.col("n") == CHUNK)
    upto = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    carry = long.select("conv", "chunk", *[F.expr(f"bit_xor(y{i})").over(upto).alias(f"c{i}") for i in (1, 2)])
    rows = rows.join(carry, ["conv", "chunk"], "left")
    keys = {f"p{i}": F.col(f"p{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0).cast("long"))) for i in (1, 2)}
    rows = rows.withColumns(keys)
    return rows.select("conv", F.col("place").alias("depth"), "p1", "p2", F.col("p1").bitwiseXOR(F.col("x1")).alias("q1"),
                       F.col("p2").bitwiseXOR(F.col("x2")).alias("q2"), "size", "last")


def _pieces(batches):
    """Sorted (p1, p2, depth, conv) to lists of some LIST_BYTES: (p1, p2, depth, first, ids)."""
    def rows(groups):
        names = ("p1", "p2", "depth", "first")
        return pa.RecordBatch.from_pydict({
            **{n: pa.array([g[0][i] for g in groups], pa.int64()) for i, n in enumerate(names)},
            "ids": pa.array([",".join(g[1]) for g in groups], pa.string())})

    key, first, ids, size, done = None, 0, [], 0, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("p1", "p2", "depth", "conv")]
        for *new, conv in zip(*columns, strict=True):
            if new != key or size >= LIST_BYTES:
                if ids:
                    done.append(((*key, first), ids))
                key, first, ids, size = new, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if len(done) >= 1024:
            yield rows(done)
            done = []
    if ids:
        done.append(((*key, first), ids))
    if done:
        yield rows(done)


def _digests(batches):
    """Sorted pieces of lists to one digest a list; holds one running digest."""
    key, digest, out = None, None, []

    def rows():
        return pa.RecordBatch.from_pydict({
            **{n: pa.array([k[i] for k, _ in out], pa.int64()) for i, n in enumerate(("p1", "p2", "depth"))},
            "ends_sha256": pa.array([d for _, d in out], pa.string())})

    for batch in batches:
        for *new, ids in zip(*(batch.column(c).to_pylist() for c in ("p1", "p2", "depth", "ids")), strict=True):
            if new == key:
                digest.update(b"," + ids.encode())
            else:
                if digest is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = new, hashlib.sha256(ids.encode())
        if len(out) >= 1024:
            yield rows()
            out = []
    if digest is not None:
        out.append((key, digest.hexdigest()))
    if out:
        yield rows()


def list_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined conversations of each node (p1, p2, depth).

    Ranges of the sorted rows write pieces of the lists, so a node at which very many
    conversations end is spread over tasks; one task then runs through its pieces.
    """
    key = ["p1", "p2", "depth"]
    pieces = ends.repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv").mapInArrow(
        _pieces, "p1 bigint, p2 bigint, depth bigint, first bigint, ids string")
    return pieces.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(
        _digests, "p1 bigint, p2 bigint, depth bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame, stride: int = 100, heads: int = 6) -> DataFrame:
    """Nodes of the trie of rebuilt conversations.

    One row per distinct prefix (the textless root, depth 0, included): conv_id (smallest member),
    depth, parent_conv_id (null for the root), n_convs (members), n_children, n_leaves (childless
    nodes in its subtree), saved_tokens (sum over the subtree of (n_convs - 1) times the code
    points of the node's last text) and ends_sha256 (of the members that end here). See
    ``numbered_turns`` for order, nulls and ties; repeated rows are turns of their own; other
    columns are not looked at; long texts only count; an empty table gives no rows.
    """
    spark = conversations.sparkSession
    turns, turns_at = materialize(numbered_turns(conversations), "numbered")
    rows, convs = rebuilt_turns(turns, stride, heads)
    rows, rows_at = materialize(prefixes(rows), "prefixes")
    release(spark, turns_at)
    zero = F.lit(0).cast("long")
    root = convs.agg(zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), F.lit(None).cast("long").alias("q1"),
                     F.lit(None).cast("long").alias("q2"), F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"), zero.alias("size"))
    nodes = rows.groupBy("depth", "p1", "p2").agg(
        F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"),
        F.max("size").alias("size")).union(root.where("n_convs > 0").select("depth", "p1", "p2", "q1", "q2", "n_convs", "conv_id", "size"))
    children = rows.groupBy("depth", "p1", "p2").agg(F.max("q1").alias("q1"), F.max("q2").alias("q2")).groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["depth", "p1", "p2"], "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes, nodes_at = materialize(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
        F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    linked = nodes.join(parents, ["depth", "q1", "q2"], "left").select(
        "id", "parent", "conv_id", "parent_conv_id", "depth", "p1", "p2", "n_convs", "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"))
    linked, _ = materialize(linked, "linked")
    release(spark, nodes_at)
    sums = subtree_sums(linked, ["n_leaves", "saved_tokens"])
    ends = rows.where("last").select("p1", "p2", "depth", "conv").union(
        convs.where("n = 0").select(zero, zero, zero, "conv"))
    digests, _ = materialize(list_digests(ends), "ends")
    release(spark, rows_at)
    out = linked.drop("n_leaves", "saved_tokens").join(sums, "id").join(digests, ["p1", "p2", "depth"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
