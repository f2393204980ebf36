"""Mixing sources to target weights by weighted pivotal rounding. DataFrame functions only.

Each source has a target number of words; a document of a source is taken r = target/size
times on average. Its whole copies are fixed, the fraction of a copy is decided by pivotal
rounding: two undecided documents exchange probability mass, weighted by their words, until one
of them is decided, so the words a group takes stay as they were, up to its one undecided rest.
Rests of groups of some ``CHUNK`` documents meet again in groups of the next level, until each
source has one, which is drawn. So a source's taken words differ from its target by less than
the words of one document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabquorum.sources.shared import materialize

from .columns import apart

CHUNK = 128
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of runs of characters other than space and ``\\t`` to ``\\r``; 0 for null."""
    one_each = F.translate(F.regexp_replace(text, WORD, "x"), " \t\n\x0b\f\r", "")
    return F.coalesce(F.length(one_each), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], limit: int = 3) -> DataFrame:
    """Target words of each source: rows (source, source_size, n_docs, target).

    ``sizes`` has columns source and size. Sources in code-point order, null last, take the
    weights in turn and share the words of all documents; no target exceeds ``limit`` times its
    source's size, and the excess goes to the others by weight. The level at which the sharing
    ends is found from running sums over sources ordered by limit per weight (one row a source).
    """
    by_source = sizes.groupBy("source").agg(
        F.sum("size").cast("long").alias("source_size"), F.count("*").alias("n_docs"))
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    ranked = by_source.withColumn("weight", weight.cast("long")).withColumn("top", F.col("source_size") * limit)
    order = Window.orderBy(F.col("top") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    ranked = (ranked
              .withColumn("left_words", F.sum("source_size").over(everything)
                          - F.coalesce(F.sum("top").over(before), F.lit(0)))
              .withColumn("left_weight", F.sum("weight").over(everything)
                          - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    # the first source whose limit is not reached at the level of those from it on
    free = F.col("top").cast("double") * F.col("left_weight") >= F.col("weight").cast("double") * F.col("left_words")
    level = F.min_by(F.struct("left_words", "left_weight"),
                     F.when(free, F.col("top") / F.col("weight"))).over(everything)
    ranked = ranked.withColumn("free", free).withColumn("level", level)
    share = (F.col("weight") * F.col("level.left_words")).cast("double") / F.col("level.left_weight")
    return ranked.select("source", "source_size", "n_docs", F.coalesce(
        F.least(F.col("top").cast("double"), share), F.col("top").cast("double")).alias("target"))


def _draw(seed: int, *keys: str) -> Column:
    """A uniform number in [0, 1) that only depends on the keys."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11) / F.lit(float(1 << 53))


def _pivot(units: Column) -> Column:
    """Fold units (key, p, size, u) in turn: decided ones, and the one left undecided or null."""
    none = F.lit(None).cast("struct<key:struct<doc_id:bigint,source:string,size:bigint>,p:double,size:double,u:double>")
    start = F.struct(none.alias("rest"), F.expr(
        "CAST(array() AS array<struct<key:struct<doc_id:bigint,source:string,size:bigint>,up:boolean>>)").alias("done"))

    def step(state, x):
        a = state["rest"]
        up = F.least((1 - a["p"]) * a["size"], x["p"] * x["size"])      # words that can go from x to a
        down = F.least(a["p"] * a["size"], (1 - x["p"]) * x["size"])    # and from a to x
        rise = x["u"] * (up + down) < down
        moved = F.when(rise, up).otherwise(-down)
        a_full, x_empty = rise & ((1 - a["p"]) * a["size"] <= up), rise & (x["p"] * x["size"] <= up)
        a_empty, x_full = ~rise & (a["p"] * a["size"] <= down), ~rise & ((1 - x["p"]) * x["size"] <= down)
        a_rest = F.struct(a["key"].alias("key"), (a["p"] + moved / a["size"]).alias("p"),
                          a["size"].alias("size"), a["u"].alias("u"))
        x_rest = F.struct(x["key"].alias("key"), (x["p"] - moved / x["size"]).alias("p"),
                          x["size"].alias("size"), x["u"].alias("u"))
        said_a = F.struct(a["key"].alias("key"), a_full.alias("up"))
        said_x = F.struct(x["key"].alias("key"), x_full.alias("up"))
        a_done, x_done = a_full | a_empty, x_empty | x_full
        decided = F.when(a_done & x_done, F.array(said_a, said_x)).when(a_done, F.array(said_a)).otherwise(F.array(said_x))
        rest = F.when(a_done & x_done, none).when(a_done, x_rest).otherwise(a_rest)
        return F.when(a.isNull(), F.struct(x.alias("rest"), state["done"].alias("done"))).otherwise(
            F.struct(rest.alias("rest"), F.concat(state["done"], decided).alias("done")))

    return F.aggregate(units, start, step)


def mix_sources(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), limit: int = 3, seed: int = 9,
                path: str | None = None) -> DataFrame:
    """How many words of each document the mix takes.

    ``docs`` has columns doc_id, text and source; others are not looked at. Returns one row per
    row: doc_id, size, source, source_size, target, copies and taken = copies * size. Rows equal
    in doc_id, source and size are decided together (same copies). A document without words
    (null or blank text) takes nothing; null is a source of its own; an empty table gives no
    rows. Draws are hashes of doc_id, source, size and the seed: reruns agree, whatever the
    partitions. The sizes are written to the shared folder once.
    """
    sized = docs.select("doc_id", "source", words(F.col("text")).alias("size"))
    sized, _ = materialize(sized, "sizes")
    stats = source_targets(sized, weights, limit).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    stats, _ = materialize(stats, "targets")
    largest = stats.agg(F.max("n_docs")).first()[0] or 0
    same = lambda left, right: left.eqNullSafe(right)

    units = sized.where("size > 0").groupBy("doc_id", "source", "size").agg(F.count("*").alias("m"))
    parts = stats.select(F.col("source").alias("of"), "n_docs", "rate")
    units = units.join(F.broadcast(parts) if largest_rows_fit(stats) else parts, same(F.col("source"), F.col("of")))
    level = units.select(
        F.struct("doc_id", "source", "size").alias("key"), (F.col("rate") - F.floor("rate")).alias("p"),
        (F.col("m") * F.col("size")).cast("double").alias("size"), F.col("n_docs").alias("left"),
        F.xxhash64(F.lit(seed), "doc_id", "source", "size").alias("h"))
    level = level.where("p > 0")
    decided, rounds, rest_n = [], 0, largest
    while True:
        rounds += 1
        groups = F.greatest(F.ceil(F.col("left") / CHUNK), F.lit(1))
        # the hash tail picks the group, a draw per level decides each exchange
        dealt = level.select("key", "p", "size", "h", F.col("key.source").alias("source"), groups.alias("left"),
                             F.pmod(F.xxhash64(F.lit(rounds), "h"), groups).alias("group"),
                             _draw(seed + rounds, "h").alias("u"))
        folded = dealt.groupBy("source", "group").agg(
            F.max("left").alias("left"),
            F.sort_array(F.collect_list(F.struct("h", "key", "p", "size", "u"))).alias("units"))
        folded = folded.select("left", _pivot(F.transform("units", lambda x: F.struct(
            x["key"].alias("key"), x["p"].alias("p"), x["size"].alias("size"), x["u"].alias("u")))).alias("s"))
        folded, _ = materialize(folded, "pivots")
        decided.append(folded.select(F.explode("s.done").alias("d")).select("d.key", "d.up"))
        rest = folded.where("s.rest IS NOT NULL")
        rest_n = -(-rest_n // CHUNK)
        if rest_n <= 1:
            decided.append(rest.select(F.col("s.rest.key").alias("key"), (
                _draw(seed, "s.rest.key") < F.col("s.rest.p")).alias("up")))
            break
        level = rest.select(F.col("s.rest.key").alias("key"), F.col("s.rest.p").alias("p"),
                            F.col("s.rest.size").alias("size"), "left",
                            F.xxhash64(F.lit(seed), F.col("s.rest.key")).alias("h"))
    ups = decided[0]
    for more in decided[1:]:
        ups = ups.union(more)
    ups = ups.where("up").select(F.col("key.doc_id").alias("u_id"), F.col("key.source").alias("u_source"),
                                 F.col("key.size").alias("u_size"), F.lit(1).alias("one"))
    rows = sized.join(F.broadcast(stats) if largest_rows_fit(stats) else stats.hint("shuffle_hash"), same(sized["source"], stats["source"]), "left").select(
        sized["doc_id"], sized["source"], "size", "source_size", "target", "rate")
    rows = rows.join(ups, same(F.col("doc_id"), F.col("u_id")) & same(F.col("source"), F.col("u_source"))
                     & (F.col("size") == F.col("u_size")), "left")
    copies = F.when(F.col("size") > 0, F.floor("rate") + F.coalesce("one", F.lit(0))).otherwise(0).cast("long")
    return rows.select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"),
                       (copies * F.col("size")).alias("taken"))


BROADCAST_SOURCES = 100_000


def largest_rows_fit(stats: DataFrame) -> bool:
    """Whether the table of sources has few enough rows to be broadcast."""
    return stats.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES


def mixed_rows(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), limit: int = 3, seed: int = 9) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with their own columns.

    Rows without words (null, empty or blank texts) carry none of the mixed words and stay once.
    Decisions are joined by doc_id, source and size; rows equal in all three have one decision. Columns
    may have any name; an empty table gives no rows.
    """
    taken = mix_sources(docs.select("doc_id", "text", "source"), weights, limit, seed).groupBy("doc_id", "source", "size").agg(
        F.first("copies").alias("copies"))
    taken = taken.withColumnsRenamed({"doc_id": "t_id", "source": "t_source", "size": "t_size"})
    own, back = apart(docs, "doc_id", "source", "text")
    rows = own.withColumn("words", words(F.col("text"))).drop("text")
    joined = rows.join(taken, F.col("doc_id").eqNullSafe(F.col("t_id")) & F.col("source").eqNullSafe(F.col("t_source"))
                       & (F.col("words") == F.col("t_size")))
    times = F.when(F.col("words") == 0, 1).otherwise(F.col("copies")).cast("int")
    repeated = joined.withColumn("times", times).where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return back(repeated)
