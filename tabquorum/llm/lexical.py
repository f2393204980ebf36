"""Ranked lexical search by pipelined term partitioning.

Documents are indexed in shards of some two million bytes of text: a row of the index is one term of
one shard, with its postings packed. Each term is owned by one stage, by its weight; stages run
from rare to common terms. A bundle of items carries sparse accumulators of a shard's documents
from stage to stage; a stage cogroups the bundles with the postings of its terms and adds integer
contributions. Documents that cannot reach the shard's k-th best score any more, by an upper bound
on the terms to come, leave the accumulators; this changes no result. The best of all shards are
ranked at the end.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tabquorum.sources.shared import materialize, release

from .arrays import slices, words_of

SHARD_BYTES = 2_000_000
FILTER_BITS = 22           # the filter of item terms has 2**22 bits, whatever the items
BUNDLE = 64                # items of a bundle
STAGES = (5000, 2500, 1000)  # least weight of a term of each stage but the last
INDEX = "shard bigint, term bigint, n bigint, total bigint, most int, least int, data binary, names array<bigint>"


def _terms(batches):
    """Distinct (item, term hash)."""
    for batch in slices(batches):
        w = words_of(batch.column("text"))
        items = np.asarray(batch.column("item").to_numpy(zero_copy_only=False), dtype=np.int64)[w.doc]
        pairs = np.unique(np.stack([items, w.hash.view(np.int64)], axis=1), axis=0)
        yield pa.RecordBatch.from_pydict({"item": pa.array(pairs[:, 0], pa.int64()), "term": pa.array(pairs[:, 1], pa.int64())})


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _index(batches, shared):
    """Per shard: a header (term null, the doc_ids in ``names``) and one row per term that passes the
    filter of item terms."""
    from pyspark import TaskContext
    wanted = np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool)
    shard = TaskContext.get().partitionId() << 32
    for batch in slices(batches, size=SHARD_BYTES):
        w = words_of(batch.column("text"))
        n = w.per_text()
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int64()), "term": pa.array([None], pa.int64()), "n": pa.array([int((n > 0).sum())], pa.int64()),
            "total": pa.array([int(n.sum())], pa.int64()), "most": pa.array([0], pa.int32()), "least": pa.array([0], pa.int32()),
            "data": pa.array([None], pa.binary()), "names": pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64()))})
        at = np.flatnonzero(wanted[_slot(w.hash)])
        at = at[np.argsort(w.hash[at], kind="stable")]
        term, doc = w.hash[at], w.doc[at]
        first = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])])) if len(at) else at
        tf = np.diff(np.append(first, len(at)))
        term, doc = term[first], doc[first]
        rows = np.stack([doc, tf, n[doc]], axis=1).astype("<i4") if len(first) else np.zeros((0, 3), "<i4")
        begin = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else first
        cuts = np.append(begin, len(term))
        for a in range(0, len(begin), 10_000):
            b = min(a + 10_000, len(begin))
            part = rows[cuts[a]: cuts[b]]
            offsets = ((cuts[a: b + 1] - cuts[a]) * 12).astype(np.int32)
            data = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(part.tobytes())])
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array(np.full(b - a, shard), pa.int64()), "term": pa.array(term[begin[a:b]].view(np.int64), pa.int64()),
                "n": pa.array(np.diff(cuts[a: b + 1]), pa.int64()), "total": pa.array(np.zeros(b - a, np.int64)),
                "most": pa.array(np.maximum.reduceat(part[:, 1], offsets[:-1] // 12), pa.int32()),
                "least": pa.array(np.minimum.reduceat(part[:, 2], offsets[:-1] // 12), pa.int32()), "data": data,
                "names": pa.nulls(b - a, pa.list_(pa.int64()))})
        shard += 1


def spread(n: Column, documents: int, total: int) -> Column:
    """The integer length factor m of a document of n terms."""
    return F.lit(50) + F.expr(f"(50 * {n} * {documents}L) div {max(total, 1)}L")


def _stage(documents: int, total: int, top: int):
    """The work of one stage on one bundle and shard."""

    def run(key, bundle, postings):
        shard, number = int(key[0]), int(key[1])
        given = [np.asarray(x, dtype=np.int64).reshape(-1, 3) for x in postings["wants"]]  # item, weight, bound to come
        lists = [np.frombuffer(x, "<i4").reshape(-1, 3).astype(np.int64) for x in postings["data"]]
        have = [np.frombuffer(x, "<i8").reshape(-1, 2) for x in bundle["found"]]           # doc, score
        bounds = dict(zip(bundle["item"].tolist(), bundle["bound"].tolist(), strict=True))
        for g in given:
            bounds |= dict(zip(g[:, 0].tolist(), g[:, 2].tolist(), strict=True))
        items = np.array(sorted(bounds), dtype=np.int64)
        size = 1 + max([int(x[:, 0].max()) for x in lists] + [int(x[:, 0].max()) for x in have if len(x)], default=0)
        sums = np.zeros((len(items), size), dtype=np.int64)
        for item, rows in zip(bundle["item"].tolist(), have, strict=True):
            sums[np.searchsorted(items, item), rows[:, 0]] = rows[:, 1]
        for g, x in zip(given, lists, strict=True):
            doc, tf, n = x[:, 0], x[:, 1], x[:, 2]
            part = (1_000_000_000 * tf) // (1000 * tf + 20 * (50 + (50 * n * documents) // total))
            at = np.searchsorted(items, g[:, 0])
            for weight in np.unique(g[:, 1]):                                              # one weight a term
                sums[at[:, None], doc[None, :]] += weight * part
        out = []
        for i, item in enumerate(items.tolist()):
            row = sums[i]
            held = np.flatnonzero(row)
            if len(held) > top:
                least = np.partition(row[held], len(held) - top)[len(held) - top]
                held = held[row[held] + bounds[item] >= least]
            if len(held):
                out.append((shard, number, item, bounds[item], np.stack([held, row[held]], axis=1).astype("<i8").tobytes()))
        return pd.DataFrame(out, columns=["shard", "bundle", "item", "bound", "found"])

    return run


_BUNDLES = "shard bigint, bundle int, item bigint, bound bigint, found binary"


def _weighed(terms: DataFrame, df: DataFrame, documents: int, total: int) -> DataFrame:
    """(term, stage, bundle, wants): the items of each bundle that want a term, with its weight and
    the most that the terms of later stages can add to each item."""
    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2.0) / (2.0 * F.col("df") + 1.0)))
    stage = F.lit(len(STAGES))
    for i in reversed(range(len(STAGES))):
        stage = F.when(F.col("w") >= STAGES[i], i).otherwise(stage)
    most = F.expr("(1000000000L * most) div (1000L * most + 20L * m)") * F.greatest("w", F.lit(0))
    df = df.withColumn("w", weight.cast("long")).withColumn("m", spread("least", documents, total)).select(
        "term", "w", stage.alias("stage"), most.alias("most"))
    rows = terms.join(df, "term")
    later = Window.partitionBy("item").orderBy(F.col("stage").desc()).rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("bound", F.coalesce(F.sum("most").over(later), F.lit(0)))

    return rows.groupBy("term", "bundle", "stage").agg(
        F.flatten(F.collect_list(F.array("item", "w", "bound"))).alias("wants"))    # three numbers an item of the bundle


def search(docs: DataFrame, items: DataFrame, top: int = 50) -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank, doc_id, score.

    Terms are runs of digits, ASCII letters and characters from U+0080 on, A-Z lower-cased, and are
    told apart by 64-bit hashes. A document's score is the sum over the item's terms, once each, of
    w * ((10**9 * tf) div (1000 * tf + 20 * m)), with w and m as in ``_weighed`` and ``spread``;
    only scores above 0 are ranked, ties by doc_id (null last). Every row is a document; rows
    repeated are ranked each; items with one item_id (null too) are one item; null and empty texts
    have no terms. Whole texts are read; other columns are not looked at; no documents or no items
    give no rows. What a task holds is bounded by a shard's documents times ``BUNDLE`` items.
    """
    spark = docs.sparkSession
    known, _ = materialize(items.select("item_id").distinct().select("item_id", F.monotonically_increasing_id().alias("item")), "items")
    rows = items.select(F.col("item_id").alias("of"), "text").join(known, F.col("of").eqNullSafe(F.col("item_id"))).select("item", "text")
    bundles = max(1, -(-known.count() // BUNDLE))
    terms = rows.mapInArrow(_terms, "item bigint, term bigint").distinct()
    terms, terms_at = materialize(terms.withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int")), "terms")
    slots = terms.select(F.shiftrightunsigned("term", 64 - FILTER_BITS).alias("slot")).distinct().toPandas()["slot"]  # 2**22 at most
    bits = np.zeros(1 << FILTER_BITS, dtype=np.uint8)
    bits[slots.to_numpy(dtype=np.int64)] = 1
    shared = spark.sparkContext.broadcast(np.packbits(bits).tobytes())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index, _ = materialize(rows.mapInArrow(lambda it: _index(it, shared), INDEX), "index")
    names = index.where("term IS NULL").select("shard", F.posexplode("names").alias("doc", "doc_id"))
    heads = index.where("term IS NULL").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    documents, total = heads.n or 0, heads.total or 0
    df = index.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("df"), F.max("most").alias("most"), F.min("least").alias("least"))
    wants, wants_at = materialize(_weighed(terms, df, documents, total), "wants")
    release(spark, terms_at)
    state = spark.createDataFrame([], _BUNDLES)
    work = _stage(documents, total, top)
    for stage in range(len(STAGES) + 1):
        owned = index.where("term IS NOT NULL").join(wants.where(F.col("stage") == stage), "term").select("shard", "bundle", "wants", "data")
        state = state.groupBy("shard", "bundle").cogroup(owned.groupBy("shard", "bundle")).applyInPandas(work, _BUNDLES)
    found = state.mapInArrow(_unpacked, "item bigint, shard bigint, doc int, score bigint")
    found, _ = materialize(found.join(names, ["shard", "doc"]).select("item", "doc_id", "score"), "found")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(known, "item").select("item_id", "rank", "doc_id", "score")


def _unpacked(batches):
    for batch in batches:
        found = [np.frombuffer(x.as_py(), "<i8").reshape(-1, 2) for x in batch.column("found")]
        if not found:
            continue
        sizes = [len(x) for x in found]
        pairs = np.concatenate(found)
        yield pa.RecordBatch.from_pydict({
            "item": pa.array(np.repeat(np.asarray(batch.column("item")), sizes), pa.int64()),
            "shard": pa.array(np.repeat(np.asarray(batch.column("shard")), sizes), pa.int64()),
            "doc": pa.array(pairs[:, 0], pa.int32()), "score": pa.array(pairs[:, 1], pa.int64())})
