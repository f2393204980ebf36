"""Near-duplicate join: Jaccard similarity of word shingles, with Bayesian candidate pruning.

1. Every text is sketched: its MinHash signature, and a digest of its word sequence by which
   copies become one representative.
2. Representatives that agree in a band of the signature share a bucket. Buckets are cut into
   blocks, and pairs of blocks are compared in tasks: MinHash values are taken a few at a time,
   and a pair is dropped when the posterior probability that its similarity reaches the
   threshold falls below a tolerance. A task returns a spanning forest of the pairs that are
   left, never the pairs.
3. Components of these forests hold all candidate pairs. Their texts are fetched once, again in
   blocks, and all pairs of each component are verified exactly on shingle sets. A task returns
   link counts and a spanning forest; components of the latter are the classes.

What one task holds is bounded by the block sizes, in texts and in shingles, whatever the size of a
bucket or component; the work on a class grows with the square of its different texts, since each
text's links are counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabquorum.sources.shared import materialize, release

from .arrays import Words, mix, slices, words_of
from .columns import apart
from .components import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 4          # a pair at 0.8 shares no band with probability 3e-6
STEP, TOLERANCE = 8, 1e-6
BLOCK = 1024                 # representatives of a block of a bucket
SET_BLOCK, TEXT_BLOCK = 400_000, 1024    # shingles and texts of a block of a component

_K = BANDS * ROWS
_A = (mix(np.arange(1, _K + 1, dtype=np.uint64)) | np.uint64(1))
_B = mix(np.arange(1001, 1001 + _K, dtype=np.uint64))


def shingles(w: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every shingle, by text; fewer than ``k`` words are one shingle."""
    first, hashes = w.windows(k)
    doc = w.doc[first]
    counts = w.per_text()
    if ((counts > 0) & (counts < k)).any():
        docs, found = [doc], [hashes]
        for n in range(1, k):
            first, hashes = w.windows(n)
            own = counts[w.doc[first]] == n
            docs.append(w.doc[first][own])
            found.append(hashes[own])
        doc, hashes = np.concatenate(docs), np.concatenate(found)
        order = np.argsort(doc, kind="stable")
        doc, hashes = doc[order], hashes[order]
    return doc, hashes


def signatures(doc: np.ndarray, hashes: np.ndarray, texts: int) -> np.ndarray:
    """MinHash values, one row a text (texts without shingles: all ones)."""
    out = np.full((texts, _K), 0xFFFFFFFF, dtype=np.uint32)
    begins = np.flatnonzero(np.diff(doc, prepend=-1))
    if len(begins):
        for i in range(_K):
            out[doc[begins], i] = np.minimum.reduceat((hashes * _A[i] + _B[i]) >> np.uint64(32), begins)
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        w = words_of(batch.column("text"))
        doc, hashes = shingles(w)
        sig = signatures(doc, hashes, batch.num_rows)
        order = np.arange(1, len(w.hash) + 1, dtype=np.uint64)
        place = order - np.concatenate([[0], np.cumsum(w.per_text())])[w.doc].astype(np.uint64)
        keys = []
        for salt in (np.uint64(0), np.uint64(0x5851F42D4C957F2D)):  # a digest of 128 bits
            part = np.zeros(batch.num_rows, dtype=np.uint64)
            np.add.at(part, w.doc, mix(mix(w.hash + salt) ^ mix(place + salt)))
            keys.append(mix(part + w.per_text().astype(np.uint64)))
        raw = np.stack(keys, axis=1).astype(">u8").view("S16").ravel()
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
            "key": pa.array([raw_.ljust(16, b"\0") for raw_ in raw.tolist()], pa.binary()),
            "n": pa.array(np.bincount(doc, minlength=batch.num_rows), pa.int32()),
            "sig": pa.array([row.tobytes() for row in sig], pa.binary())})


def posterior_floor(seen: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """Fewest equal values of ``seen`` for which P(similarity >= threshold) is not below tolerance.

    With a uniform prior the posterior is Beta(equal + 1, seen - equal + 1); its upper tail at the
    threshold is a binomial sum.
    """
    total, equal = 0.0, 0
    for j in range(seen + 2):
        total += math.comb(seen + 1, j) * threshold ** j * (1 - threshold) ** (seen + 1 - j)
        if total >= tolerance:
            equal = j
            break
    return equal


_FLOORS = [(n, posterior_floor(n)) for n in range(STEP, _K + 1, STEP)]


def prune(left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two signature blocks that survive; ``same``: i < j only."""
    out_i, out_j = [], []
    for i in range(len(left)):
        j = np.arange(i + 1 if same else 0, len(right))
        equal = np.zeros(len(j), dtype=np.int32)
        for seen, floor in _FLOORS:
            equal += (right[j, seen - STEP: seen] == left[i, seen - STEP: seen]).sum(axis=1)
            stay = equal >= floor
            j, equal = j[stay], equal[stay]
            if not len(j):
                break
        out_i.append(np.full(len(j), i))
        out_j.append(j)
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (np.zeros(0, int), np.zeros(0, int))


def forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a graph: each node but one of a component, with its smallest."""
    root = np.arange(n)
    while len(i):
        a, b = root[i], root[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    return [(int(x), int(root[x])) for x in np.flatnonzero(root != np.arange(n))]


def _compared(sig: list[bytes], side: np.ndarray, left: int, right: int):
    rows = np.frombuffer(b"".join(sig), dtype=np.uint32).reshape(len(sig), _K)
    a = np.flatnonzero(side == left)
    if left == right:
        i, j = prune(rows[a], rows[a], True)
        return a[i], a[j]
    b = np.flatnonzero(side == right)
    i, j = prune(rows[a], rows[b], False)
    return a[i], b[j]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning forests of the surviving pairs of the two blocks of each row."""
    for batch in batches:
        a, b = [], []
        for left, right, members in zip(*(batch.column(c).to_pylist() for c in ("left", "right", "members")), strict=True):
            keys = [m["key"] for m in members]
            i, j = _compared([m["sig"] for m in members], np.array([m["block"] for m in members]), left, right)
            for x, y in forest(len(keys), i, j):
                a.append(max(keys[x], keys[y]))
                b.append(min(keys[x], keys[y]))
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def intersections(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets: a row by column matrix, by column chunks of values."""
    picked = np.concatenate([rows, cols]) if rows is not cols else rows
    values = np.concatenate([sets[x] for x in picked]) if len(picked) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(picked)), [len(sets[x]) for x in picked])
    _, value, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count[value] > 1
    value, owner = value[shared], owner[shared]
    _, value = np.unique(value, return_inverse=True)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    out = np.zeros((len(rows), len(cols)), dtype=np.float32)
    width, n = 2048, int(value[-1]) + 1 if len(value) else 0
    for at in range(0, n, width):
        a, b = np.searchsorted(value, [at, at + width])
        part = np.zeros((len(picked), width), dtype=np.float32)
        part[owner[a:b], value[a:b] - at] = 1
        out += part[: len(rows)] @ part[len(picked) - len(cols):].T
    return out


def _verified(group: pd.DataFrame) -> pd.DataFrame:
    """Exact links of two blocks of a component: counts by text, and a spanning forest."""
    head = group.iloc[0]
    side = group["block"].to_numpy()
    sets = [np.frombuffer(x, dtype=np.uint64) for x in group["set"]]
    a, b = np.flatnonzero(side == head["left"]), np.flatnonzero(side == head["right"])
    same = head["left"] == head["right"]
    common = intersections(sets, a, a if same else b)
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    union = sizes[a][:, None] + sizes[a if same else b][None, :] - common
    linked = common >= THRESHOLD * union - 1e-9
    if same:
        np.fill_diagonal(linked, False)
    i, j = np.nonzero(linked)
    i, j = a[i], (a if same else b)[j]
    copies = group["copies"].to_numpy()
    texts, rows = np.zeros(len(group), dtype=np.int64), np.zeros(len(group), dtype=np.int64)
    np.add.at(texts, i, 1)
    np.add.at(rows, i, copies[j])
    if not same:
        np.add.at(texts, j, 1)
        np.add.at(rows, j, copies[i])
    keys = group["key"].tolist()
    to = dict(forest(len(keys), i, j))
    at = np.flatnonzero(texts)
    return pd.DataFrame({"key": [keys[x] for x in at], "other": [keys[to.get(int(x), x)] for x in at],
                         "texts": texts[at], "rows": rows[at]})


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        doc, hashes = shingles(words_of(batch.column("text")))
        cut = np.searchsorted(doc, np.arange(batch.num_rows + 1))
        sets = [np.unique(hashes[a:b]).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(sets, pa.binary()) if f == "text" else batch.column(f)
                                          for f in batch.schema.names],
                                         names=["set" if f == "text" else f for f in batch.schema.names])


def _paired(df: DataFrame, blocks: Column, key: str) -> DataFrame:
    """Deal rows (group, key) to pairs of hash blocks of their group: left <= right, own block."""
    df = df.withColumn("n_blocks", blocks).withColumn("block", F.pmod(F.xxhash64(key), F.col("n_blocks")).cast("int"))
    df = df.withColumn("o", F.explode(F.sequence(F.lit(0), (F.col("n_blocks") - 1).cast("int"))))
    return df.withColumns({"left": F.least("block", "o"), "right": F.greatest("block", "o")}).drop("o", "n_blocks")


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, key, n, sig) of every row: text digest, shingles and signature."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        _sketch, "doc_id bigint, text_hash bigint, key binary, n int, sig binary")


def near_classes(docs: DataFrame) -> DataFrame:
    """Near-duplicate classes: one row per row, with its class and its links.

    Texts are compared as sets of five-word shingles (words of ``arrays``; a text of one to four
    words is one shingle); two are linked at a Jaccard similarity of 0.8 or more, and classes are
    the connected components. Returns doc_id, text_hash, class_id (smallest doc_id of the class),
    n_links (other rows at 0.8 or more, copies included), n_texts (different texts among them),
    n_copies (rows with the same words). Texts without words (null, empty, no word character)
    are linked to nothing and are classes of their own, as are rows without a doc_id, whose
    class_id is null. Repeated rows are copies. Other columns are not looked at; an empty table
    gives no rows.
    """
    rows, _ = materialize(sketches(docs), "sketches")
    usable = rows.where("n > 0 AND doc_id IS NOT NULL")
    texts = usable.groupBy("key").agg(
        F.min_by(F.struct("doc_id", "text_hash"), F.struct("doc_id", "text_hash")).alias("rep"),
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    texts, texts_at = materialize(texts, "texts")

    # buckets of two texts or more, cut into blocks
    bands = texts.select("key", F.posexplode(F.array(*[
        F.xxhash64(F.lit(i), F.substring("sig", 1 + 4 * ROWS * i, 4 * ROWS)) for i in range(BANDS)])).alias("band", "bucket")).drop("band")
    sizes = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = bands.join(sizes, "bucket")
    dealt = _paired(members, F.ceil(F.col("size") / BLOCK), "key").drop("size")
    dealt = dealt.join(texts.select("key", "sig"), "key")
    pairs = dealt.groupBy("bucket", "left", "right").agg(  # two blocks: some 2 * BLOCK members at most
        F.collect_list(F.struct("key", "block", "sig")).alias("members")).where("size(members) > 1")
    found = pairs.mapInArrow(_candidates, "a binary, b binary")
    candidates = components(found)

    # texts of each component, fetched once, verified in blocks
    grouped = texts.select("key", "rep", "copies", "n").join(candidates, F.col("key") == F.col("node")).drop("node")
    weight = grouped.groupBy("root").agg(F.greatest(F.sum("n") / SET_BLOCK, F.count("*") / TEXT_BLOCK).alias("total"))
    wanted = grouped.join(weight, "root").select(
        F.col("rep.doc_id").alias("doc_id"), F.col("rep.text_hash").alias("text_hash"), "key", "root", "copies", "total")
    source = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    sets = source.join(wanted, ["doc_id", "text_hash"]).select("key", "root", "copies", "total", "text").mapInArrow(
        _sets, "key binary, root binary, copies bigint, total double, set binary").dropDuplicates(["key"])
    sets, sets_at = materialize(sets, "sets")
    blocks = F.greatest(F.ceil("total"), F.lit(1))
    links = _paired(sets, blocks, "key").drop("total").groupBy("root", "left", "right").applyInPandas(
        _verified, "key binary, other binary, texts bigint, rows bigint")
    links, links_at = materialize(links, "links")
    release(docs.sparkSession, sets_at)
    counts = links.groupBy("key").agg(F.sum("texts").alias("texts"), F.sum("rows").alias("rows"))
    roots = components(links.select(F.col("key").alias("a"), F.col("other").alias("b")))
    classes = texts.select("key", "first_id", "copies").join(roots, F.col("key") == F.col("node"), "left").join(counts, "key", "left")
    classes = classes.select("key", "first_id", "copies", F.coalesce("root", "key").alias("root"),
                             F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("rows", F.lit(0)).alias("rows"))
    named = classes.groupBy("root").agg(F.min("first_id").alias("class_id"))
    classes = classes.join(named, "root").select("key", "class_id", "copies", "texts", "rows")
    classes, _ = materialize(classes, "classes")
    for path in (texts_at, links_at):
        release(docs.sparkSession, path)
    alone = F.col("class_id").isNull() | (F.col("n") == 0) | F.col("doc_id").isNull()
    return rows.drop("sig").join(classes, "key", "left").select(
        "doc_id", "text_hash", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, 0).otherwise(F.col("rows") + F.col("copies") - 1).cast("long").alias("n_links"),
        F.when(alone, 0).otherwise(F.col("texts")).cast("long").alias("n_texts"),
        F.when(alone, 1).otherwise(F.col("copies")).cast("long").alias("n_copies"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without all but one of each class: the one with the smallest doc_id.

    Rows without words (null and empty texts too) or without a doc_id stay; rows keep all their
    columns, whatever these are called. Of rows equal in doc_id and text one stays; a doc_id repeated
    with different texts stays with each of them. Very long texts are compared whole; an empty table
    gives no rows.
    """
    own, back = apart(docs, "doc_id", "text")
    hashed = own.withColumn("hash", F.xxhash64("text")).drop("text")
    rows, near_at = materialize(near_classes(docs.select("doc_id", "text")), "near")
    kept = rows.where("doc_id IS NULL OR class_id = doc_id").groupBy("doc_id", "text_hash").agg(
        F.count("*").alias("times")).withColumnsRenamed({"doc_id": "id", "text_hash": "of"})
    joined = hashed.join(kept, hashed["doc_id"].eqNullSafe(kept["id"]) & (hashed["hash"] == kept["of"]))
    once, more = joined.where("times = 1 OR doc_id IS NULL"), joined.where("times > 1 AND doc_id IS NOT NULL")
    return back(once).union(back(more.dropDuplicates(["doc_id", "hash"])))
