"""Exact dedup by a cuckoo-filter index of live digests.

A signature stands for a text: SHA-256 of the text without blanks, a second 64-bit hash and the
length. The index is cut into shards by signature. A shard is a cuckoo filter of 16-bit
fingerprints, four to a bucket, whose entries refer to the signatures stored beside it: a
fingerprint hit is verified against the stored signature, an entry can be deleted, and a filter
that overflows is rebuilt with twice the buckets from the stored signatures.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabquorum.sources.shared import materialize

BLANKS = " \t\n\x0b\f\r"
SLOTS, KICKS = 4, 200
FLUSH = 1_000_000    # signatures a task combines before it passes them on


class CuckooIndex:
    """Signatures with a payload each; membership by fingerprint, verified by signature."""

    def __init__(self, buckets: int = 64):
        self.keys: list[bytes | None] = []
        self.free: list[int] = []
        self.resizes = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints = [0] * (buckets * SLOTS)
        self.refs = [-1] * (buckets * SLOTS)

    def __len__(self) -> int:
        return len(self.keys) - len(self.free)

    def _places(self, key: bytes) -> tuple[int, int, int]:
        head = int.from_bytes(key[:8], "big")
        print_ = (head & 0xFFFF) or 1
        first = (head >> 16) & self.mask
        return print_, first, self._other(first, print_)

    def _other(self, bucket: int, print_: int) -> int:
        return bucket ^ ((print_ * 0x5BD1E995) & self.mask)

    def find(self, key: bytes) -> int:
        """Slot of a live signature, or -1."""
        print_, first, second = self._places(key)
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.prints[slot] == print_ and self.keys[self.refs[slot]] == key:
                    return slot
        return -1

    def insert(self, key: bytes) -> tuple[int, bool]:
        """Number of the signature, and whether it is new."""
        slot = self.find(key)
        if slot >= 0:
            return self.refs[slot], False
        if self.free:
            ref = self.free.pop()
            self.keys[ref] = key
        else:
            ref = len(self.keys)
            self.keys.append(key)
        if not self._place(key, ref):
            self._rebuild()
        return ref, True

    def delete(self, key: bytes) -> int:
        """Number of the signature that was live and no longer is, or -1."""
        slot = self.find(key)
        if slot < 0:
            return -1
        ref = self.refs[slot]
        self.prints[slot], self.refs[slot], self.keys[ref] = 0, -1, None
        self.free.append(ref)
        return ref

    def _place(self, key: bytes, ref: int) -> bool:
        print_, first, second = self._places(key)
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[slot]:
                    self.prints[slot], self.refs[slot] = print_, ref
                    return True
        bucket = second
        for kick in range(KICKS):
            slot = bucket * SLOTS + (kick + ref) % SLOTS
            print_, self.prints[slot] = self.prints[slot], print_
            ref, self.refs[slot] = self.refs[slot], ref
            bucket = self._other(bucket, print_)
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[slot]:
                    self.prints[slot], self.refs[slot] = print_, ref
                    return True
        return False

    def _rebuild(self) -> None:
        buckets = (self.mask + 1) * 2
        while True:
            self.resizes += 1
            self._clear(buckets)
            if all(self._place(key, ref) for ref, key in enumerate(self.keys) if key is not None):
                return
            buckets *= 2


def signature(text: Column) -> Column:
    """48 bytes for a text without its blanks: SHA-256, xxhash64 and length."""
    bare = F.translate(F.coalesce(text, F.lit("")), BLANKS, "")
    return F.concat(F.unhex(F.sha2(bare.cast("binary"), 256)), F.unhex(F.lpad(F.hex(F.xxhash64(bare)), 16, "0")),
                    F.unhex(F.lpad(F.hex(F.length(bare).cast("long")), 16, "0")))


def _better(a: tuple, b: tuple) -> tuple:
    """The row that stays: most code points, then smallest doc_id (null last), then first row."""
    rank = lambda x: (-x[0], x[1] is None, x[1] or 0, x[2])
    return a if rank(a) <= rank(b) else b


_GROUP = "sig binary, size bigint, n_chars bigint, keep_id bigint, keep_row bigint"


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Insert rows (of one document or of a group) into an index; one row per signature."""
    index, size, best = CuckooIndex(), [], []

    def groups():
        for at in range(0, len(index.keys), 10_000):
            part = slice(at, at + 10_000)
            yield pa.RecordBatch.from_pydict({
                "sig": pa.array(index.keys[part], pa.binary()), "size": pa.array(size[part], pa.int64()),
                **{name: pa.array([b[i] for b in best[part]], pa.int64())
                   for i, name in enumerate(("n_chars", "keep_id", "keep_row"))}})

    for batch in batches:
        for key, n, *row in zip(*(batch.column(c).to_pylist() for c in ("sig", "size", "n_chars", "keep_id", "keep_row")), strict=True):
            ref, new = index.insert(key)
            if new:
                size.append(n)
                best.append(tuple(row))
            else:
                size[ref] += n
                best[ref] = _better(best[ref], tuple(row))
        if len(index) > FLUSH:
            yield from groups()
            index, size, best = CuckooIndex(), [], []
    yield from groups()


def _combine_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As ``_combine`` for a partition that has all rows of its signatures, sorted by them."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        table = pa.Table.from_batches([*rest, batch])
        last = table.column("sig")[-1].as_py()
        keys = table.column("sig").to_pylist()
        cut = next((i for i in range(len(keys) - 1, -1, -1) if keys[i] != last), -1) + 1
        done = table.slice(0, cut).combine_chunks().to_batches()
        if done:
            yield from _combine(iter(done))
        rest = [b for b in _combine(iter(table.slice(cut).combine_chunks().to_batches()))]
    yield from rest


def text_groups(rows: DataFrame) -> DataFrame:
    """Groups of equal signatures: (sig, size, n_chars, keep_id, keep_row).

    ``rows`` has sig, n_chars, doc_id and row. Tasks insert their rows into an index of their own
    first, so a signature that a third of all rows share leaves each task as one row; then the
    shards of the index combine these.
    """
    one = rows.select("sig", F.lit(1).cast("long").alias("size"), "n_chars", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"))
    dealt = one.mapInArrow(_combine, _GROUP).repartition("sig").sortWithinPartitions("sig")
    return dealt.mapInArrow(_combine_shard, _GROUP)


def dedup(docs: DataFrame) -> DataFrame:
    """Exact duplicates: doc_id, keep_id, group_size, kept, text_sha256 of every row.

    Texts are equal if they are after deleting space and ``\\t`` to ``\\r``; null counts as empty.
    Of equal texts the row with the most code points stays, then the smallest doc_id (null last);
    of rows equal in both, one (the first as read). Dropped rows are returned too; other columns
    are not looked at; an empty table gives no rows. Signatures are written to the shared folder
    once; texts are never shuffled.
    """
    rows = docs.select("doc_id", signature(F.col("text")).alias("sig"), F.monotonically_increasing_id().alias("row"),
                       F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"))
    rows, _ = materialize(rows, "signatures")
    groups, _ = materialize(text_groups(rows).where("size > 1"), "groups")
    joined = rows.join(groups.select("sig", "size", "keep_id", "keep_row"), "sig", "left")
    alone = F.col("size").isNull()
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex(F.substring("sig", 1, 32))).alias("text_sha256"))


INDEX = "shard int, buckets int, live bigint, signatures binary"


def update_index(index: DataFrame | None, changes: DataFrame, shards: int) -> DataFrame:
    """A stored index after insertions and deletions: rows (shard, buckets, live, signatures).

    ``changes`` has sig and ``live``: true inserts a signature, false deletes it; of several
    changes to one signature a deletion wins. Inserting a live signature and deleting one that is
    not change nothing. ``shards`` must be the same for all updates of an index.
    """
    spark = changes.sparkSession
    index = spark.createDataFrame([], INDEX) if index is None else index
    merged = changes.groupBy("sig").agg(F.min("live").alias("live")).withColumn(
        "shard", F.pmod(F.xxhash64("sig"), F.lit(shards)).cast("int"))

    def apply(key, stored: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        filter_ = CuckooIndex(int(stored["buckets"].iloc[0]) if len(stored) else 64)
        for raw in stored["signatures"]:
            for at in range(0, len(raw), 48):
                filter_.insert(raw[at: at + 48])
        for sig, live in zip(new["sig"], new["live"], strict=True):
            filter_.insert(bytes(sig)) if live else filter_.delete(bytes(sig))
        raw = b"".join(k for k in filter_.keys if k is not None)
        return pd.DataFrame({"shard": [key[0]], "buckets": [filter_.mask + 1], "live": [len(filter_)], "signatures": [raw]})

    return index.groupBy("shard").cogroup(merged.groupBy("shard")).applyInPandas(apply, INDEX)


def probe_index(index: DataFrame, sigs: DataFrame, shards: int) -> DataFrame:
    """Whether each signature is live: rows (sig, live), by shard."""
    asked = sigs.select("sig").distinct().withColumn("shard", F.pmod(F.xxhash64("sig"), F.lit(shards)).cast("int"))

    def look(_, stored: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        filter_ = CuckooIndex(int(stored["buckets"].iloc[0]) if len(stored) else 64)
        for raw in stored["signatures"]:
            for at in range(0, len(raw), 48):
                filter_.insert(raw[at: at + 48])
        return pd.DataFrame({"sig": new["sig"], "live": [filter_.find(bytes(s)) >= 0 for s in new["sig"]]})

    return index.groupBy("shard").cogroup(asked.groupBy("shard")).applyInPandas(look, "sig binary, live boolean")
