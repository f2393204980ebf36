"""Benchmark decontamination: a broadcast set of window hashes, scanned against every text.

Each benchmark item gives its runs of ``k`` words (an item of fewer words gives one run of all).
Texts are scanned with running window hashes; hashes found in the set are verified against the
words themselves. The set is broadcast in parts of at most ``PART`` windows. One pass over the texts
goes through the parts in turn, and a task holds one part at a time. Nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import Words, slices, words_of
from .columns import apart, column

K = 13
PART = 1_000_000
GROUP = 16           # slices that a part goes over before the next part is taken
_BITS = 22


def _window_table(batches, k):
    """Windows of benchmark items: hash, number of words, the words, the item."""
    for batch in slices(batches):
        w = words_of(batch.column("text"))
        items = batch.column("item_id").to_pylist()
        counts = w.per_text()
        raw = w.data.tobytes()
        out = defaultdict(list)
        for n in range(1, k + 1):
            first, hashes = w.windows(n)
            if n < k:
                whole = counts[w.doc[first]] == n
                first, hashes = first[whole], hashes[whole]
            out["hash"] += hashes.view(np.int64).tolist()
            out["n"] += [n] * len(first)
            out["words"] += [_words(raw, w, i, n) for i in first.tolist()]
            out["item"] += [items[d] for d in w.doc[first].tolist()]
        if out:
            yield pa.RecordBatch.from_pydict({
                "hash": pa.array(out["hash"], pa.int64()), "n": pa.array(out["n"], pa.int32()),
                "words": pa.array(out["words"], pa.binary()), "item": pa.array(out["item"], pa.string())})


def _words(raw: bytes, w: Words, first: int, n: int) -> bytes:
    return b" ".join(raw[w.start[i]: w.end[i]] for i in range(first, first + n)).lower()


class Windows:
    """A bounded part of the benchmark's windows, with a bit table in front of the exact one."""

    def __init__(self, rows: pa.Table):
        self.exact: dict[bytes, list[str]] = defaultdict(list)
        for words, item in zip(rows.column("words").to_pylist(), rows.column("item").to_pylist(), strict=True):
            self.exact[words].append(item)
        sizes, hashes = rows.column("n").to_numpy(), rows.column("hash").to_numpy()
        self.tables = {}
        for n in np.unique(sizes).tolist():
            sorted_hashes = np.unique(hashes[sizes == n].view(np.uint64))
            bits = np.zeros(1 << _BITS, dtype=bool)
            bits[(sorted_hashes >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.tables[n] = (bits, sorted_hashes)

    def hits(self, w: Words):
        """Verified occurrences: (first word, number of words, items)."""
        raw, seen = None, {}
        for n, (bits, table) in self.tables.items():
            first, hashes = w.windows(n)
            near = np.flatnonzero(bits[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
            at = np.minimum(np.searchsorted(table, hashes[near]), len(table) - 1)
            for i in first[near[table[at] == hashes[near]]].tolist():
                if raw is None:
                    raw = w.data.tobytes()
                span = raw[w.start[i]: w.end[i + n - 1]]  # most hits repeat a span seen before
                if span not in seen:
                    seen[span] = self.exact.get(_words(raw, w, i, n))
                if seen[span]:
                    yield i, n, seen[span]


def scan(docs: DataFrame, benchmark: DataFrame, k: int = K, part: int = PART) -> DataFrame:
    """Words of each row's text inside occurrences of benchmark windows.

    Adds to every row of ``docs`` (which needs a column text): ``n_words``, ``hit_spans``
    (array of [first word, end word), disjoint and ascending), ``hit_items`` (distinct item ids
    as strings) and ``n_hit``. Null or empty texts have no words; null and empty items have no
    windows; repeated items count once by id (a null id is left out of ``hit_items``); an empty
    benchmark hits nothing. Other columns pass through, whatever their names, but for columns named as
    the results.
    """
    own, back = apart(docs, "text")
    spark = docs.sparkSession
    table = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text")).mapInArrow(
        lambda it: _window_table(it, k), "hash long, n int, words binary, item string").distinct().persist()
    parts = max(1, -(-table.count() // part))
    df = own.withColumns({"hit_spans": F.expr("CAST(array() AS array<struct<first:int,end:int>>)"),
                           "hit_items": F.expr("CAST(array() AS array<string>)"), "n_words": F.lit(0).cast("long")})
    shared = []
    for p in range(parts):      # at most some PART windows at a time on the driver
        rows = table.where(F.pmod("hash", F.lit(parts)) == p).select("hash", "n", "words", "item").toArrow()
        shared.append(spark.sparkContext.broadcast(_packed(rows)))
    df = df.mapInArrow(lambda it: _scan(it, shared), df.schema)
    table.unpersist()
    return back(df.withColumn("n_hit", F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["first"]))), "n_words", "hit_spans", "hit_items", "n_hit")


def _packed(rows: pa.Table) -> bytes:
    """A part of the windows as one compressed Arrow stream: what a broadcast of it costs in bytes."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(rows)
    return out.getvalue().to_pybytes()


def _unpacked(raw: bytes) -> Windows:
    return Windows(pa.ipc.open_stream(raw).read_all())


class _Slice:
    """A slice of texts while the parts of the windows go over it."""

    def __init__(self, batch: pa.RecordBatch):
        self.batch, self.words = batch, words_of(batch.column("text"))
        self.edge = np.zeros(len(self.words.doc) + 1, dtype=np.int32)
        self.items: dict[int, set[str]] = defaultdict(set)

    def pass_over(self, part: Windows) -> None:
        for i, length, of in part.hits(self.words):
            self.edge[i] += 1
            self.edge[i + length] -= 1
            self.items[int(self.words.doc[i])].update(x for x in of if x is not None)

    def result(self) -> pa.RecordBatch:
        batch, counts = self.batch, self.words.per_text()
        spans, items = batch.column("hit_spans").to_pylist(), batch.column("hit_items").to_pylist()
        begins = np.concatenate([[0], np.cumsum(counts)])
        inside = np.cumsum(self.edge[:-1]) > 0
        for doc, found in self.items.items():
            step = np.diff(np.concatenate([[0], inside[begins[doc]: begins[doc + 1]].astype(np.int8), [0]]))
            spans[doc] = [{"first": int(a), "end": int(b)} for a, b in zip(
                np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True)]
            items[doc] = sorted(found)
        new = {"hit_spans": spans, "hit_items": items, "n_words": counts}
        return pa.RecordBatch.from_arrays([
            pa.array(new[f.name], type=f.type) if f.name in new else batch.column(f.name)
            for f in batch.schema], schema=batch.schema)


def _scan(batches, shared):
    """Rows with their hits. A task holds one part of the windows: a single one for all its rows, several
    in turn for each group of ``GROUP`` slices."""
    single = _unpacked(shared[0].value) if len(shared) == 1 else None
    group: list[_Slice] = []

    def done():
        for part in shared:
            windows = single or _unpacked(part.value)
            for one in group:
                one.pass_over(windows)
        yield from (one.result() for one in group)

    for batch in slices(batches):
        group.append(_Slice(batch))
        if single or len(group) == GROUP:
            yield from done()
            group = []
    if group:
        yield from done()


def judged(scanned: DataFrame, ratio: int = 20) -> DataFrame:
    """Add n_items, items_sha256 and contaminated (n_hit > 0 and ratio * n_hit >= n_words)."""
    return scanned.withColumns({
        "n_items": F.size("hit_items").cast("long"),
        "items_sha256": F.sha2(F.array_join(F.array_sort("hit_items"), ",").cast("binary"), 256),
        "contaminated": (F.col("n_hit") > 0) & (F.col("n_hit") * ratio >= F.col("n_words"))})


def without_spans(scanned: DataFrame) -> DataFrame:
    """Remove the hit words from the texts of scanned rows; other texts stay byte for byte."""
    def cut(batches):
        for batch in slices(batches):
            w = words_of(batch.column("text"))
            begins = np.concatenate([[0], np.cumsum(w.per_text())])
            raw, texts = w.data.tobytes(), batch.column("text").to_pylist()
            for doc, spans in enumerate(batch.column("hit_spans").to_pylist()):
                if spans:
                    at, kept = int(w.offsets[doc]), []
                    for s in spans:
                        kept.append(raw[at: w.start[begins[doc] + s["first"]]])
                        at = int(w.end[begins[doc] + s["end"] - 1])
                    texts[doc] = b"".join([*kept, raw[at: w.offsets[doc + 1]]]).decode()
            yield pa.RecordBatch.from_arrays([pa.array(texts, type=f.type) if f.name == "text" else batch.column(f.name)
                                              for f in batch.schema], schema=batch.schema)
    own, back = apart(scanned, "text", "hit_spans")
    return back(own.mapInArrow(cut, own.schema), "text").select(*[column(c) for c in scanned.columns])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns.

    Rows are judged one by one; only their text is looked at, so null ids, repeated rows and
    extra columns pass as they are.
    """
    own, back = apart(docs, "text")
    return back(judged(scan(own, benchmark)).where("NOT contaminated"))
