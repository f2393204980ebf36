"""Language ID with bit-sliced Bloom filters of byte 4-grams.

A slot of the filter holds one bit per language (64 to a word), so one read of a slot's word
answers for all languages whether they may hold an n-gram; the words of an n-gram's slots are
and-ed. Per language, the share of a text's n-grams it holds is corrected by the filter's false
positive rate; the largest share decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import slices, utf8
from .columns import apart

SLOT_BITS = 21
FACTORS = (0x2C1B3C6D, 0x297A2D39, 0x7FEB352D)   # odd multipliers of the slot hashes
LEAST_RATE, LEAST_SHARE = 1e-6, 0.25

_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and code of each byte 4-gram of letters and single blanks around them."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    sizes = np.diff(offsets) + 3                     # one blank before a text, two after it
    begins = np.concatenate([[0], np.cumsum(sizes)])
    folded = np.full(int(begins[-1]) + 3, 32, dtype=np.uint8)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    folded[np.arange(len(data)) + 3 * owner + 1] = _FOLD[data]
    wide = folded.astype(np.uint32)
    codes = wide[:-3] | wide[1:-2] << np.uint32(8) | wide[2:-1] << np.uint32(16) | wide[3:] << np.uint32(24)
    doc = np.repeat(np.arange(n), sizes)
    own = np.ones(len(codes), dtype=bool)
    for back in (1, 2, 3):
        own[begins[1:] - back] = False
    blank = folded == 32
    own &= ~(blank[:-3] & blank[1:-2] | blank[1:-2] & blank[2:-1])
    return doc[own], codes[own]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of the rows of a task, summed up in memory of bounded size."""
    names: dict[str, int] = {}
    keys, sums = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def out():
        by_number = list(names)
        for at in range(0, len(keys), 100_000):
            part = keys[at: at + 100_000]
            langs = pa.DictionaryArray.from_arrays(pa.array((part >> np.uint64(32)).astype(np.int32)), pa.array(by_number)).cast(pa.string())
            yield pa.RecordBatch.from_pydict({"lang": langs, "gram": pa.array((part & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                                              "n": pa.array(sums[at: at + 100_000])})

    for batch in slices(batches):
        doc, codes = grams(batch.column("text"))
        number = np.array([names.setdefault(x, len(names)) for x in batch.column("lang").to_pylist()], dtype=np.uint64)
        new, n = np.unique(number[doc] << np.uint64(32) | codes, return_counts=True)
        keys, back = np.unique(np.concatenate([keys, new]), return_inverse=True)
        sums = np.bincount(back, np.concatenate([sums, n]), len(keys)).astype(np.int64)
        if len(keys) > 4_000_000:
            yield from out()
            keys, sums = keys[:0], sums[:0]
    if len(keys):
        yield from out()


class Filter:
    """Bit-sliced filter: ``planes[p][slot]`` has a bit for each of 64 languages."""

    def __init__(self, langs: list[str], planes: list[np.ndarray]):
        self.langs, self.planes = langs, planes
        fill = [((planes[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(langs))]
        self.false_rate = np.array(fill) ** len(FACTORS)

    def counts(self, doc: np.ndarray, codes: np.ndarray, texts: int) -> np.ndarray:
        """N-grams of each text that each language may hold."""
        out = np.zeros((texts, len(self.langs)))
        begins = np.flatnonzero(np.diff(doc, prepend=-1))
        if not len(begins):
            return out
        masks = []
        for p, plane in enumerate(self.planes):
            for k, factor in enumerate(FACTORS):
                word = plane[(codes * np.uint32(factor)) >> np.uint32(32 - SLOT_BITS)]
                masks.append(word) if k == 0 else masks.__setitem__(p, masks[p] & word)
        for i in range(len(self.langs)):
            bit = (masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            out[doc[begins], i] = np.add.reduceat(bit, begins)
        return out


def train(docs: DataFrame) -> Filter:
    """Filter of the n-grams of each language in ``docs`` (columns text and lang; null lang is left out).

    A language holds an n-gram that makes up at least a millionth of its n-grams, and at least a
    quarter of the share it has in the language where it is most frequent; so a language has a
    million n-grams at most. Only the filter's slots, a fixed number, reach the driver.
    """
    counted = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text").mapInArrow(
        _counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).persist()
    totals = {r.lang: r.n for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    planes = [np.zeros(1 << SLOT_BITS, dtype=np.uint64) for _ in range(-(-len(langs) // 64))]
    if langs:
        number = F.element_at(F.create_map(*[F.lit(x) for i, name in enumerate(langs) for x in (name, i)]), F.col("lang"))
        total = F.element_at(F.create_map(*[F.lit(x) for name in langs for x in (name, float(totals[name]))]), F.col("lang"))
        rates = counted.select("gram", number.alias("number"), (F.col("n") / total).alias("rate"))
        best = rates.groupBy("gram").agg(F.max("rate").alias("best"), F.collect_list(F.struct("number", "rate")).alias("all"))
        held = best.select("gram", "best", F.explode("all").alias("x")).where(
            (F.col("x.rate") >= LEAST_RATE) & (F.col("x.rate") >= LEAST_SHARE * F.col("best")))
        slots = held.select(F.floor(F.col("x.number") / 64).alias("plane"),
                            F.expr("shiftleft(1L, x.number % 64)").alias("bit"), F.explode(F.array(*[
                                F.shiftright((F.col("gram") * F.lit(f)).bitwiseAND(F.lit(0xFFFFFFFF)), 32 - SLOT_BITS)
                                for f in FACTORS])).alias("slot"))
        for r in slots.groupBy("plane", "slot").agg(F.expr("bit_or(bit)").alias("bits")).toLocalIterator():
            planes[r.plane][r.slot] = np.int64(r.bits).astype(np.uint64)
    counted.unpersist()
    return Filter(langs, planes)


def predict(docs: DataFrame, model: Filter) -> DataFrame:
    """Add lang_pred and score to every row of ``docs`` (column text), in whole.

    Null texts and texts without a letter are ``und`` with score 0; other texts get a learned
    language (the first by name among equals; if no language holds any n-gram, score 0). The
    score is the best corrected share over the sum of all. Rows are judged one by one by their
    text alone; other columns pass through, whatever their names, but for columns named as the two
    results; an empty table gives no rows.
    """
    own, back = apart(docs, "text")
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.planes))
    df = own.withColumns({"lang_pred": F.when(F.col("text").rlike(r"\p{L}"), F.lit("")).otherwise(F.lit("und")),
                           "score": F.lit(0.0)})

    def run(batches):
        known = Filter(*shared.value)
        for batch in slices(batches):
            doc, codes = grams(batch.column("text"))
            n = np.maximum(np.bincount(doc, minlength=batch.num_rows), 1)
            share = known.counts(doc, codes, batch.num_rows) / n[:, None]
            share = np.clip((share - known.false_rate) / np.maximum(1 - known.false_rate, 1e-9), 0, 1)
            best = share.argmax(axis=1) if len(known.langs) else np.zeros(batch.num_rows, int)
            score = share.max(axis=1) / np.maximum(share.sum(axis=1), 1e-12) if len(known.langs) else np.zeros(batch.num_rows)
            pred = [p if p or not known.langs else known.langs[b] for p, b in zip(batch.column("lang_pred").to_pylist(), best, strict=True)]
            pred = [p or "und" for p in pred]
            new = {"lang_pred": pa.array(pred, pa.string()),
                   "score": pa.array([0.0 if p == "und" else s for p, s in zip(pred, score.tolist(), strict=True)], pa.float64())}
            yield pa.RecordBatch.from_arrays([new.get(f.name, batch.column(f.name)) for f in batch.schema], schema=batch.schema)

    return back(df.mapInArrow(run, df.schema), "lang_pred", "score")
