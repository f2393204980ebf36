"""Quality classifier: ordinal cumulative-link regression over hashed text features.

Grades are ordered; one weight per hashed feature is shared by all of them and ordered thresholds
part them: P(grade > k) = sigmoid(w.x - t_k). Features are present or not: words, beginnings of
words, ends of blank-separated tokens, and coarse shape of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import mix, slices, words_of
from .columns import apart

TRAIN_ROWS = 20_000      # labelled rows the model is fitted on, at most
LEAST_TEXTS, LEAST_Z = 5, 4.0
STEPS, RIDGE = 300, 1e-4
FIT_BLOCK = 1 << 20
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _sides(data: np.ndarray, at: np.ndarray, ok: np.ndarray, salt: int) -> np.ndarray:
    """Hash of the bytes at the places of each row of ``at``, where ``ok``."""
    code = np.zeros(len(at), dtype=np.uint64)
    for i in range(at.shape[1]):
        code = code << np.uint64(8) | np.where(ok[:, i], data[np.where(ok[:, i], at[:, i], 0)], 0).astype(np.uint64)
    return mix(code + np.uint64(salt << 56))


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of each feature; a feature may be repeated."""
    w = words_of(column)
    n = w.texts
    if not len(w.data):
        return np.arange(n), mix(np.full(n, (9 << 48), dtype=np.uint64))
    lower = np.where((w.data >= 65) & (w.data <= 90), w.data + 32, w.data).astype(np.uint8)
    docs, out = [w.doc], [w.hash]
    code, length = np.zeros(len(w.start), dtype=np.uint64), w.end - w.start
    for i in range(6):       # beginnings of four, five and six bytes share their first steps
        byte = lower[np.minimum(w.start + i, len(lower) - 1)]
        code = code << np.uint64(8) | np.where(i < length, byte, 0).astype(np.uint64)
        if i >= 3:
            docs.append(w.doc)
            out.append(mix(code + np.uint64((i + 1) << 56)))
    data, offsets = w.data, w.offsets
    solid = np.zeros(len(data) + 1, dtype=bool)
    solid[:-1] = ~_BLANK[data]
    edge = solid[:-1] & ~solid[1:]
    edge[offsets[1:][offsets[1:] > 0] - 1] |= solid[offsets[1:][offsets[1:] > 0] - 1]
    last = np.flatnonzero(edge)
    doc = np.searchsorted(offsets, last, side="right") - 1
    at = last[:, None] - np.arange(2, -1, -1)
    ok = (at >= offsets[doc][:, None]) & ~_BLANK[data[np.maximum(at, 0)]]
    docs.append(doc)
    out.append(_sides(data, at, ok, 7))

    size = np.maximum(np.diff(offsets), 1)
    count = np.maximum(w.per_text(), 1)
    by = lambda x: np.bincount(np.searchsorted(offsets, np.flatnonzero(x), side="right") - 1, minlength=n)
    again = np.zeros(n)
    if len(w.hash) > 1:
        same = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
        again = np.bincount(w.doc[1:][same], minlength=n)
    shapes = [by((data >= 65) & (data <= 90)) / size, by((data >= 48) & (data <= 57)) / size, again / count,
              (size - np.bincount(w.doc, w.end - w.start, n)) / size]
    for i, share in enumerate(shapes):
        docs.append(np.arange(n))
        out.append(mix(np.uint64((16 + i) << 48) + np.minimum(share * 20, 19).astype(np.uint64)))
    docs.append(np.arange(n))
    out.append(mix(np.uint64(32 << 48) + np.log2(count + 1).astype(np.uint64)))
    return np.concatenate(docs), np.concatenate(out)


@dataclass(frozen=True)
class Ordinal:
    """Hashes of the features that count (ascending), their weights, and the thresholds."""
    hashes: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def matches(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Text and place in ``hashes`` of each feature of the texts that counts, by text, each once."""
        doc, hashes = features(column)
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        bits = np.zeros(1 << 20, dtype=bool)
        bits[(self.hashes >> np.uint64(44)).astype(np.int64)] = True
        near = np.flatnonzero(bits[(hashes >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[near]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[near]
        pairs = np.unique(doc[near[hit]].astype(np.int64) * len(self.hashes) + at[hit])
        return pairs // len(self.hashes), pairs % len(self.hashes)

    def scores(self, column: pa.Array) -> np.ndarray:
        doc, at = self.matches(column)
        return np.bincount(doc, self.weights[at], len(column))

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, one row a text."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(starts: np.ndarray, col: np.ndarray, grades: np.ndarray, n_features: int, n_grades: int):
    """Weights and ordered thresholds by Adam on the mean negative log likelihood.

    Text i has the features ``col[starts[i]:starts[i + 1]]``. Texts are taken in blocks of some
    ``FIT_BLOCK`` features, so that beside ``col`` a step holds no array of all features.
    """
    n = max(len(grades), 1)
    sizes = np.diff(starts)
    some = sizes > 0
    edges = np.unique(np.searchsorted(starts, np.arange(0, starts[-1] + FIT_BLOCK, FIT_BLOCK)).clip(0, len(grades)))

    def blocks():
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield a, b, col[starts[a]: starts[b]], sizes[a:b]

    shares = np.clip(np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / n, 1e-3, 1 - 1e-3)
    start = np.log(shares / (1 - shares))
    gaps = np.log(np.maximum(np.diff(start), 1e-2))
    theta = np.concatenate([np.zeros(n_features), start[:1], gaps])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, cuts = theta[:n_features], theta[n_features] + np.concatenate([[0], np.cumsum(np.exp(theta[n_features + 1:]))])
        s = np.zeros(len(grades))
        for a, b, part, _ in blocks():
            own = some[a:b]
            if own.any():
                s[a:b][own] = np.add.reduceat(w[part], (starts[a:b] - starts[a])[own])
        tail = _sigmoid(s[:, None] - cuts)
        upper = np.concatenate([np.ones((len(s), 1)), tail, np.zeros((len(s), 1))], axis=1)
        slope = upper * (1 - upper)
        i = np.arange(len(s))
        p = np.maximum(upper[i, grades] - upper[i, grades + 1], 1e-9)
        d_s = (slope[i, grades] - slope[i, grades + 1]) / p / n
        d_cut = np.zeros((len(s), len(cuts) + 2))
        d_cut[i, grades] -= slope[i, grades] / p / n
        d_cut[i, grades + 1] += slope[i, grades + 1] / p / n
        d_cut = d_cut[:, 1:-1].sum(axis=0)
        d_w = np.zeros(n_features)
        for a, b, part, own in blocks():
            d_w += np.bincount(part, np.repeat(d_s[a:b], own), n_features)
        grad = np.concatenate([d_w - RIDGE * w, [d_cut.sum()],
                               [np.exp(g) * d_cut[j + 1:].sum() for j, g in enumerate(theta[n_features + 1:])]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta + 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    cuts = theta[n_features] + np.concatenate([[0], np.cumsum(np.exp(theta[n_features + 1:]))])
    return theta[:n_features], cuts


def _once(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature of a text once, by text and hash."""
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[new], hashes[new]


def train(docs: DataFrame, graded: DataFrame, n_grades: int = 3, rows: int = TRAIN_ROWS) -> Ordinal:
    """Fit on at most ``rows`` graded documents, the first by a hash of doc_id.

    ``graded`` has doc_id and grade (0 to n_grades - 1); of several grades of one document the
    lowest counts, nulls are left out, and each row of a repeated doc_id counts. Features in fewer
    than five texts or without a clear difference (z of 4) between the grades on the two sides of
    some threshold are dropped before anything reaches the driver; then each text comes as the
    packed numbers of its features. Without graded documents all texts score alike.
    """
    sample = graded.where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(
        F.min("grade").cast("int").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    counts_by = {r.grade: r.n for r in texts.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    counts = [counts_by.get(g, 0) for g in range(n_grades)]
    if sum(c > 0 for c in counts) < 2:
        return Ordinal(np.zeros(0, np.uint64), np.zeros(0), np.linspace(-1, 0, n_grades - 1))
    names = [f"n{g}" for g in range(n_grades)]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            doc, hashes = _once(*features(batch.column("text")))
            grades = batch.column("grade").to_numpy(zero_copy_only=False)[doc]
            known, at = np.unique(hashes, return_inverse=True)
            by = np.bincount(at * n_grades + grades, minlength=len(known) * n_grades).reshape(-1, n_grades)
            yield pa.RecordBatch.from_pydict({"f": pa.array(known.view(np.int64)),
                                              **{c: pa.array(by[:, g].astype(np.int64)) for g, c in enumerate(names)}})

    by_grade = texts.mapInArrow(counted, "f long, " + ", ".join(f"{c} long" for c in names)).groupBy("f").agg(
        *[F.sum(c).alias(c) for c in names])
    clear = F.lit(False)
    for cut in range(1, n_grades):
        below, above = sum(counts[:cut]), sum(counts[cut:])
        if below and above:
            a = sum((F.col(c) for c in names[1:cut]), F.col(names[0]))
            b = sum((F.col(c) for c in names[cut + 1:]), F.col(names[cut]))
            p = (a + b) / float(below + above)
            clear = clear | (F.abs(a / float(below) - b / float(above)) >= LEAST_Z * F.sqrt(p * (1 - p) * (1 / below + 1 / above)) + 1e-12)
    total = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    used = by_grade.where((total >= LEAST_TEXTS) & clear).select("f").toArrow()
    known = np.sort(used.column("f").to_numpy().view(np.uint64))
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Ordinal(shared.value, np.zeros(0), np.zeros(0))
        for batch in slices(batches):
            doc, at = model.matches(batch.column("text"))
            ends = np.cumsum(np.bincount(doc, minlength=len(batch)))
            packed = [x.astype("<u4").tobytes() for x in np.split(at, ends[:-1])] if len(batch) else []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), pa.array(packed, pa.binary())],
                                             names=["doc_id", "grade", "packed"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    got = texts.mapInArrow(numbered, f"doc_id {kind}, grade int, packed binary").toArrow().sort_by(
        [("doc_id", "ascending"), ("packed", "ascending")])
    packed, graded_as = got.column("packed").to_pylist(), got.column("grade").to_numpy()
    del got
    starts = np.concatenate([[0], np.cumsum([len(x) // 4 for x in packed])]).astype(np.int64)
    col = np.frombuffer(b"".join(packed), dtype="<u4")
    del packed
    weights, cuts = fit_ordinal(starts, col, graded_as, len(known), n_grades)
    return Ordinal(known, weights, cuts)


def grade(docs: DataFrame, model: Ordinal) -> DataFrame:
    """Add ``expected_grade`` and ``tails`` (P(grade > k) for k = 0, 1, ...) to every row.

    Only the text is looked at, in whole; a null text is empty, and an empty text is judged by
    its shape. Rows are judged one by one, repeated rows alike; other columns pass through, whatever
    their names, but for columns named as the two results; an empty table gives no rows.
    """
    own, back = apart(docs, "text")
    shared = docs.sparkSession.sparkContext.broadcast((model.hashes, model.weights, model.thresholds))
    df = own.withColumns({"expected_grade": F.lit(0.0), "tails": F.expr("CAST(array() AS array<double>)")})

    def run(batches):
        known = Ordinal(*shared.value)
        for batch in slices(batches):
            tails = known.tails(known.scores(batch.column("text")))
            new = {"expected_grade": tails.sum(axis=1), "tails": tails.tolist()}
            yield pa.RecordBatch.from_arrays([pa.array(new[f.name], type=f.type) if f.name in new else batch.column(f.name)
                                              for f in batch.schema], schema=batch.schema)

    return back(df.mapInArrow(run, df.schema), "expected_grade", "tails")


__all__ = ["Ordinal", "features", "fit_ordinal", "grade", "train"]
