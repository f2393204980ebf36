"""Removal of repeated byte strings by suffix arrays.

1. Texts are cut into slices of some million bytes. The strings of ``length`` bytes whose hash a slice
   has more than once form its shard; the shard's suffix array (Larsson-Sadakane refinement) and
   common prefixes (Kasai) give the classes of equal strings; a string that also starts in a smaller
   document of its slice is settled there. A hash decides nothing: it only leaves out strings
   without an equal.
2. The rest goes to other shards as runs: neighbouring strings whose smallest 12-byte hash is the
   same go together, and that hash picks the bucket, so equal strings of all slices meet in one
   bucket. A passage that very many documents share leaves each slice once.
3. In a bucket, strings whose own hash occurs once have no partner. The others form shards of
   bounded size with suffix arrays of their own; the sorted tables of distinct strings of the
   shards are merged by binary search, and a search in the merged table gives each string the
   smallest document that has it.
4. The strings to remove go back to their slices, from there to their documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabquorum.sources.shared import materialize

from .arrays import mix, power, slices, spans, utf8

LENGTH = 50
GRAM = 12
SLICE = 1_000_000
GROUP = 4                  # slices whose runs are sent together
BUCKET_BYTES, LEAST_BUCKETS, MOST_BUCKETS = 8_000_000, 128, 1 << 20
SHARD = 1_000_000          # bytes of a shard of a bucket
PASS = 8_000_000           # strings of a bucket that are looked at together
LANES = 4096
_LAST = np.iinfo(np.int64).max
_SPREAD = mix(np.arange(1, 257, dtype=np.uint64))


def first_keys(data: np.ndarray, words: np.ndarray | None = None) -> tuple[np.ndarray, int]:
    """Numbers that sort suffixes by their first bytes, and how many bytes: more than eight if the
    data have few different bytes."""
    used = np.flatnonzero(np.bincount(data, minlength=256))
    bits = max(1, int(len(used)).bit_length())     # 0 stands for the end
    size = 63 // bits
    if size <= 8:
        return (packed(data) if words is None else words), 8
    code = np.zeros(256, dtype=np.uint64)
    code[used] = np.arange(1, len(used) + 1)
    codes = np.concatenate([code[data], np.zeros(size, np.uint64)])
    wide, reach = codes, 1
    while reach * 2 <= size:                       # wide: the next ``reach`` codes from each place
        wide = (wide[: len(wide) - reach] << np.uint64(bits * reach)) | wide[reach:]
        reach *= 2
    out = wide[: len(data)]
    for i in range(reach, size):
        out = (out << np.uint64(bits)) | codes[i: i + len(data)]
    return out, size


def packed(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, zeros after the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), dtype=np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i: i + len(data)]
    return out


def suffix_array(data: np.ndarray, words: np.ndarray | None = None) -> np.ndarray:
    """Starts of the suffixes of ``data`` in order, by Larsson-Sadakane refinement.

    Suffixes are sorted by eight bytes or more; then only groups not yet sorted are sorted again, by the
    rank of what follows the part known to be equal, which doubles each time.
    """
    n = len(data)
    key, same = first_keys(data, words)
    order = np.argsort(key).astype(np.int32)
    key = key[order]
    head = np.ones(n, dtype=bool)
    np.not_equal(key[1:], key[:-1], out=head[1:])
    del key
    slots = np.arange(n, dtype=np.int32)
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.maximum.accumulate(np.where(head, slots, np.int32(0)))
    open_ = slots[~(head & np.append(head[1:], True))]
    while len(open_):
        at = order[open_]
        then = at.astype(np.int64) + same
        then = np.where(then < n, rank[np.minimum(then, n - 1)], n - 1 - then) + same   # a shorter suffix first
        both = (rank[at].astype(np.uint64) << np.uint64(32)) | then.astype(np.uint64)
        turn = np.argsort(both)
        at, both = at[turn], both[turn]
        order[open_] = at
        head = np.ones(len(at), dtype=bool)
        np.not_equal(both[1:], both[:-1], out=head[1:])
        rank[at] = open_[np.maximum.accumulate(np.where(head, np.arange(len(at), dtype=np.int32), np.int32(0)))]
        open_ = open_[~(head & np.append(head[1:], True))]
        same *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in order, ``most`` at most (Kasai).

    Places are gone through in text order, since the next place shares one byte less at least; many
    stretches of the text are gone through at once.
    """
    n = len(order)
    before = np.empty(n, dtype=np.int32)
    before[order[1:]] = order[:-1]
    if n:
        before[order[0]] = n
    text = np.full(n + most + 1, -1, dtype=np.int16)
    text[:n] = data
    shared = np.zeros(n, dtype=np.int16 if most < 32_000 else np.int64)
    lanes = max(1, min(LANES, n // 64))
    cuts = n * np.arange(lanes + 1) // lanes
    at, end = cuts[:-1].copy(), cuts[1:]
    live = at < end
    at, end = at[live], end[live]
    size = np.zeros(len(at), dtype=np.int64)
    while len(at):
        equal = text.take(at + size, mode="clip") == text.take(before.take(at, mode="clip") + size, mode="clip")
        equal &= size < most
        step = np.flatnonzero(~equal)
        shared[at[step]] = size[step]
        size += 1
        size[step] = np.maximum(size[step] - 2, 0)
        at[step] += 1
        done = at == end
        if done.any():
            at, end, size = at[~done], end[~done], size[~done]
    return shared[order]


def string_classes(data: np.ndarray, valid: np.ndarray, owner: np.ndarray, length: int, words: np.ndarray | None = None,
                   alone: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of equal strings of ``length`` bytes at the valid places: the places in suffix order,
    the class of each (ascending, as the strings) and the smallest owner of each class. Without
    ``alone`` most strings without an equal are left out."""
    order = suffix_array(data, words)
    equal = common_prefixes(data, order, length) >= length
    slots = np.arange(len(order)) if alone else np.flatnonzero(equal | np.append(equal[1:], False))
    place = order[slots].astype(np.int64)
    number = np.cumsum(~equal[slots])
    here = valid[place]
    place, number = place[here], number[here]
    if not len(place):
        return place, number, np.zeros(0, dtype=np.int64)
    head = np.concatenate([[True], number[1:] != number[:-1]])
    least = np.minimum.reduceat(owner[place], np.flatnonzero(head))
    return place, np.cumsum(head) - 1, least


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """32-bit hash of the ``length`` bytes from each place on, by running sums."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_SPREAD[data] * power("up", len(data)), dtype=np.uint64, out=sums[1:])
    found = (sums[length:] - sums[:-length]) * power("down", len(data) + 1)[: len(data) - length + 1]
    return (found >> np.uint64(32)).astype(np.uint32)


def more_than_once(hashes: np.ndarray) -> np.ndarray:
    """Places of the 32-bit hashes that occur more than once."""
    every = np.sort(hashes)
    shared = np.unique(every[1:][every[1:] == every[:-1]])
    return _among(hashes, shared)


def _among(hashes: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Places of the hashes that are in the ascending ``shared``."""
    if not len(shared):
        return np.zeros(0, dtype=np.int64)
    near = np.zeros(1 << 20, dtype=bool)
    near[shared >> np.uint32(12)] = True
    here = np.flatnonzero(near[hashes >> np.uint32(12)])
    return here[shared[np.minimum(np.searchsorted(shared, hashes[here]), len(shared) - 1)] == hashes[here]]


def slice_classes(data: np.ndarray, valid: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``string_classes`` of a slice, of its strings that may have an equal."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none
    places = np.flatnonzero(valid[: len(data) - length + 1])
    places = places[more_than_once(window_hashes(data, length)[places])]
    if not len(places):
        return none, none, none
    head = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1] + 1]))
    first, sizes = places[head], np.diff(np.append(head, len(places))) + length - 1
    text, first, sizes, run, inside = shuffled(data, first, sizes)
    at = first[run] + inside
    place, number, least = string_classes(text, inside + length <= sizes[run], owner[at], length, alone=False)
    return at[place], number, least


def shuffled(data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """The spans [first, first + size) of ``data`` one after the other in a mixed order: bytes, starts and
    sizes in that order, and the span of each byte with its place there. In their own order the spans of
    copies would line up, and equal runs of spans take long to sort."""
    turn = np.argsort(mix(np.arange(len(first), dtype=np.uint64)))
    first, sizes = first[turn], sizes[turn]
    run = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return data[first[run] + inside], first, sizes, run, inside


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``width`` values from each place on."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size:]) if size < width else values


def intervals(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending places as [start, end) runs."""
    if not len(places):
        return places, places
    head = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1] + 1]))
    return places[head], np.append(places[head[1:] - 1], places[-1]) + 1


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted tables of distinct strings with their smallest documents, merged by binary search."""
    at = np.searchsorted(a[0], b[0])
    known = at < len(a[0])
    known[known] = a[0][at[known]] == b[0][known]
    least = a[1].copy()
    least[at[known]] = np.minimum(least[at[known]], b[1][known])
    return np.insert(a[0], at[~known], b[0][~known]), np.insert(least, at[~known], b[1][~known])


def _pack(*arrays: np.ndarray) -> bytes:
    import zstandard
    parts = [zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(x).tobytes()) for x in arrays]
    return np.array([len(parts), *map(len, parts)], dtype="<u4").tobytes() + b"".join(parts)


def _unpack(raw: bytes, *types: str) -> list[np.ndarray]:
    """The first arrays that ``_pack`` packed."""
    import zstandard
    sizes = np.frombuffer(raw, "<u4", raw[0], 4)
    ends = 4 * (1 + raw[0]) + np.cumsum(sizes, dtype=np.int64)
    tool = zstandard.ZstdDecompressor()
    return [np.frombuffer(tool.decompress(raw[e - s: e]), t) for s, e, t in zip(sizes.tolist(), ends.tolist(), types, strict=False)]


def _pieces(batches, length, limit):
    """Slices of texts: bytes, begin of each piece, its doc_id and text hash, its place in the document.

    A text longer than a slice is cut into pieces that overlap by ``length`` - 1 bytes.
    """
    for batch in slices(batches, size=limit):
        data, offsets = utf8(batch.column("text"))
        docs = np.array([_LAST if x is None else x for x in batch.column("doc_id").to_pylist()], dtype=np.int64)
        texts = np.asarray(batch.column("text_hash"), dtype=np.int64)
        if len(data) <= limit:
            yield data, offsets, docs, texts, np.zeros(len(docs), dtype=np.int64)
            continue
        for at in range(0, max(len(data) - length + 1, 1), limit - length + 1):   # one row
            part = data[at: at + limit]
            yield part, np.array([0, len(part)]), docs, texts, np.array([at], dtype=np.int64)


_EXPORT = "bucket int, slice bigint, kind int, data binary"


def _row(bucket: int, number: int, kind: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "slice": pa.array([number], pa.int64()),
                                       "kind": pa.array([kind], pa.int32()), "data": pa.array([data], pa.binary())})


def _settle_slices(batches, length, buckets, limit):
    """Step 1 and 2: a row with the documents and settled strings of some slices, and their runs by bucket."""
    from pyspark import TaskContext
    number, base, held, tables = TaskContext.get().partitionId() << 32, 0, {}, []

    def group():
        yield _row(number % buckets, number, 1, _pack(
            np.concatenate([[0], *[t[0][1:] for t in tables]]), *[np.concatenate(x) for x in list(zip(*tables, strict=True))[1:]]))
        for bucket, runs in held.items():
            first, count, owner, text = (np.concatenate(x) for x in zip(*runs, strict=True))
            yield _row(bucket, number, 0, _pack(np.diff(first, prepend=0).astype("<i4"), count.astype("<i4"),
                                                np.diff(owner, prepend=0).astype("<i8"), text))

    for data, offsets, docs, texts, places in _pieces(batches, length, limit):
        sizes = np.diff(offsets)
        owner = np.repeat(docs, sizes)
        valid = np.arange(len(data)) + length <= np.repeat(offsets[1:], sizes)
        place, number_of, least = slice_classes(data, valid, owner, length)
        settled = np.sort(place[owner[place] > least[number_of]])
        start, end = intervals(settled)
        tables.append((offsets + base, docs, texts, places, start.astype(np.int64) + base, end.astype(np.int64) + base))
        valid[settled] = False
        del place, number_of, least, settled
        for bucket, first, count, text in _dealt_runs(data, np.flatnonzero(valid), length, buckets):
            held.setdefault(bucket, []).append((first + base, count, owner[first], text))
        base += len(data)
        if base >= GROUP * limit:
            yield from group()
            number, base, held, tables = number + 1, 0, {}, []
    if tables:
        yield from group()


def _dealt_runs(data, out, length, buckets):
    """(bucket, first, count, text) of the runs of the places ``out``."""
    if not len(out):
        return
    words = packed(data)
    grams = mix(mix(words[: len(data) - GRAM + 1]) + words[GRAM - 8: len(data) - 8 + 1])
    least = window_minima(grams, length - GRAM + 1)[out]
    head = np.flatnonzero(np.concatenate([[True], (out[1:] != out[:-1] + 1) | (least[1:] != least[:-1])]))
    first, count = out[head], np.diff(np.append(head, len(out)))
    bucket = ((least[head] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    del grams, least
    turn = np.argsort(bucket, kind="stable")
    cuts = np.append(np.flatnonzero(np.diff(bucket[turn], prepend=-1)), len(turn))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        own = turn[a:b]
        yield int(bucket[own[0]]), first[own], count[own], data[spans(first[own], count[own] + length - 1)]


_BLOB = ("<i4", "<i4", "<i8", "u1")


class _Runs:
    """Strings of one bucket that may have an equal, in shards of bounded size.

    Equal runs are looked at once, with their smallest owner. Of the strings of the others only those
    go on whose 32-bit hash occurs more than once. With ``parts`` above 1 only strings whose hash
    modulo ``parts`` is ``part`` are looked at.
    """

    def __init__(self, blobs: list[tuple[int, bytes]], length: int, limit: int, part: int = 0, parts: int = 1):
        self.length, self.shards, self.copies = length, [], []
        runs, texts = zip(*[self._runs(raw) for _, raw in blobs], strict=True)
        names, hashes = zip(*[self._hashes(t, r) for t, r in zip(texts, runs, strict=True)], strict=True)
        kept = self._distinct(blobs, runs, texts, names)
        asked = [self._strings(r, own, h, part, parts) for r, own, h in zip(runs, kept, hashes, strict=True)]
        del names, hashes
        every = np.sort(np.concatenate([h for h, _, _ in asked]))
        shared = np.unique(every[1:][every[1:] == every[:-1]])
        del every
        held, size = [], 0
        for (number, _), text, (first, _, owner, begin), (hash_, run, inside) in zip(blobs, texts, runs, asked, strict=True):
            here = _among(hash_, shared)
            if not len(here):
                continue
            run, inside = run[here], inside[here]
            at = np.flatnonzero(np.concatenate([[True], (run[1:] != run[:-1]) | (inside[1:] != inside[:-1] + 1)]))
            sizes = np.diff(np.append(at, len(run))) + length - 1
            run, inside = run[at], inside[at]
            held.append((np.full(len(at), number), first[run] + inside, sizes, owner[run], text[spans(begin[run] + inside, sizes)]))
            size += len(held[-1][-1])
            if size >= limit:
                self._close(held)
                held, size = [], 0
        if held:
            self._close(held)

    def _runs(self, raw):
        """Place, bytes, owner and begin in the text of each run, and the text."""
        first, count, owner, text = _unpack(raw, *_BLOB)
        sizes = count.astype(np.int64) + self.length - 1
        return (np.cumsum(first, dtype=np.int64), sizes, np.cumsum(owner, dtype=np.int64), np.cumsum(sizes) - sizes), text

    def _hashes(self, text, runs):
        """A 64-bit name of each run, from the hashes of its strings, and 32 bits of each of these."""
        _, sizes, _, begin = runs
        count = sizes - self.length + 1
        hashes = window_hashes(text, self.length)[spans(begin, count)]
        firsts = np.cumsum(count) - count
        return np.add.reduceat(mix(hashes.astype(np.uint64)), firsts) + sizes.astype(np.uint64), hashes

    def _distinct(self, blobs, runs, texts, names) -> list[np.ndarray]:
        """Runs of each blob that are the smallest owner's of all runs with the same bytes. The strings of
        runs with a larger owner are repeated and noted as such; those of the same owner stay."""
        edges = np.cumsum([0, *map(len, names)])
        name, owner = np.concatenate(names), np.concatenate([r[2] for r in runs])
        turn = np.lexsort((owner, name))
        head = np.concatenate([[True], name[turn][1:] != name[turn][:-1]]) if len(turn) else np.zeros(0, bool)
        model = np.empty(len(turn), dtype=np.int64)
        model[turn] = turn[np.maximum.accumulate(np.where(head, np.arange(len(turn)), 0))]
        later = np.flatnonzero(owner > owner[model])
        later = later[self._equal(texts, runs, later, model[later])]
        gone = np.zeros(len(turn), dtype=bool)
        gone[later] = True
        kept = []
        for i, ((number, _), (first, sizes, _, _)) in enumerate(zip(blobs, runs, strict=True)):
            out = gone[edges[i]: edges[i + 1]]
            self.copies.append((number, first[out], sizes[out] - self.length + 1))
            kept.append(~out)
        return kept

    @staticmethod
    def _equal(texts, runs, a, b) -> np.ndarray:
        """Whether runs ``a`` and ``b`` (numbers over all blobs) have the same bytes."""
        bases = np.cumsum([0, *map(len, texts)])
        text, begin = np.concatenate(texts), np.concatenate([r[3] + base for r, base in zip(runs, bases, strict=False)])
        sizes = np.concatenate([r[1] for r in runs])
        same = sizes[a] == sizes[b]
        for at in range(0, len(a), 20_000):
            x, y = a[at: at + 20_000], b[at: at + 20_000]
            size = np.minimum(sizes[x], sizes[y])
            differs = text[spans(begin[x], size)] != text[spans(begin[y], size)]
            same[at: at + 20_000] &= np.add.reduceat(differs, np.cumsum(size) - size) == 0
        return same

    def _strings(self, runs, own, hashes, part, parts):
        """32-bit hash, run and place in the run of the strings of the runs ``own``."""
        count = runs[1] - self.length + 1
        here = np.repeat(own, count)
        run = np.repeat(np.flatnonzero(own).astype(np.int32), count[own])
        inside = spans(np.zeros(len(count[own]), np.int64), count[own]).astype(np.int32)
        hashes = hashes[here]
        if parts > 1:
            mine = hashes % np.uint32(parts) == part
            hashes, run, inside = hashes[mine], run[mine], inside[mine]
        return hashes, run, inside

    def _close(self, part) -> None:
        """Classes of one shard: per valid place its slice, place there, owner and class."""
        number, first, sizes, owner, text = (np.concatenate(x) for x in zip(*part, strict=True))
        begin = np.cumsum(sizes) - sizes
        text, begin_, sizes, run, inside = shuffled(text, begin, sizes)
        turn = np.searchsorted(begin, begin_)
        number, first, owner = number[turn], first[turn], owner[turn]
        place, of, least = string_classes(text, inside + self.length <= sizes[run], owner[run], self.length)
        heads = place[np.flatnonzero(np.diff(of, prepend=-1))]
        keys = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, self.length)[heads]).view(f"S{self.length}").ravel()
        at = run[place]
        self.shards.append(((keys, least), number[at], first[at] + inside[place], owner[at], of))

    def repeated(self):
        """(slice, places) of the strings that start in a smaller document."""
        for number, first, count in self.copies:
            if len(first):
                yield number, spans(first, count)
        tables = [s[0] for s in self.shards]
        while len(tables) > 1:
            tables = [merged(*tables[i: i + 2]) if i + 1 < len(tables) else tables[i] for i in range(0, len(tables), 2)]
        found = []
        for (keys, _), number, place, owner, of in self.shards:
            least = tables[0][1][np.searchsorted(tables[0][0], keys)]
            late = owner > least[of]
            found.append(np.stack([number[late], place[late]]))
        if found:
            number, place = np.concatenate(found, axis=1)
            turn = np.lexsort((place, number))
            number, place = number[turn], place[turn]
            cuts = np.append(np.flatnonzero(np.diff(number, prepend=-1)), len(number))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                yield int(number[a]), place[a:b]


def _merge_buckets(batches, length, limit):
    """Step 3, over rows sorted by bucket: rows of slices pass; runs become the strings to remove."""
    bucket, blobs = None, []

    def close():
        parts = 1 + sum(int(_unpack(raw, *_BLOB[:2])[1].sum()) for _, raw in blobs) // PASS
        for part in range(parts if blobs else 0):
            for number, places in _Runs(blobs, length, limit, part, parts).repeated():
                yield _row(0, number, 0, _pack(*intervals(places)))

    for batch in batches:
        for b, number, kind, raw in zip(*(batch.column(c).to_pylist() for c in ("bucket", "slice", "kind", "data")), strict=True):
            if b != bucket:
                yield from close()
                bucket, blobs = b, []
            if kind == 1:
                yield _row(b, number, 1, raw)
            else:
                blobs.append((number, raw))
    yield from close()


def _by_document(batches, length):
    """Step 4, over rows sorted by slice, its own row first: byte spans of documents."""
    table, remove, number = None, [], None

    def close():
        if table is None or not remove:
            return
        offsets, docs, texts, places = table
        edge = np.zeros(int(offsets[-1]) + 1, dtype=np.int32)
        for start, end in remove:
            np.add.at(edge, start, 1)
            np.add.at(edge, end + length - 1, -1)
        covered = np.cumsum(edge[:-1]) > 0
        start, end = intervals(np.flatnonzero(covered))
        piece = np.searchsorted(offsets, start, side="right") - 1   # a span may run through several pieces
        last = np.searchsorted(offsets, end, side="left") - 1
        copies = last - piece + 1
        which = spans(piece, copies)
        start = np.maximum(np.repeat(start, copies), offsets[which]) - offsets[which] + places[which]
        end = np.minimum(np.repeat(end, copies), offsets[which + 1]) - offsets[which] + places[which]
        full = end > start
        which, pairs = which[full], np.stack([start, end], axis=1)[full].astype("<i8")
        cuts = np.append(np.flatnonzero(np.diff(which, prepend=-1)), len(which))
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array([None if docs[w] == _LAST else int(docs[w]) for w in which[cuts[:-1]]], pa.int64()),
            "text_hash": pa.array(texts[which[cuts[:-1]]], pa.int64()),
            "spans": pa.array([pairs[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})

    for batch in batches:
        for n, kind, raw in zip(*(batch.column(c).to_pylist() for c in ("slice", "kind", "data")), strict=True):
            if n != number:
                yield from close()
                table, remove, number = None, [], n
            if kind == 1:
                *table, start, end = _unpack(raw, "<i8", "<i8", "<i8", "<i8", "<i8", "<i8")
                if len(start):
                    remove.append((start, end))
            else:
                remove.append(tuple(_unpack(raw, "<i8", "<i8")))
    yield from close()


def repeated_spans(docs: DataFrame, length: int = LENGTH, slice_bytes: int = SLICE, shard_bytes: int = SHARD) -> DataFrame:
    """(doc_id, text_hash, spans): bytes of each row's text covered by repeated strings.

    ``spans`` lists packed pairs of 64-bit numbers, [start, end) in bytes. A string of ``length``
    bytes is repeated if it also starts in a row with a smaller doc_id (a null doc_id counts as
    the largest). Rows equal in doc_id and text are given once.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(max(total // BUCKET_BYTES, LEAST_BUCKETS), MOST_BUCKETS)
    sent = rows.mapInArrow(lambda it: _settle_slices(it, length, buckets, slice_bytes), _EXPORT)
    dealt = sent.repartition(F.col("bucket")).sortWithinPartitions("bucket")
    found, _ = materialize(dealt.mapInArrow(lambda it: _merge_buckets(it, length, shard_bytes), _EXPORT).drop("bucket"), "repeats")
    back = found.repartition(F.col("slice")).sortWithinPartitions("slice", F.col("kind").desc())
    spans = back.mapInArrow(lambda it: _by_document(it, length), "doc_id bigint, text_hash bigint, spans binary")
    return spans.groupBy("doc_id", "text_hash").agg(F.collect_list("spans").alias("spans"))


def _cut(text: bytes, spans: list[bytes] | None) -> tuple[bytes, int, int]:
    """The text without its spans, the bytes removed and the maximal runs of them."""
    if not spans:
        return text, 0, 0
    kept, at, removed, runs = [], 0, 0, 0
    last = -1
    for start, end in sorted(pair for s in spans for pair in np.frombuffer(s, "<i8").reshape(-1, 2).tolist()):
        if end <= last:
            continue
        if start > last:
            kept.append(text[at: start])
            runs += 1
        else:
            start = last
        removed += end - start
        at = last = end
    kept.append(text[at:])
    return b"".join(kept), removed, runs


def remove_repeats(docs: DataFrame, length: int = LENGTH, slice_bytes: int = SLICE, shard_bytes: int = SHARD) -> DataFrame:
    """Every row's text without its repeated strings: doc_id, n_bytes, n_removed, n_spans, kept.

    Texts are compared as UTF-8 bytes, whole; ``kept`` is binary, since a cut may fall inside a
    character. Null texts are empty; texts shorter than ``length`` stay; matches never cross rows;
    rows with equal doc_id never shorten each other; other columns are not looked at; an empty
    table gives no rows. ``length`` is 20 at least, ``slice_bytes`` more than that; they and
    ``shard_bytes`` bound what a task sorts at once and change no result.
    """
    if length < GRAM + 8:
        raise ValueError("length below 20")
    spans, _ = materialize(repeated_spans(docs, length, slice_bytes, shard_bytes), "spans")
    spans = spans.withColumnsRenamed({"doc_id": "of", "text_hash": "hash"})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    joined = rows.join(spans, rows["doc_id"].eqNullSafe(spans["of"]) & (rows["text_hash"] == spans["hash"]), "left").select("doc_id", "text", "spans")

    def cut(batches):
        for batch in slices(batches):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            out = [_cut(t, s) for t, s in zip(texts, batch.column("spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                "n_removed": pa.array([x[1] for x in out], pa.int64()), "n_spans": pa.array([x[2] for x in out], pa.int64()),
                "kept": pa.array([x[0] for x in out], pa.binary())})

    return joined.mapInArrow(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
