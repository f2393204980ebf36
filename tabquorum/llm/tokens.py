"""Token ids of all texts in one sequence, with Elias-Fano document boundaries.

The file is a table of blocks. A block holds whole documents in ascending doc_id order: a header,
the Elias-Fano code of its document ends, samples for select, its doc_ids, and the concatenated
ids as little-endian unsigned 32-bit integers. ``start`` of a block is the number of ids before
it; everything inside is relative to it, so no table of 64-bit offsets is kept.
"""

from __future__ import annotations

import struct

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabquorum.sources.shared import new_shared_path

from .arrays import mix, run_hash, slices, spans, utf8

END_ID = 2
BLOCK_IDS = 1 << 18
BLOCKS = "part int, skip bigint, n_ids bigint, n_docs bigint, data binary"
CACHE_BYTES = 48_000_000
CACHED_CHARS = 64
SAMPLE = 256
_MAGIC = b"TQEF"


@dataclass
class EliasFano:
    """A non-decreasing sequence of ``n`` numbers up to ``top`` in n * (2 + log2(top / n)) bits.

    The low ``bits`` of each number are packed; the high parts are a unary bit array, in which
    the i-th set bit stands at high(i) + i. ``samples`` has the place of every 256th set bit, so
    select reads at most 256 codes' bits.
    """
    n: int
    bits: int
    low: np.ndarray
    high: np.ndarray
    samples: np.ndarray

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = ((values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(places[-1]) + 1 if n else 0, dtype=np.uint8)
        unary[places] = 1
        return cls(n, bits, np.packbits(low.ravel(), bitorder="little"),
                   np.packbits(unary, bitorder="little"), places[::SAMPLE].astype(np.uint32))

    def _low(self, first: int, last: int) -> np.ndarray:
        if not self.bits:
            return np.zeros(last - first, dtype=np.uint64)
        a, b = first * self.bits, last * self.bits
        raw = np.unpackbits(self.low[a // 8: -(-b // 8)], bitorder="little")[a % 8: a % 8 + b - a]
        return (raw.reshape(-1, self.bits).astype(np.uint64) << np.arange(self.bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """The i-th number."""
        group = i // SAMPLE
        at = int(self.samples[group])
        end = int(self.samples[group + 1]) if group + 1 < len(self.samples) else len(self.high) * 8
        bits = np.unpackbits(self.high[at // 8: -(-end // 8)], bitorder="little")[at % 8:]
        place = at + int(np.flatnonzero(bits)[i % SAMPLE])
        return ((place - i) << self.bits) | int(self._low(i, i + 1)[0])

    def decode(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        return ((places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.bits)) | self._low(0, self.n)

    def pack(self) -> bytes:
        parts = [self.low.tobytes(), self.high.tobytes(), self.samples.astype("<u4").tobytes()]
        return struct.pack("<QBQQQ", self.n, self.bits, *map(len, parts)) + b"".join(parts)

    @classmethod
    def unpack(cls, raw: memoryview) -> tuple[EliasFano, int]:
        n, bits, a, b, c = struct.unpack_from("<QBQQQ", raw)
        at = struct.calcsize("<QBQQQ")
        low, high = np.frombuffer(raw[at: at + a], np.uint8), np.frombuffer(raw[at + a: at + a + b], np.uint8)
        return cls(n, bits, low, high, np.frombuffer(raw[at + a + b: at + a + b + c], "<u4")), at + a + b + c


def pack_block(doc_ids: list[int | None], ends: np.ndarray, ids: bytes) -> bytes:
    """One block: nulls among ``doc_ids`` come first, the others ascend."""
    known = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    base = int(known[0]) if len(known) else 0
    code, names = EliasFano.encode(ends), EliasFano.encode((known - base).view(np.uint64) if len(known) else known)
    return b"".join([_MAGIC, struct.pack("<QqQ", len(doc_ids) - len(known), base, len(ids)), code.pack(), names.pack(), ids])


def unpack_block(raw: bytes):
    """doc_ids, the Elias-Fano ends and the ids of a block."""
    view = memoryview(raw)
    if bytes(view[:4]) != _MAGIC:
        raise ValueError("not a block of token ids")
    nulls, base, size = struct.unpack_from("<QqQ", view, 4)
    at = 4 + struct.calcsize("<QqQ")
    ends, used = EliasFano.unpack(view[at:])
    names, more = EliasFano.unpack(view[at + used:])
    at += used + more
    doc_ids = [None] * nulls + (names.decode().view(np.int64) + base).tolist()
    return doc_ids, ends, np.frombuffer(view[at: at + size], "<u4")


def word_by_word(spec: dict) -> bool:
    """Whether a tokenizer file encodes a text as the sum of its words, as ``WordEncoder`` takes it.

    That holds for a normalizer of NFC, white space and lower case, a split that drops white space and
    keeps runs of letters and of marks apart, merges that end at a word's end, and nothing added or
    cut afterwards. The added tokens must hold ``<`` and no place where words are cut.
    """
    cuts = lambda text: any(_PARTS[_KIND[a], _KIND[b]] for a, b in zip(text, text[1:], strict=False))
    kinds = lambda part, name: [x.get("type") for x in (spec.get(part) or {}).get(name, [])]
    split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    pattern = (split.get("pattern") or {}).get("Regex", "")
    model = spec.get("model") or {}
    return (kinds("normalizer", "normalizers") == ["NFC", "Replace", "Lowercase"]
            and kinds("pre_tokenizer", "pretokenizers") == ["Split", "ByteLevel"]
            and split.get("behavior") == "Removed" and split.get("invert") is True
            and pattern.endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
            and not any(spec.get(k) for k in ("truncation", "padding", "post_processor"))
            and model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("dropout")
            and all("<" in t["content"] and not t["content"].split()[1:] and not cuts(t["content"].encode())
                    and not t.get("lstrip") and not t.get("rstrip") for t in spec.get("added_tokens", [])))


class Encoder:
    """Ids of texts by the tokenizer, whole text by whole text."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each text has."""
        found = self.tokenizer.encode_batch_fast([t or "" for t in column.to_pylist()], add_special_tokens=False)
        parts = [np.array(e.ids, dtype="<u4") for e in found]
        return np.concatenate([np.zeros(0, "<u4"), *parts]), np.array([len(p) for p in parts], dtype=np.int64)


class WordEncoder(Encoder):
    """Ids of texts word by word, for tokenizers that ``word_by_word`` accepts.

    The words of a slice are found, hashed and reduced to the different ones in numpy; only words that
    are not in the cache go to the tokenizer. Words are taken between blanks and line breaks, and are cut
    between ASCII letters, single digits and marks, as the tokenizer itself does, but never beside an
    apostrophe, ``<``, ``|``, ``>`` or a byte that is not ASCII; ASCII words without these are taken in
    lower case. The cache keeps bytes and ids of words in flat arrays of bounded
    size; a hit is verified against the bytes, and words not used lately are dropped.
    """

    def __init__(self, tokenizer, cache_bytes: int = CACHE_BYTES):
        super().__init__(tokenizer)
        self.cache_bytes, self.turn = cache_bytes, 0
        self.ends = np.zeros(tokenizer.get_vocab_size() + 1, dtype=bool)
        for token, number in tokenizer.get_vocab().items():
            self.ends[number] = token.endswith("</w>")
        self.hash, self.slot = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)   # hashes in order, places of their words
        self.used = np.zeros(0, dtype=np.int32)
        self.word, self.ids = _Lists.empty(np.uint8), _Lists.empty(np.dtype("<u4"))

    def _words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes (lowered where that changes nothing), start and end of each word, and the first word of each text."""
        raw, offsets = utf8(column)
        kind = np.zeros(len(raw) + 2, dtype=np.uint8)
        np.take(_KIND, raw, out=kind[1:-1])
        pair = kind[:-1] * np.uint8(5) + kind[1:]
        begins, ends = _BEGINS[pair[:-1]], _ENDS[pair[1:]]
        cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(raw))]  # no word crosses texts
        begins[cut] = kind[cut + 1] != _BLANK
        ends[cut - 1] = kind[cut] != _BLANK
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        data = _LOWER[raw]
        kept = np.zeros(len(raw) + 1, dtype=np.int32)
        np.cumsum(kind[1:-1] == _WHOLE, out=kept[1:])
        odd = np.flatnonzero(kept[end] > kept[start])
        places = spans(start[odd], end[odd] - start[odd])
        data[places] = raw[places]
        return data, start, end, np.searchsorted(start, offsets)

    def _encoded(self, words: list[str]) -> _Lists:
        """Ids of each word; words of letters are encoded many at a time, parted by the ids that end a word."""
        letters = [i for i, w in enumerate(words) if len(w) <= CACHED_CHARS and w.isalpha()]
        taken = set(letters)
        rest = [i for i in range(len(words)) if i not in taken]
        data, sizes, order = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)], []
        for at in range(0, len(letters), 512):
            part = letters[at: at + 512]
            ids = np.array(self.tokenizer.encode(" ".join([words[i] for i in part]), add_special_tokens=False).ids, dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):      # some word is not one run of letters to the tokenizer
                rest += part
                continue
            data.append(ids)
            sizes.append(np.diff(cuts, prepend=0))
            order += part
        for at in range(0, len(rest), 8192):
            part = rest[at: at + 8192]
            found = [e.ids for e in self.tokenizer.encode_batch_fast([words[i] for i in part], add_special_tokens=False)]
            data.append(np.array([x for ids in found for x in ids], dtype="<u4"))
            sizes.append(np.array([len(ids) for ids in found], dtype=np.int64))
            order += part
        back = np.empty(len(words), dtype=np.int64)
        back[order] = np.arange(len(words))
        return _Lists.of(np.concatenate(data), np.concatenate(sizes)).pick(back)

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        self.turn += 1
        data, start, end, firsts = self._words(column)
        hashes = run_hash(_BYTES[data], start, end) + (end - start).astype(np.uint64)
        order = np.argsort(hashes)
        known = hashes[order]
        head = np.ones(len(known), dtype=bool)
        np.not_equal(known[1:], known[:-1], out=head[1:])
        back = np.empty(len(known), dtype=np.int64)
        back[order] = np.cumsum(head) - 1
        first = order[head]
        known, start, size = known[head], start[first], end[first] - start[first]
        at = np.minimum(np.searchsorted(self.hash, known), max(len(self.hash) - 1, 0))
        seen = self.hash[at] == known if len(self.hash) else np.zeros(len(known), dtype=bool)
        hit = seen.copy()
        hit[seen] = self.word.equal(self.slot[at[seen]], data, start[seen], size[seen])
        slots = self.slot[at[hit]]
        self.used[slots] = self.turn
        miss = np.flatnonzero(~hit)
        new_words = _Lists.cut(data, start[miss], size[miss])
        new = self._encoded(new_words.texts())
        place = np.empty(len(known), dtype=np.int64)
        place[hit], place[miss] = slots, len(self.ids) + np.arange(len(miss))
        ids = _Lists.both(self.ids, new).pick(place[back])
        stops = np.concatenate([[0], np.cumsum(ids.sizes)])[firsts]
        fresh = np.flatnonzero((new_words.sizes <= CACHED_CHARS) & ~seen[miss])
        self._remember(known[miss[fresh]], new_words.pick(fresh), new.pick(fresh))
        return ids.data, np.diff(stops)

    def _remember(self, hashes: np.ndarray, words: _Lists, ids: _Lists) -> None:
        """Add words to the cache, in the order of their hashes."""
        at = np.searchsorted(self.hash, hashes)
        self.hash = np.insert(self.hash, at, hashes)
        self.slot = np.insert(self.slot, at, len(self.ids) + np.arange(len(hashes)))
        self.word, self.ids = _Lists.both(self.word, words), _Lists.both(self.ids, ids)
        self.used = np.concatenate([self.used, np.full(len(hashes), self.turn, dtype=np.int32)])
        if self.size() > self.cache_bytes:                           # keep the half that was used last
            last = np.argsort(-self.used[self.slot], kind="stable")
            kept = np.sort(last[: len(last) // 2])
            slots = self.slot[kept]
            self.hash, self.slot, self.used = self.hash[kept], np.arange(len(kept)), self.used[slots]
            self.word, self.ids = self.word.pick(slots), self.ids.pick(slots)

    def size(self) -> int:
        """Bytes the cache holds."""
        return self.hash.nbytes + self.slot.nbytes + self.used.nbytes + self.word.size() + self.ids.size()


@dataclass
class _Lists:
    """Lists of numbers in one array, with their sizes and starts."""
    data: np.ndarray
    sizes: np.ndarray
    starts: np.ndarray

    def __len__(self) -> int:
        return len(self.sizes)

    @classmethod
    def of(cls, data: np.ndarray, sizes: np.ndarray) -> _Lists:
        return cls(data, sizes, np.cumsum(sizes) - sizes)

    @classmethod
    def empty(cls, kind) -> _Lists:
        return cls.of(np.zeros(0, dtype=kind), np.zeros(0, dtype=np.int64))

    @classmethod
    def cut(cls, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> _Lists:
        return cls.of(data[spans(start, size)], size)

    @classmethod
    def both(cls, a: _Lists, b: _Lists) -> _Lists:
        return cls(np.concatenate([a.data, b.data]), np.concatenate([a.sizes, b.sizes]), np.concatenate([a.starts, b.starts + len(a.data)]))

    def pick(self, at: np.ndarray) -> _Lists:
        return _Lists.cut(self.data, self.starts[at], self.sizes[at])

    def equal(self, at: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether lists ``at`` are the pieces [start, start + size) of ``data``."""
        same = self.sizes[at] == size
        at, start, size = at[same], start[same], size[same]
        if len(at):
            differs = self.data[spans(self.starts[at], size)] != data[spans(start, size)]
            same[same] = np.add.reduceat(differs, np.cumsum(size) - size) == 0
        return same

    def texts(self) -> list[str]:
        raw = self.data.tobytes()
        return [raw[a: a + n].decode() for a, n in zip(self.starts.tolist(), self.sizes.tolist(), strict=True)]

    def size(self) -> int:
        return self.data.nbytes + self.sizes.nbytes + self.starts.nbytes


# Kinds of bytes: blanks and line breaks, ASCII letters, digits, marks, and bytes whose neighbours stay
# with them (other white space and controls, non-ASCII, and the marks of contractions and added tokens).
_BLANK, _A, _ONE, _MARK, _WHOLE = range(5)
_KIND = np.full(256, _WHOLE, dtype=np.uint8)
_KIND[33:127] = _MARK
_KIND[[10, 32]] = _BLANK
_KIND[65:91] = _KIND[97:123] = _A
_KIND[48:58] = _ONE
_KIND[[ord(c) for c in "'<|>"]] = _WHOLE
_PARTS = np.array([[b != _BLANK and (a == _BLANK or (a != b and _WHOLE not in (a, b)) or a == b == _ONE) for b in range(5)] for a in range(5)])
_BEGINS = _PARTS.ravel()                                                # of (kind before, kind): a word begins here
_ENDS = np.array([[a != _BLANK and (b == _BLANK or _PARTS[a, b]) for b in range(5)] for a in range(5)]).ravel()  # of (kind, kind after)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTES = mix(np.arange(1, 257, dtype=np.uint64))

_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    import json
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoders:
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        _encoders[path] = (WordEncoder if word_by_word(spec) else Encoder)(Tokenizer.from_file(path))
    return _encoders[path]


def _blocks(batches, path, end_id, block_ids):
    """Blocks of one partition in order: (part, skip, n_ids, n_docs, data)."""
    from pyspark import TaskContext
    part, skip = TaskContext.get().partitionId(), 0
    names, pieces, ends, size = [], [], [], 0
    end = struct.pack("<I", end_id)

    def block():
        return pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "skip": pa.array([skip], pa.int64()),
            "n_ids": pa.array([size], pa.int64()), "n_docs": pa.array([len(names)], pa.int64()),
            "data": pa.array([pack_block(names, np.array(ends), b"".join(pieces))], pa.binary())})

    encoder = _encoder(path)
    for batch in slices(batches):
        ids, counts = encoder.texts(batch.column("text"))
        stops = np.cumsum(counts)
        for name, n, stop in zip(batch.column("doc_id").to_pylist(), counts.tolist(), stops.tolist(), strict=True):
            if names and size + n + 1 > block_ids:
                yield block()
                skip += size
                names, pieces, ends, size = [], [], [], 0
            names.append(name)
            pieces += [ids[stop - n: stop].tobytes(), end]
            size += n + 1
            ends.append(size)
    if names:
        yield block()


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID,
                 block_ids: int = BLOCK_IDS) -> None:
    """Encode every text and write the blocks below ``path``.

    ``docs`` has columns doc_id (integer) and text. Rows are dealt by ranges of doc_id (null
    first; rows with one doc_id in the order of their texts) and each task writes its range. A
    null or empty text is the end id alone. A block has whole documents and ``block_ids`` ids at
    most, or one longer document. An empty table writes no block.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text").asc_nulls_first()]
    dealt = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    dealt.mapInArrow(lambda it: _blocks(it, tokenizer, end_id, block_ids),
                     BLOCKS).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written file: doc_id, start, n_tokens and ids (binary), one row each.

    A block stores the ids before it in its part; the starts of parts are sums over one row a
    part, for which the data column is not read. Nothing is shuffled.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)
    sums = [(r.part, r.n) for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()]
    before = np.concatenate([[0], np.cumsum([n for _, n in sums], dtype=np.int64)]).tolist()
    starts = spark.createDataFrame([(p, b) for (p, _), b in zip(sums, before, strict=False)], "part int, part_start bigint")
    return blocks.join(F.broadcast(starts), "part").select(
        (F.col("part_start") + F.col("skip")).alias("block_start"), "data").mapInArrow(
        _documents, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def _documents(batches):
    for batch in batches:
        for start, raw in zip(batch.column("block_start").to_pylist(), batch.column("data"), strict=True):
            names, code, ids = unpack_block(raw.as_buffer())
            ends = code.decode().astype(np.int64)
            begins = np.concatenate([[0], ends[:-1]])
            view = ids.tobytes()
            for at in range(0, len(names), 1024):
                part = slice(at, at + 1024)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(names[part], pa.int64()), "start": pa.array(begins[part] + start, pa.int64()),
                    "n_tokens": pa.array((ends - begins)[part], pa.int64()),
                    "ids": pa.array([view[4 * a: 4 * b] for a, b in zip(begins[part], ends[part], strict=True)], pa.binary())})


def token_rows(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the token file to the shared folder and read it back: doc_id, start, n_tokens, ids_crc32."""
    path = new_shared_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return read_tokens(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


__all__ = ["EliasFano", "Encoder", "WordEncoder", "pack_block", "read_tokens", "token_rows", "unpack_block", "word_by_word", "write_tokens"]
