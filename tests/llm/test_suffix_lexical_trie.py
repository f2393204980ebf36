"""Suffix-array dedup, ranked lexical search and the conversation trie against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabquorum.llm import contraction, conversations, lexical, suffix


# suffix arrays ---------------------------------------------------------------------------------

def repeats_brute(rows, length):
    first = {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for i in range(len(text) - length + 1):
            first.setdefault(text[i: i + length], doc)
    out = []
    for doc, text in rows:
        cover = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if first[text[i: i + length]] != doc:
                cover[i: i + length] = b"\1" * length
        runs = sum(1 for i in range(len(text)) if cover[i] and (i == 0 or not cover[i - 1]))
        kept = bytes(b for b, c in zip(text, cover, strict=True) if not c)
        out.append((doc, len(text), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("raw", [b"", b"a", b"banana", b"a" * 300, b"ab" * 90, bytes(40), bytes(range(256)) * 2,
                                 bytes(random.Random(3).choices(b"ab", k=700))])
def test_suffix_array_and_common_prefixes(raw):
    data = np.frombuffer(raw, dtype=np.uint8)
    order = suffix.suffix_array(data)
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    shared = suffix.common_prefixes(data, order, 50)
    for i, n in enumerate(shared.tolist()):
        a, b = (raw[order[i - 1]:], raw[order[i]:]) if i else (b"", b"")
        size = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert n == min(size, 50)


def test_merge_by_binary_search():
    a = (np.array([b"aa", b"cc", b"ee"]), np.array([4, 5, 6]))
    b = (np.array([b"ab", b"cc", b"ff"]), np.array([1, 2, 9]))
    keys, least = suffix.merged(a, b)
    assert keys.tolist() == [b"aa", b"ab", b"cc", b"ee", b"ff"] and least.tolist() == [4, 1, 2, 6, 9]


def test_window_minima():
    values = np.array([5, 3, 8, 1, 9, 2, 7])
    for width in range(1, 8):
        assert suffix.window_minima(values, width).tolist() == [min(values[i: i + width]) for i in range(8 - width)]


@pytest.mark.parametrize("length,slice_bytes,shard_bytes,parts", [(50, 700, 300, 7), (50, 4_000_000, 4_000_000, 3), (21, 300, 100, 1)])
def test_repeats_against_brute_force(spark, length, slice_bytes, shard_bytes, parts):
    """Tiny slices and shards, texts longer than a slice, repeated ids and rows, nulls, clashing columns."""
    rng = random.Random(1)
    base = ["".join(rng.choice("abc é") for _ in range(rng.randint(0, 160))) for _ in range(40)]
    texts = [rng.choice(base) + rng.choice(base)[:90] for _ in range(140)]
    texts += ["x" * rng.randint(0, 400) for _ in range(10)] + [("ab\0\n" * 100)[: rng.randint(0, 300)] for _ in range(10)]
    texts += ["".join(base) * 2, "".join(base[::-1]), "", None, None]
    ids = [i // 2 for i in range(len(texts))]
    rng.shuffle(ids)
    rows = [(None if i == 7 else d, t, "u", 1) for i, (d, t) in enumerate(zip(ids, texts, strict=True))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_hash string, `a.b` int").repartition(parts)
    got = suffix.remove_repeats(docs, length, slice_bytes, shard_bytes).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got), key=str)
    assert got == repeats_brute([(d, (t or "").encode()) for d, t, *_ in rows], length)
    assert sum(r[2] for r in got) > 10_000


def test_repeats_of_an_empty_table(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# ranked lexical search -------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def search_brute(docs, items, top):
    words = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    n_docs, total = sum(1 for w in words if w), sum(map(len, words))
    df = Counter(t for w in words for t in set(w))
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(TERM.findall((text or "").translate(LOWER)))
    out = []
    for item, terms in wanted.items():
        scores = []
        for (doc, _), w in zip(docs, words, strict=True):
            if w:
                tf, m = Counter(w), 50 + (50 * len(w) * n_docs) // total
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 20 * m))
                            for t in terms if t in tf)
                if score > 0:
                    scores.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if null else doc, -s) for i, (s, null, doc) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def test_search_against_brute_force(spark):
    """Common and rare terms, ties, repeated rows and items, nulls, clashing columns; more than one shard."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(60)] + ["Élan", "ß", "X1y"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    docs = [(i, " ".join(rng.choices(vocab, weights, k=rng.randint(1, 60)))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, "-- !!"), (None, "w1 w2 W3"), (5, docs[5][1]), (303, "w0 " * 4000)]
    items = [(i, ", ".join(rng.choices(vocab, k=rng.randint(1, 12)))) for i in range(90)]
    items += [(90, None), (91, "unseen"), (3, "w7"), (None, "w1 élan")]
    got = lexical.search(spark.createDataFrame([(*d, 1, "s") for d in docs], "doc_id long, text string, item int, shard string").repartition(5),
                         spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, term int").repartition(3), top=7)
    assert sorted(map(tuple, got.collect()), key=str) == search_brute(docs, items, 7)


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")])])
def test_search_without_rows(spark, docs, items):
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got.collect() == []


# conversation trie -----------------------------------------------------------------------------

def trie_brute(rows, stride=100, heads=6):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % heads
        rebuilt[c] = tuple(turns.get(c - c % stride, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, who in members.items():
        own = (len(who) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += own
    return sorted(((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(who) if rebuilt[c] == p).encode()).hexdigest())
                   for p, who in members.items()), key=str)


def test_trie_against_brute_force(spark):
    """Shared first turns, a conversation of 700 turns, missing bases, nulls, ties and repeated rows."""
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "bot"]), rng.choice(["hi", "", "yes é", "no"])) for c in range(95, 330) if c != 200
            for t in range(rng.randint(0, 9))]
    rows += [(101, t, "user", "long") for t in range(20, 720)] + [(102, t, "user", "long") for t in range(20, 400)]
    rows += [(110, None, None, None), (110, 1, "user", None), (110, 1, "bot", "tie"), (110, 1, "bot", "tie"), (None, 1, "user", "x"), (-5, 1, "user", "hi")]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, depth int, parent int")
    got = sorted(map(tuple, conversations.prefix_trie(table.repartition(6)).collect()), key=str)
    assert got == trie_brute(rows)


def test_trie_of_few_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.prefix_trie(empty).collect() == []
    one = spark.createDataFrame([(100, 1, "user", "hi")], "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, conversations.prefix_trie(one).collect()), key=str) == trie_brute([(100, 1, "user", "hi")])


def test_list_digests_join_pieces_in_order(spark, monkeypatch):
    rows = spark.range(-50, 30_000).select(F.lit(1).cast("long").alias("p1"), F.lit(2).cast("long").alias("p2"),
                                           F.lit(0).cast("long").alias("depth"), F.col("id").alias("conv")).repartition(7)
    expected = hashlib.sha256(",".join(map(str, range(-50, 30_000))).encode()).hexdigest()
    assert [r.ends_sha256 for r in conversations.list_digests(rows).collect()] == [expected]


@pytest.mark.parametrize("shape", ["chain", "star", "broom", "random", "roots"])
def test_subtree_sums(spark, shape):
    rng = random.Random(4)
    parent = {"chain": lambda i: i - 1 if i else None, "star": lambda i: 0 if i else None,
              "broom": lambda i: i - 1 if 0 < i < 60 else 59 if i else None,
              "random": lambda i: rng.randrange(max(0, i - 9), i) if i else None, "roots": lambda i: i - 3 if i % 7 > 2 else None}[shape]
    up = {i: parent(i) for i in range(200)}
    kids = Counter(p for p in up.values() if p is not None)
    expected = {i: [i, 1] for i in up}
    for i in sorted(up, reverse=True):
        if up[i] is not None:
            expected[up[i]] = [a + b for a, b in zip(expected[up[i]], expected[i], strict=True)]
    table = spark.createDataFrame([(i, p, kids[i], i, 1) for i, p in up.items()], "id long, parent long, n_children long, x long, y long")
    got = {r.id: [r.x, r.y] for r in contraction.subtree_sums(table, ["x", "y"]).collect()}
    assert got == expected
