"""The ten operators against plain Python on small tables with awkward rows."""

import hashlib
import itertools
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabquorum.llm import components, decontamination, exact, html, language, mixing, near, private, quality, tokens, urls
from tabquorum.llm.arrays import words_of
from tabquorum.llm.queries import RULES, TOKENIZER

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = prose(rng, 120)
    edited = base.split(" ")
    edited[60] = "CHANGED"
    out = [None, "", "   \n\t", "a", "A b c", "a  b\nc", base, base.upper(), base + " tail", " ".join(edited), base.replace(" ", "\n"),
           prose(rng, 5000), "x" * 30_000, prose(rng, 8), "7 7 7 7 7 7 7 7", "Ünïcode 𝄞 clef 𝄞 " + prose(rng, 20)]
    return out + [base, prose(rng, 40), "a"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s0", None][i % 3], 0) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "no id", None, None, None)], DOCS).withColumn("key", F.lit("clash"))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_words_match_the_pattern(texts):
    column = pa.array(texts)
    w = words_of(column)
    raw = w.data.tobytes()
    found = [[] for _ in texts]
    for d, s, e in zip(w.doc, w.start, w.end, strict=True):
        found[d].append(lower(raw[s:e].decode()))
    assert found == [words(t) for t in texts]
    hashes = {}
    for d, s, e, h in zip(w.doc, w.start, w.end, w.hash, strict=True):
        assert hashes.setdefault(lower(raw[s:e].decode()), h) == h
    assert len(set(hashes.values())) == len(hashes)


def test_components(spark):
    edges = [("b", "a"), ("c", "b"), ("d", "c"), ("e", "d"), ("x", "y"), ("z", "z"), ("b", "a"), (None, "q")]
    rows = components.components(spark.createDataFrame(edges, "a string, b string")).collect()
    assert {(r.node, r.root) for r in rows} == {(n, "a") for n in "abcde"} | {("x", "x"), ("y", "x")}


# 1 ------------------------------------------------------------------------------------------

def test_urls(spark):
    pages = [(0, "https://WWW.Example.ORG/es/1?q#f"), (1, "http://example.org/en/12"), (2, "x.org"), (3, None),
             (4, "ftp://cheap-pillsnow.example.net/en"), (5, "http://goodwords.example.net/en"), (6, "http://a.com/de/"),
             (7, "http://a.com?/de/"), (8, "http://notorg/"), (8, "http://notorg/"), (9, ""), (10, "http://b.com/fr/://x")]
    frame = spark.createDataFrame(pages, "page_id long, url string").withColumn("word", F.lit(1))
    counts = urls.word_counts(spark.createDataFrame([("good words cheap pills now good words example net",), (None,)], "text string"))
    rows = {r.page_id: r for r in urls.judge(frame, counts, RULES).collect()}
    assert (rows[0].host, rows[0].path, rows[0].rule, rows[0].verdict) == ("www.example.org", "/es/1", "example.org/es/", "block")
    assert (rows[1].rule, rows[6].rule, rows[10].rule) == ("example.org/en/1", "com/de/", "com/fr/")
    assert [rows[i].host for i in (2, 3, 9)] == ["", "", ""] and rows[3].verdict == "allow"
    assert rows[7].path == "" and rows[7].rule is None and rows[8].rule is None
    assert rows[4].host_words == ["cheap", "pills", "now", "example", "net"] and rows[4].verdict == "block"
    assert rows[5].host_words[:2] == ["good", "words"] and rows[5].verdict == "allow"
    assert urls.judge(frame, counts, RULES).count() == len(pages)
    assert urls.judge(frame.limit(0), counts, RULES).count() == 0


def test_hosts_without_a_seed_word_are_blocked_by_what_they_share(spark):
    """Words that go with seed words in other hosts decide; seed words themselves are no features."""
    bad = [f"http://{a}.{b}luck.example.net/win/{i}" for i, (a, b) in enumerate([("casino", "mega"), ("poker", "big"), ("jackpot", "mega"), ("casino", "hot")])]
    good = [f"http://site{'abcdefghij'[i % 10]}.garden.example.net/page/{i}" for i in range(30)]
    asked = ["http://megaluck.example.net/win/7", "http://garden.example.net/page/7", "http://unseenword.example.net/page/1", "http://poker.garden.example.net/page/2"]
    frame = spark.createDataFrame(list(enumerate(bad + good + asked)), "page_id long, url string")
    counts = urls.word_counts(spark.createDataFrame([("casino poker jackpot mega big hot luck garden site example net unseen word " * 3,)], "text string"))
    rows = {r.page_id: r for r in urls.judge(frame, counts, []).collect()}
    told = [rows[len(bad) + len(good) + i] for i in range(4)]
    assert not any(set(r.host_words) & set(urls.SEED_WORDS) for r in told[:3])
    assert [r.verdict for r in told] == ["block", "allow", "allow", "block"]
    assert told[0].log_odds > 0 > told[1].log_odds and not told[0].example and told[3].example
    assert told[3].log_odds < 0         # blocked as an example, not through a feature
    none = {r.page_id: r for r in urls.judge(frame, counts, [], seeds=[]).collect()}
    assert all(r.verdict == "allow" for r in none.values())


def test_bayes_against_counts(spark):
    rng = random.Random(4)
    rows = [(f"h{rng.randrange(12)}", rng.random() < 0.4, [rng.randrange(9) for _ in range(rng.randrange(5))]) for _ in range(80)]
    rows = [(h, int(h[1:]) % 3 == 0, b) for h, _, b in rows]
    odds, prior = urls.learned_odds(spark.createDataFrame(rows, "host string, bad boolean, buckets array<int>"))
    seen = {(h, bad, b) for h, bad, bs in rows for b in bs}
    count = Counter((bad, b) for _, bad, b in seen)
    vocabulary = {b for _, _, b in seen}
    size = {bad: sum(count[bad, b] + 1 for b in vocabulary) for bad in (True, False)}
    for b in range(12):
        want = math.log((count[True, b] + 1) / size[True] * size[False] / (count[False, b] + 1)) if b in vocabulary else 0.0
        assert odds[b] == pytest.approx(want)
    hosts = Counter({h: bad for h, bad, _ in rows}.values())
    assert prior == pytest.approx(math.log((hosts[True] + 1) / (hosts[False] + 1)))


def test_very_long_hosts(spark):
    import time
    name = "goodwords" * 11_000 + "q" * 1000
    begun = time.perf_counter()
    words_ = urls.best_split(name, [i * 9 for i in range(11_000)] + [i * 9 + 4 for i in range(11_000)], ["good"] * 11_000 + ["words"] * 11_000,
                             [2.0] * 22_000, 9.0)
    assert time.perf_counter() - begun < 1 and words_[:2] == ["good", "words"] and words_[-1] == "q" * 1000
    counts = urls.word_counts(spark.createDataFrame([("good words",)], "text string"))
    page = spark.createDataFrame([(1, f"http://{name}.net/x")], "page_id long, url string")
    assert urls.judge(page, counts, []).first().host_words[:2] == ["good", "words"]


def test_viterbi_is_the_best_split():
    costs = {"ab": 2.0, "abc": 4.0, "c": 1.5, "cd": 1.0, "d": 3.0}
    name, unknown = "abcd", 9.0

    def cost(w):
        return costs.get(w, unknown + len(w) * np.log(10))
    splits = [[name[a:b] for a, b in zip((0, *cut), (*cut, 4), strict=True)] for r in range(4) for cut in itertools.combinations((1, 2, 3), r)]
    hits = [(s, w, c) for w, c in costs.items() for s in range(4) if name.startswith(w, s)]
    got = urls.best_split(name, *zip(*hits, strict=True), unknown)
    assert sum(map(cost, got)) == pytest.approx(min(sum(map(cost, s)) for s in splits))


# 2 ------------------------------------------------------------------------------------------

def test_exact_dedup(docs, empty):
    groups = {}
    rows = docs.collect()
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append((-len(r.text or ""), r.doc_id is None, r.doc_id))
    out = exact.dedup(docs.union(docs.where("doc_id = 3"))).collect()
    assert len(out) == len(rows) + 1 and sum(r.kept for r in out) == len(groups)
    for key, members in groups.items():
        sha = hashlib.sha256(key.encode()).hexdigest()
        mine = [r for r in out if r.text_sha256 == sha]
        extra = sum(m[2] == 3 for m in members)
        assert {r.keep_id for r in mine} == {min(members)[2]} and {r.group_size for r in mine} == {len(members) + extra}
        assert [r.doc_id for r in mine if r.kept] == [min(members)[2]]
    assert exact.dedup(empty).count() == 0


def test_cuckoo_index_is_a_set():
    rng, index, live = random.Random(1), exact.CuckooIndex(2), set()
    keys = [hashlib.sha256(str(i).encode()).digest() + b"0" * 16 for i in range(3000)]
    keys += [k[:8] + bytes([i]) * 40 for i, k in enumerate(keys[:6])]     # same fingerprint and buckets
    for _ in range(12_000):
        key = rng.choice(keys)
        if rng.random() < 0.6:
            assert index.insert(key)[1] == (key not in live)
            live.add(key)
        else:
            assert (index.delete(key) >= 0) == (key in live)
            live.discard(key)
    assert len(index) == len(live) and index.resizes > 0
    assert all((index.find(k) >= 0) == (k in live) for k in keys)


def test_stored_index(spark, docs):
    sigs = docs.select(exact.signature(F.col("text")).alias("sig")).distinct()
    index = exact.update_index(None, sigs.withColumn("live", F.lit(True)), 3)
    one = docs.where("doc_id = 6").select(exact.signature(F.col("text")).alias("sig"))
    index = exact.update_index(index, one.withColumn("live", F.lit(False)), 3)
    assert index.agg(F.sum("live")).first()[0] == sigs.count() - 1
    assert exact.probe_index(index, sigs, 3).where("NOT live").count() == 1


# 3 ------------------------------------------------------------------------------------------

def shingle_set(text):
    w = words(text)
    return {tuple(w[i: i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()


def brute_links(rows):
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    root, links = {i: i for i in sets}, Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: find(i) for i in sets}, links


@pytest.mark.parametrize("block", [near.BLOCK, 3])
def test_near_classes(spark, docs, empty, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    monkeypatch.setattr(near, "SET_BLOCK", 150 * block)
    rng = random.Random(3)
    base = prose(rng, 150).split(" ")
    many = [(100 + i, " ".join(w if rng.random() > 0.01 else "new" + str(i) for w in base)) for i in range(30)]
    more = spark.createDataFrame([(i, t, None, None, 0, "x") for i, t in many], docs.schema)
    rows = docs.union(more)
    roots, links = brute_links([(r.doc_id, r.text) for r in rows.collect()])
    out = near.near_classes(rows).collect()
    assert len(out) == len(roots) + 1
    for r in out:
        if r.doc_id is None:
            assert r.class_id is None and r.n_links == 0
        else:
            assert (r.class_id, r.n_links) == (roots[r.doc_id], links[r.doc_id])
    kept = near.drop_near_duplicates(rows)
    assert kept.columns == rows.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(roots.values()))
    assert near.near_classes(empty).count() == 0


def test_posterior_floor():
    for n in (8, 32, 96):
        grid = (np.arange(200_000) + 0.5) / 200_000
        density = [grid ** m * (1 - grid) ** (n - m) for m in range(n + 1)]
        tail = [d[grid >= 0.8].sum() / d.sum() for d in density]
        assert near.posterior_floor(n) == next(m for m in range(n + 1) if tail[m] >= near.TOLERANCE)


# 4 ------------------------------------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_personal_data(spark, docs, empty):
    rng = random.Random(11)
    pieces = ["a@b.co", "x%y@c-d.e.f", "@", "a@b", "1.2.3.4", "256.1.1.1", "0001.2.3.00255", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111",
              "4111-1111-1111-1112", "+1 (017) 555-7713", "+12", " ", "\n", "é𝄞", "(123) 456-7890", 'token = "abcdef1234567890abcd"', "-", "+"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 30))) for _ in range(300)]
    texts += ["9" * 20_000, "1 " * 20_000, "a" * 30_000, "9.9.9.9 " * 3000, "a.b@c.d%e@f.g", None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit(0))
    out = by_id(private.personal_data(frame))
    for i, t in enumerate(texts):
        want = base_spans(t)
        assert out[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (t, out[i].spans)
        assert set(filter(None, want.split(","))) <= set(out[i].spans.split(","))
        assert out[i].n_ip == want.count("ip:") and out[i].n_card == want.count("card:")
    plain = spark.createDataFrame([(i, f'ab cd api token = "abcdef1234567890{i}" ef {i}.2.3.4 gh') for i in range(40)], "doc_id long, text string")
    assert all("secret:10:" in r.spans and "ip:" in r.spans for r in private.personal_data(plain).collect())
    assert private.personal_data(docs).count() == docs.count() and private.personal_data(empty).count() == 0


def test_labelers_are_weighed_by_agreement():
    told = private.estimate([("card", True, (1, 1, 0, 1), 500), ("card", False, (-1, -1, 0, -1), 400), ("card", False, (-1, -1, 1, -1), 60),
                             ("card", False, (1, 1, -1, 1), 20), ("secret", False, (1, 0, 0, 1), 3)])
    assert told.posterior["card", (1, 1, -1, 1)] > 0.9 > 0.1 > told.posterior["card", (-1, -1, 0, -1)]
    assert told.posterior["card", (-1, -1, 1, -1)] < 0.5       # one unreliable cue does not outweigh three labelers
    assert told.posterior["secret", (1, 0, 0, 1)] > 0.9        # no other kind speaks about secrets


def test_estimates_against_rows_counted_one_by_one():
    """The same expectation maximisation over single spans instead of counted patterns."""
    rng = random.Random(8)
    spans = [(truth and rng.random() < 0.3, tuple(rng.choices((-1, 0, 1), (1, 3, 6) if truth else (6, 3, 1))[0] for _ in range(4)))
             for truth in [rng.random() < 0.4 for _ in range(300)]]
    spans = [(base, (1, *v[1:]) if base else v) for base, v in spans]
    p = [1.0 if base else private.believed(v) for base, v in spans]
    n = len(spans)
    for _ in range(private.ROUNDS):
        asked = [x for x, (base, _) in zip(p, spans, strict=True) if not base]
        prior = (sum(asked) + private.WEIGHT * n / 2) / (len(asked) + private.WEIGHT * n)
        seen = lambda i, s, truth: ((private.WEIGHT * n * (private.TRUE if truth else private.FALSE)[i][s + 1] + sum(
            (x if truth else 1 - x) for x, (_, v) in zip(p, spans, strict=True) if v[i] == s))
            / (private.WEIGHT * n + sum(x if truth else 1 - x for x in p)))
        ratio = [{s: math.log(seen(i, s, True) / seen(i, s, False)) for s in (-1, 0, 1)} for i in range(4)]
        p = [1.0 if base else 1 / (1 + math.exp(-(math.log(prior / (1 - prior)) + sum(ratio[i][s] for i, s in enumerate(v)))))
             for base, v in spans]
    told = private.estimate([("ip", base, v, c) for (base, v), c in Counter(spans).items()])
    for x, (base, v) in zip(p, spans, strict=True):
        assert base or told.posterior["ip", v] == pytest.approx(x, abs=1e-9)


PII = ['token = "24be64439e3e49cf46b2d7c9"', "api_key: Zx81kd93ksLq02kd", "password = welcome", "secret: changeme1", "4111 1111 1111 1112",
       "version 4111111111111112", "Mr. Peter Smith", "Dr. Foo", "bob [at] mail [dot] com", "x [at] y [dot] q9", "(555) 234-5678", "123 056 7890",
       "4111-1111-1111-1111", "a@b.org", "contact 10.0.0.1"]


def test_spans_do_not_depend_on_repeated_rows(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(PII) if rng.random() < 0.2 else prose(rng, 3) for _ in range(12)) for _ in range(150)]
    spans = lambda times: {r.doc_id: r.spans for r in private.personal_data(spark.createDataFrame(
        [(i, t) for t_ in range(times) for i, t in enumerate(texts)], "doc_id long, text string")).collect()}
    once = spans(1)
    assert once == spans(2) == spans(20)
    found = lambda text: [k for i, t in enumerate(texts) for k in [text in t and f":{t.index(text)}:" in once[i]] if text in t]
    assert all(found(PII[0])) and all(found(PII[1]))                           # strong secrets are added
    assert not any(found(PII[2])) and not any(found(PII[4])) and not any(found(PII[5]))   # words and failing numbers are not


def test_votes_on_proposals_differ(spark):
    rows = private.find_spans(spark.createDataFrame(list(enumerate(PII)), "doc_id long, text string")).collect()
    votes = {(s.kind, tuple(s.votes)) for r in rows for s in r.loose}
    by_kind = Counter(kind for kind, _ in votes)
    assert by_kind["secret"] >= 3 and by_kind["card"] >= 2 and by_kind["email"] >= 2 and by_kind["name"] >= 2 and by_kind["phone"] >= 2


def test_planted_personal_data_is_found(spark, sf_dir):
    """Every email, address, phone, passing card and hexadecimal token of the given documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = by_id(private.personal_data(docs))
    planted = found = 0
    for r in docs.collect():
        text = r.text or ""
        secrets = [m.start() for m in re.finditer(r'token = "[0-9a-f]{40}"', text)]
        planted += len(secrets) + (base_spans(text) != "")
        found += sum(f"secret:{a}:" in out[r.doc_id].spans for a in secrets) + (base_spans(text) != "" and out[r.doc_id].n_spans > 0)
    assert planted and found >= 0.9 * planted


# 5 ------------------------------------------------------------------------------------------

def test_quality(spark, docs, empty):
    rng = random.Random(2)
    rows, grades = [], []
    for i in range(600):
        kind = i % 3
        text = prose(rng, 60).split(" ")
        if kind == 0:
            text[rng.randrange(60)] = text[rng.randrange(60)] = "awfulword"
        if kind == 1:
            text = [w.upper() + "!!" for w in text]
        rows.append((i, " ".join(text)))
        grades.append((i, kind))
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("tails", F.lit("clash"))
    labels = spark.createDataFrame([*grades, (None, 1), (7, None), (999, 2)], "doc_id long, grade int")
    model = quality.train(frame.select("doc_id", "text"), labels.where("doc_id % 5 <> 0 OR doc_id IS NULL"))
    out = by_id(quality.grade(frame.select("doc_id", "text"), model))
    held = [i for i in range(0, 600, 5)]
    right = sum(sum(p >= 0.5 for p in out[i].tails) == i % 3 for i in held)
    assert right >= 0.95 * len(held)
    assert all(r.tails[0] >= r.tails[1] and r.expected_grade == pytest.approx(sum(r.tails)) for r in out.values())
    assert quality.grade(docs, model).count() == docs.count() and quality.grade(empty, model).count() == 0
    blank = quality.train(docs.select("doc_id", "text"), labels.limit(0))
    assert len({tuple(r.tails) for r in quality.grade(docs, blank).collect()}) == 1


# 6 ------------------------------------------------------------------------------------------

def test_decontamination(spark, docs, texts, empty):
    items = [("a", " ".join(words(texts[6])[10:40])), ("b", "7 7 7"), ("c", None), ("d", ""), ("e", " ".join(words(texts[11])[100:113])),
             ("b", "7 7 7"), ("f", "x" * 30_000)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    windows = [(item, w[i: i + k]) for item, t in items for w in [words(t)] for k in [min(len(w), 13)] if w for i in range(len(w) - k + 1)]
    for part in (decontamination.PART, 5):
        out = by_id(decontamination.judged(decontamination.scan(docs, bench, part=part)))
        for i, t in enumerate(texts):
            w = words(t)
            hit, of = set(), set()
            for item, win in windows:
                for p in range(len(w) - len(win) + 1):
                    if w[p: p + len(win)] == win:
                        hit |= set(range(p, p + len(win)))
                        of.add(item)
            r = out[i]
            assert (r.n_words, r.n_hit, r.n_items) == (len(w), len(hit), len(of)), i
            assert r.items_sha256 == hashlib.sha256(",".join(sorted(of)).encode()).hexdigest()
            assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
    clean = decontamination.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, r in out.items() if not r.contaminated}
    cut = by_id(decontamination.without_spans(decontamination.scan(docs, bench)))
    assert words(cut[6].text) == words(texts[6])[:10] + words(texts[6])[40:] and cut[3].text == texts[3]
    assert decontamination.scan(empty, bench).count() == 0
    assert decontamination.judged(decontamination.scan(docs, bench.limit(0))).where("contaminated").count() == 0


# 7 ------------------------------------------------------------------------------------------

def test_language(spark, docs, empty):
    rng = random.Random(4)
    alphabets = {"aa": "abcdef", "bb": "defghi", "cc": "éèêëab"}
    rows = [(i, " ".join("".join(rng.choice(a) for _ in range(5)) for _ in range(60)), lang) for i, (lang, a) in enumerate(list(alphabets.items()) * 60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(frame.where("doc_id % 3 <> 1 OR doc_id > 90"))
    out = by_id(language.predict(frame, model))
    assert np.mean([out[i].lang_pred == lang for i, _, lang in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in out.values())
    odd = by_id(language.predict(docs, model))
    assert odd[0].lang_pred == odd[1].lang_pred == odd[14].lang_pred == "und" and odd[3].lang_pred in alphabets
    nothing = language.train(empty)
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"} and language.predict(empty, model).count() == 0


# 8 ------------------------------------------------------------------------------------------

@pytest.mark.parametrize("values", [[], [0], [5], [0, 0, 0, 9], list(range(1000)), [2 ** 40, 2 ** 40 + 1, 2 ** 41]])
def test_elias_fano(values):
    code = tokens.EliasFano.encode(np.array(values, dtype=np.uint64))
    code, used = tokens.EliasFano.unpack(memoryview(code.pack()))
    assert code.decode().tolist() == values and [code.select(i) for i in range(len(values))] == values
    if len(values) == 1000:
        assert used < 1000 * 8 / 8


def test_token_file(spark, docs, texts, empty):
    from tokenizers import Tokenizer
    path = public_tokenizers.path(TOKENIZER)
    plain = Tokenizer.from_file(path)
    special = spark.createDataFrame([(100, "a<|endoftext|>b <|startoftext|>\x1c\x85x it's é İ", None, None, 0, "x")], docs.schema)
    rows = docs.union(special).union(docs.where("doc_id = 5"))
    out = tokens.token_rows(rows, path).collect()
    want = sorted(((r.doc_id, plain.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in rows.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    at, got = 0, sorted(out, key=lambda r: r.start)
    assert len(got) == len(want)
    for r, (i, ids) in zip(got, want, strict=True):
        assert (r.doc_id, r.start, r.n_tokens) == (i, at, len(ids))
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        at += len(ids)
    assert tokens.token_rows(empty, path).count() == 0


# 9 ------------------------------------------------------------------------------------------

def targets(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, target, free = sum(sizes.values()), {}, set(sizes)
    while free:
        left, mass = total - sum(target.values()), sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * left / mass > 3 * sizes[s]}
        target |= {s: 3.0 * sizes[s] if s in over else weight[s] * left / mass for s in (over or free)}
        free -= over or free
    return target


def test_mixing(spark, docs, empty):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), None, rng.choice(["a", "a", "a", "b", "c", "d", None]), 0, "x") for i in range(2000)]
    frame = spark.createDataFrame([*rows, (5000, " w\x1cw w w ", None, "tiny", 0, "x")], docs.schema)
    out = mixing.mix_sources(frame).collect()
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
    assert {r.doc_id: r.size for r in out}[5000] == 2
    for s, t in targets(sizes).items():
        assert all(r.target == pytest.approx(t) for r in out if r.source == s)
        assert abs(taken[s] - t) <= largest[s]
    assert sorted(mixing.mix_sources(frame.repartition(7)).collect()) == sorted(out)
    rows = mixing.mixed_rows(frame)
    assert rows.columns == frame.columns
    assert Counter(r.doc_id for r in rows.collect()) == Counter({r.doc_id: r.copies or 1 for r in out if r.copies or not r.size})
    assert mixing.mix_sources(docs).count() == docs.count() and mixing.mix_sources(empty).count() == 0


# 10 -----------------------------------------------------------------------------------------

@pytest.mark.parametrize("page,text", [
    ("", ""), (None, ""), ("plain  text\n here", "plain text here"), ("<p>a<p>b", "a\n\nb"), ("a<br>b<br/>c", "a\nb\nc"),
    ("<ul><li>one<li>two<ol><li>x<li>y</ol></ul>z", "- one\n- two\n  1. x\n  2. y\n\nz"),
    ("<table><tr><th>n<th>name<tr><td>10<td>x</table>", "n  | name\n10 | x"),
    ("<div hidden>no</div><p style='display: none'>no</p>yes<script>if (a<b) {'</p>'}</script>", "yes"),
    ("<head><title>t</title></head><body>a &amp; b&lt;</body>", "a & b<"), ("<pre>  a\n   b</pre>c", "  a\n   b\n\nc"),
    ("<b>a</b> <i>b</i>c", "a bc"), ("</p></div>x<!-- c --> y <unclosed", "x y <unclosed"), ("<img alt='pic'> 1", "pic 1"),
])
def test_html(page, text):
    assert html.text_of(page or "") == text


def test_html_extraction(spark):
    deep = "<div>" * 20_000 + "x"
    rows = [(1, "<p>a</p>"), (1, "<p>a</p>"), (None, "b"), (2, None), (3, deep), (4, "<a <b " * 2000)]
    frame = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit(1))
    out = html.extract(frame).collect()
    assert [(r.page_id, r.text) for r in out][:5] == [(1, "a"), (1, "a"), (None, "b"), (2, ""), (3, "x")]
    assert html.extract(frame.limit(0)).count() == 0
