"""The registered queries, the pipeline and columns of clashing names, on the smallest given tables."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabquorum.llm import conversations, decontamination, exact, html, language, lexical, mixing, near, private, quality, queries, suffix, tokens, urls
from tabquorum.llm.columns import apart
from tabquorum.sources import materialize

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
COLUMNS = {
    "op1_url_filters": "page_id host path rule verdict", "op2_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op3_ngram_jaccard_join": "doc_id class_id n_links", "op4_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op5_quality_classifier": "doc_id expected_grade kept", "op6_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op7_language_id": "doc_id held_out lang_pred score", "op8_token_output": "doc_id start n_tokens ids_crc32",
    "op9_source_mixing": "doc_id size source_size target taken", "op10_html_extraction": "page_id text",
    "op11_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256", "op12_lexical_search": "item_id rank doc_id score",
    "op13_conversation_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


@pytest.mark.parametrize("name", COLUMNS)
def test_query_gives_its_rows(spark, sf_dir, docs, name):
    rows = queries.QUERIES[name](spark, sf_dir)
    assert set(COLUMNS[name].split()) <= set(rows.columns)
    found = rows.collect()
    if "doc_id" in rows.columns and name != "op12_lexical_search":
        assert sorted(r.doc_id for r in found) == sorted(r.doc_id for r in docs)
    if "page_id" in rows.columns:
        assert len(found) == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert found


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_is_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    rows = queries.QUERIES[name](spark, sf_dir)
    assert sorted(rows.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, rows.select(*columns).collect()))) == sorted(map(str, result.fetchall()))


def test_language_query_against_a_majority(spark, sf_dir, docs):
    held = [r for r in queries.op7_language_id(spark, sf_dir).collect() if r.held_out and r.lang_pred != "und"]
    lang = {r.doc_id: r.lang for r in docs}
    assert {r.doc_id for r in held} <= {r.doc_id for r in docs if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    right = sum(lang[r.doc_id] == r.lang_pred for r in held if lang[r.doc_id]) / sum(lang[r.doc_id] is not None for r in held)
    assert right > 0.95


# the pipeline, stage by stage against plain Python ---------------------------------------------

def jaccard_classes(rows):
    shingles = {}
    for r in rows:
        w = words(r.text)
        shingles[r.doc_id] = {tuple(w[i: i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    root = {d: d for d in shingles}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(shingles)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = shingles[a], shingles[b]
            if x and y and min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(x & y) >= 0.8 * len(x | y) - 1e-9:
                a_, b_ = find(a), find(b)
                root[max(a_, b_)] = min(a_, b_)
    return {d: find(d) for d in ids}


def contaminated(text, windows):
    w = words(text)
    hit = set()
    for k in {len(x) for x in windows}:
        for i in range(len(w) - k + 1):
            if tuple(w[i: i + k]) in windows:
                hit |= set(range(i, i + k))
    return bool(hit) and 20 * len(hit) >= len(w)


def test_pipeline_against_plain_python(spark, sf_dir, docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "mixing", "tokens"] and corpus_pipeline.ORACLE_SQL is None
    tables, current = {}, spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out, _ = materialize(stage(spark, current, sf_dir), name)
        tables[name] = (current.collect(), out.collect())
        assert name == "tokens" or out.columns == current.columns
        current = out

    # quality: weights summed one by one
    model = quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), queries.grades_of(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    weight = dict(zip(model.hashes.tolist(), model.weights.tolist(), strict=True))
    before, after = tables["quality"]
    kept = set()
    for r in before:
        _, found = quality.features(pa.array([r.text], pa.string()))
        score = sum(weight.get(h, 0.0) for h in set(found.tolist()))
        if 1 / (1 + np.exp(-(score - model.thresholds[1]))) >= 0.5:
            kept.add(r.doc_id)
    assert {r.doc_id for r in after} == kept and 0 < len(kept) < len(before)

    before, after = tables["near_duplicates"]
    classes = jaccard_classes(before)
    assert sorted(r.doc_id for r in after) == sorted({classes[r.doc_id] for r in before})

    before, after = tables["decontamination"]
    windows = set()
    for item in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = words(item.text)
        k = min(len(w), 13)
        windows |= {tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if w else set()
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if not contaminated(r.text, windows))

    before, after = tables["mixing"]
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in before}
    sources = sorted({r.source for r in before}, key=lambda s: (s is None, s))
    total = {s: sum(size[r.doc_id] for r in before if r.source == s) for s in sources}
    wanted, free, left = {}, dict(zip(sources, [(5, 2, 1)[i % 3] for i in range(len(sources))], strict=True)), sum(total.values())
    while free:
        level = left / sum(free.values())
        over = [s for s, w in free.items() if w * level > 3 * total[s]]
        if not over:
            wanted |= {s: w * level for s, w in free.items()}
            break
        for s in over:
            wanted[s] = 3 * total[s]
            left -= wanted[s]
            del free[s]
    for s in sources:
        taken = sum(size[r.doc_id] for r in after if r.source == s)
        assert abs(taken - wanted[s]) <= max(size[r.doc_id] for r in before if r.source == s)
    times = {d: sum(r.doc_id == d for r in after) for d in size}
    assert all(t <= 3 for t in times.values()) and all(times[d] == 1 for d, n in size.items() if n == 0)

    from tokenizers import Tokenizer
    encode = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER)).encode
    before, after = tables["tokens"]
    at, want = 0, []
    for r in sorted(before, key=lambda r: r.doc_id):
        ids = [*encode(r.text or "", add_special_tokens=False).ids, 2]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, after)) == sorted(want)


# columns of any name -----------------------------------------------------------------------------

OWN = ["_n", "_hash", "_words", "_copies", "_own_0_", "times", "copy", "hash", "words", "a.b", "a`b", "key", "sig", "size", "tails", "expected_grade",
       "hit_spans", "n_hit", "contaminated", "text_hash", "spans", "t_id", "id", "of", "lang_pred", "held_out", "bad", "slot", "rest", "term", "shard"]


@pytest.fixture(scope="module")
def clashing(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return rows.select("*", *[F.concat(F.lit(f"{i}:"), F.col("doc_id").cast("string")).alias(c) for i, c in enumerate(OWN)])


@pytest.mark.parametrize("stage", range(4))
def test_stages_leave_columns_alone(spark, sf_dir, clashing, stage):
    name, run = corpus_pipeline.STAGES[stage]
    plain = run(spark, clashing.select("doc_id", "text", "lang", "source", "n_chars"), sf_dir)
    out = run(spark, clashing, sf_dir)
    assert out.columns == clashing.columns
    rows = out.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r.doc_id for r in plain.collect()) and rows
    for r in rows:
        assert [r[5 + i] for i in range(len(OWN))] == [f"{i}:{r['doc_id']}" for i in range(len(OWN))]


def test_operators_do_not_look_at_other_columns(spark, sf_dir, clashing):
    plain = clashing.select("doc_id", "text", "lang", "source", "n_chars")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    odd_pages = pages.select("*", *[F.lit(1).alias(c) for c in OWN])
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    chats = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    counts = urls.word_counts(plain)
    for run, a, b in [
            (exact.dedup, clashing, plain), (near.near_classes, clashing, plain), (private.personal_data, clashing, plain),
            (lambda d: mixing.mix_sources(d), clashing, plain), (suffix.remove_repeats, clashing, plain),
            (lambda d: tokens.token_rows(d, public_tokenizers.path(queries.TOKENIZER)), clashing, plain),
            (lambda d: lexical.search(d, bench, 3), clashing, plain), (html.extract, odd_pages, pages),
            (lambda p: urls.judge(p, counts, queries.RULES), odd_pages, pages),
            (conversations.prefix_trie, chats.select("*", *[F.lit(1).alias(c) for c in OWN]), chats)]:
        assert sorted(map(str, run(a).collect())) == sorted(map(str, run(b).collect()))


def test_scanned_rows_keep_what_their_docstrings_say(spark, clashing, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own, back = apart(clashing, "text")
    assert back(decontamination.scan(own, bench)).columns == clashing.columns
    model = quality.Ordinal(np.zeros(0, np.uint64), np.zeros(0), np.array([-1.0, 0.0]))
    graded = quality.grade(clashing, model)
    assert set(graded.columns) == set(clashing.columns) and graded.schema["tails"].dataType.simpleString() == "array<double>"
    told = language.predict(clashing, language.train(clashing.where("lang IS NOT NULL").select("doc_id", "text", "lang")))
    assert set(clashing.columns) <= set(told.columns)


def test_digest_of_removed_text(spark, sf_dir, docs):
    first = next(r for r in queries.op11_suffix_dedup(spark, sf_dir).collect() if r.n_removed == 0 and r.n_bytes)
    text = next(r.text for r in docs if r.doc_id == first.doc_id)
    assert first.kept_sha256 == hashlib.sha256(text.encode()).hexdigest()
