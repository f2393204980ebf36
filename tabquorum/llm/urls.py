"""URL filter: allow and block rules, and naive Bayes over segmented host names.

Concatenated names in hosts are split into words by a unigram Viterbi search over a table of word
counts; a multinomial naive Bayes model over the words of host and path judges the urls that no
rule fits. It learns from hosts named by seed words, which are never features themselves: what
speaks against a host are the other words that such hosts share.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabquorum.sources.shared import materialize, release

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONGEST_WORD, LEAST_WORD = 20, 2
CHUNK = 256               # letters of a name whose words are looked up together
BUCKETS = 1 << 18
# Words that name a host as an example to block when its name, once segmented, has one of them.
SEED_WORDS = ["spam", "pills", "casino", "viagra", "porn", "adult", "xxx", "poker", "bets", "payday", "jackpot", "escort", "malware", "phishing"]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as a struct (rule, verdict), or null.

    A rule (verdict, host, path) fits its host and all subdomains if the path starts with its
    path; of rules of one length a blocking one wins. ``rules`` is a short list.
    """
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, prefix in reversed(ranked):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the lower-case ASCII words of all texts, up to twenty letters."""
    words = docs.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word"))
    return words.where(F.length("word").between(LEAST_WORD, LONGEST_WORD)).groupBy("word").agg(F.count("*").alias("n"))


def best_split(name: str, starts: Sequence[int], words: Sequence[str], costs: Sequence[float], unknown: float) -> list[str]:
    """Viterbi: cheapest split of ``name`` into known words and unknown runs.

    An unknown run of any length costs ``unknown`` and ln 10 for each letter; ties go to the earlier,
    longer piece. Time grows with the letters and the known words found in them.
    """
    known: dict[int, list[tuple[int, float]]] = {}
    for s, w, c in zip(starts, words, costs, strict=True):
        known.setdefault(s, []).append((s + len(w), c))
    n, letter = len(name), math.log(10)
    best, back = [0.0] + [math.inf] * n, [0] * (n + 1)
    run, since = math.inf, 0                      # the cheapest unknown run that ends here, and where it began
    for s in range(n):
        if best[s] + unknown < run - 1e-12:
            run, since = best[s] + unknown, s
        run += letter
        for e, c in known.get(s, ()):
            if best[s] + c < best[e] - 1e-12:
                best[e], back[e] = best[s] + c, s
        if run < best[s + 1] - 1e-12:
            best[s + 1], back[s + 1] = run, since
    out, e = [], n
    while e:
        out.append(name[back[e]: e])
        e = back[e]
    return out[::-1]


def segment_names(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) of each distinct name of lower-case letters, by the word counts given.

    Only substrings of names are looked up, by a join; what one name gathers is bounded by its
    length times the longest word.
    """
    total = counts.agg(F.sum("n")).first()[0] or 1
    # a name is cut into chunks that overlap by a word, so that no row of a piece carries a long name
    chunks = names.where(F.length("name") >= LEAST_WORD).select(
        F.xxhash64("name").alias("id"), "name", F.explode(F.expr(f"sequence(0, length(name) - 1, {CHUNK})")).alias("at")).select(
        "id", "at", F.expr(f"substring(name, at + 1, {CHUNK + LONGEST_WORD - 1})").alias("chunk"))
    starts = chunks.where(F.length("chunk") >= LEAST_WORD).select(
        "id", "at", "chunk", F.explode(F.expr(f"sequence(1, least({CHUNK}, length(chunk) - {LEAST_WORD - 1}))")).alias("s"))
    pieces = starts.select("id", (F.col("at") + F.col("s") - 1).alias("start"), F.explode(F.expr(
        f"transform(sequence({LEAST_WORD}, least({LONGEST_WORD}, length(chunk) - s + 1)), k -> substring(chunk, s, k))")).alias("word"))
    found = pieces.join(counts, "word").groupBy("id").agg(
        F.collect_list(F.struct("start", "word", F.log(F.lit(float(total)) / F.col("n")).alias("cost"))).alias("hits"))
    unknown = math.log(total) + math.log(10)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, hits in zip(batch["name"], batch["hits"], strict=True):
                hits = [] if hits is None else sorted(hits, key=lambda h: (h["start"], -len(h["word"])))
                rows.append(best_split(name, [h["start"] for h in hits], [h["word"] for h in hits], [h["cost"] for h in hits], unknown))
            yield pd.DataFrame({"name": batch["name"], "words": rows})

    return names.join(found, F.xxhash64("name") == found["id"], "left").select("name", "hits").mapInPandas(split, "name string, words array<string>")


HOT = 1000       # a host with more than one row in HOT is looked up through a broadcast of at most HOT hosts


def _with_words(rows: DataFrame, named: DataFrame) -> DataFrame:
    """``rows`` with the ``host_words`` of their host; ``named`` has host, n (rows) and host_words."""
    total = named.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * HOT > total
    common = named.where(often).select("host", F.col("host_words").alias("common"))
    rest = named.where(~often).select(F.col("host").alias("rest"), F.xxhash64("host").alias("slot"), "host_words")
    settled = F.col("common").isNotNull() | (F.col("host") == "")
    rows = rows.join(F.broadcast(common), "host", "left").withColumn("rest", F.when(~settled, F.col("host"))).withColumn(
        "slot", F.when(settled, F.xxhash64(F.monotonically_increasing_id())).otherwise(F.xxhash64("host")))
    none = F.expr("CAST(array() AS array<string>)")
    return rows.join(rest, ["rest", "slot"], "left").withColumn("host_words", F.coalesce("common", "host_words", none)).drop("rest", "slot", "common")


def _buckets(words: Column, kind: str) -> Column:
    return F.transform(words, lambda w: F.pmod(F.xxhash64(F.concat(F.lit(f"{kind}:"), w)), F.lit(BUCKETS)).cast("int"))


def learned_odds(examples: DataFrame) -> tuple[np.ndarray, float]:
    """Log odds of each token bucket and of the two classes, from rows (host, bad, buckets).

    A token counts once a host, so a host with very many urls says no more than another.
    """
    tokens = examples.select("host", "bad", F.explode("buckets").alias("b")).distinct()
    mass = np.zeros((2, BUCKETS))
    for r in tokens.groupBy("bad", "b").count().toLocalIterator():     # at most 2 * BUCKETS rows
        mass[int(r.bad), r.b] = r["count"]
    hosts = {r.bad: r["count"] for r in examples.select("host", "bad").distinct().groupBy("bad").count().collect()}
    seen = mass.sum(axis=0) > 0
    mass += seen                                                       # one more for every token seen; unseen ones say nothing
    odds = np.zeros(BUCKETS)
    odds[seen] = np.log(mass[1, seen] / max(mass[1].sum(), 1)) - np.log(mass[0, seen] / max(mass[0].sum(), 1))
    return odds, math.log((hosts.get(True, 0) + 1) / (hosts.get(False, 0) + 1))


def judge(pages: DataFrame, counts: DataFrame, rules: Sequence[tuple[str, str, str]],
          seeds: Sequence[str] = SEED_WORDS) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block), host_words, example and log_odds of every url.

    ``pages`` has page_id and url, ``counts`` the table of ``word_counts``. A rule's verdict
    stands. Else a url whose segmented host has a seed word is blocked; it is an example to block, and
    urls without one that no rule blocks are examples to allow. The others are judged by the sign of
    naive Bayes' log odds over the words of host and path (block above 0, allow at 0 and for urls
    without tokens). Seed words are left out of the tokens, so the model only learns which other
    words go with them. Tokens are counted in 2**18 hash buckets, so the model has one size for any
    input. Null urls and urls without ``://`` have an empty host and path; hosts and paths of any
    length are taken whole; rows are judged one by one, repeated rows alike; other columns are not
    looked at; no pages, no rows.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hosts = rows.where("host <> ''").groupBy("host").agg(F.count("*").alias("n"))
    hosts, hosts_at = materialize(hosts, "hosts")
    counts, counts_at = materialize(counts, "counts")
    parts = hosts.select("host", F.posexplode(F.filter(F.split("host", "[^a-z]+"), lambda x: x != "")).alias("i", "name"))
    split, split_at = materialize(segment_names(parts.select("name").distinct(), counts), "names")
    named = parts.join(split, "name").groupBy("host").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("i", "words"))), lambda x: x["words"])).alias("host_words"))
    named, named_at = materialize(hosts.join(named, "host"), "named")
    path_words = F.filter(F.split(F.regexp_replace(F.translate("path", UPPER, LOWER), "[0-9]+", "#"), "[^a-z#]+"), lambda x: x != "")
    marks = F.array(*[F.lit(s) for s in seeds]) if seeds else F.expr("CAST(array() AS array<string>)")
    kept = F.filter("host_words", lambda w: ~F.array_contains(marks, w))
    tokens = _with_words(rows, named).select(
        "page_id", "host", "path", "host_words", F.arrays_overlap("host_words", marks).alias("bad"),
        rule_of(F.col("host"), F.col("path"), rules).alias("ruled"),
        F.concat(_buckets(kept, "h"), _buckets(path_words, "p")).alias("buckets"))
    tokens, tokens_at = materialize(tokens.withColumn("bad", F.coalesce("bad", F.lit(False))), "urls")
    examples = tokens.where((F.col("host") != "") & (F.col("bad") | F.coalesce(F.col("ruled.verdict") != "block", F.lit(True))))
    odds, prior = learned_odds(examples)
    for path in (hosts_at, counts_at, split_at, named_at):
        release(pages.sparkSession, path)
    shared = pages.sparkSession.sparkContext.broadcast(odds)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            sizes = np.diff(np.asarray(lists.offsets))
            values = shared.value[np.asarray(lists.flatten(), dtype=np.int64)]
            sums = np.zeros(len(sizes))
            sums[sizes > 0] = prior + np.add.reduceat(values, (np.cumsum(sizes) - sizes)[sizes > 0]) if len(values) else 0.0
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in batch.schema.names if c != "buckets"], pa.array(sums)],
                                             names=[*[c for c in batch.schema.names if c != "buckets"], "log_odds"])

    kind = dict(pages.dtypes)["page_id"]
    told = tokens.select("page_id", "host", "path", "host_words", "bad", F.col("ruled.rule").alias("rule"), F.col("ruled.verdict").alias("said"),
                         "buckets").mapInArrow(scored, f"page_id {kind}, host string, path string, host_words array<string>, bad boolean, "
                                                       "rule string, said string, log_odds double")
    return told.select("page_id", "host", "path", "rule", F.coalesce(
        "said", F.when(F.col("bad") | (F.col("log_odds") > 0), "block").otherwise("allow")).alias("verdict"),
        "host_words", F.col("bad").alias("example"), "log_odds")
