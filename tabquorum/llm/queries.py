"""One query per operator over the given tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontamination, exact, html, language, lexical, mixing, near, private, quality, suffix, tokens, urls

TOKENIZER = "word_bpe_49k.json"
MIX_WEIGHTS = (5, 2, 1)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark, sf_dir):
    counts = urls.word_counts(_table(spark, sf_dir, "documents"))
    return urls.judge(_table(spark, sf_dir, "pages"), counts, RULES)


def op2_exact_dedup(spark, sf_dir):
    return exact.dedup(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark, sf_dir):
    return near.near_classes(_table(spark, sf_dir, "documents"))


def op4_pii(spark, sf_dir):
    return private.personal_data(_table(spark, sf_dir, "documents"))


def grades_of(labels: DataFrame) -> DataFrame:
    """Graded ratings from the two labels: 0 toxic, 1 of low quality, 2 good."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1)
                         .when((F.col("quality") == 1) & (F.col("toxic") == 0), 2).alias("grade"))


def graded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with expected grade, tail probabilities and whether the text is kept."""
    model = quality.train(_table(spark, sf_dir, "documents"), grades_of(_table(spark, sf_dir, "labels")))
    return quality.grade(docs, model)


KEEP = "tails[1] >= 0.5"


def op5_quality_classifier(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return graded(spark, docs, sf_dir).select(
        "doc_id", "expected_grade", F.element_at("tails", 1).alias("p_not_toxic"),
        F.element_at("tails", 2).alias("p_good"), F.expr(KEEP).alias("kept"))


def op6_decontamination(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = decontamination.judged(decontamination.scan(docs, _table(spark, sf_dir, "benchmark")))
    return rows.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").withColumn(
        "held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    model = language.train(docs.where(~F.coalesce("held_out", F.lit(False))))
    rows = docs.select("doc_id", "text", F.coalesce("held_out", F.lit(False)).alias("held_out"))
    return language.predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op8_token_output(spark, sf_dir):
    return tokens.token_rows(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op9_source_mixing(spark, sf_dir):
    rows = mixing.mix_sources(_table(spark, sf_dir, "documents"), MIX_WEIGHTS)
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op10_html_extraction(spark, sf_dir):
    return html.extract(_table(spark, sf_dir, "pages"))


def op11_suffix_dedup(spark, sf_dir):
    rows = suffix.remove_repeats(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_lexical_search(spark, sf_dir):
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_conversation_trie(spark, sf_dir):
    return conversations.prefix_trie(_table(spark, sf_dir, "conversations"))


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_url_filters, op2_exact_dedup, op3_ngram_jaccard_join, op4_pii, op5_quality_classifier, op6_decontamination,
    op7_language_id, op8_token_output, op9_source_mixing, op10_html_extraction,
    op11_suffix_dedup, op12_lexical_search, op13_conversation_trie, pipeline)}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLES = {
    "op2_exact_dedup": r"""
WITH t AS (SELECT doc_id, coalesce(length(text), 0) AS n,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept, text_sha256
FROM t""",
    "op6_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, k, w[i:i + k - 1] AS win FROM (
         SELECT item, w, least(len(w), 13) AS k, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
         FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, w[i:i + k - 1] AS win FROM (
         SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
h AS (SELECT doc_id, k, i, item FROM dw JOIN bw USING (k, win)),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (
        SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS pos FROM (SELECT DISTINCT doc_id, k, i FROM h)) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN s USING (doc_id)""",
    "op12_lexical_search": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM d WHERE len(w) > 0),
post AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
item AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * big_n + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
           FROM post, s WHERE t IN (SELECT t FROM item) GROUP BY t, big_n),
m AS (SELECT r, doc_id, 100 - 50 + (50 * len(w) * big_n) // big_l AS m FROM d, s WHERE len(w) > 0),
score AS (SELECT item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
          FROM item JOIN weight USING (t) JOIN post USING (t) JOIN m USING (r) GROUP BY item_id, doc_id, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0) WHERE rank <= 50""",
    "op13_conversation_trie": """
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
           coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, c - c % 100 AS base, xor(list_reduce(list_concat([4294967295::BIGINT],
              list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
              lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
                lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)), 4294967295::BIGINT) % 6 AS h
        FROM (SELECT DISTINCT c FROM t)),
rebuilt AS (SELECT ids.c, 0 AS part, i, role, text FROM ids JOIN t ON t.c = ids.base AND i <= h
            UNION ALL SELECT c, 1, i, role, text FROM ids JOIN t USING (c) WHERE i > h),
turns AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, i) AS i, role, text FROM rebuilt),
p AS (SELECT c, i AS depth, list({'role': role, 'text': text}) OVER (PARTITION BY c ORDER BY i) AS path, length(text) AS size FROM turns
      UNION ALL SELECT c, 0, [], 0 FROM ids),
k AS (SELECT c, depth, md5(CAST(to_json(path) AS VARCHAR)) AS key, size, depth = max(depth) OVER (PARTITION BY c) AS last FROM p),
own AS (SELECT key, depth, min(c) AS conv_id, count(*) AS n, (count(*) - 1) * max(size) AS saved,
               string_agg(CASE WHEN last THEN CAST(c AS VARCHAR) END, ',' ORDER BY c) AS ends FROM k GROUP BY key, depth),
edge AS (SELECT DISTINCT b.key, a.key AS up FROM k a JOIN k b ON a.c = b.c AND b.depth = a.depth + 1),
below AS (SELECT DISTINCT a.key, b.key AS node FROM k a JOIN k b ON a.c = b.c AND b.depth >= a.depth),
kids AS (SELECT up AS key, count(*) AS n_children FROM edge GROUP BY up),
sums AS (SELECT below.key, sum(own.saved) AS saved, count(*) FILTER (WHERE kids.key IS NULL) AS leaves
         FROM below JOIN own ON own.key = below.node LEFT JOIN kids ON kids.key = below.node GROUP BY below.key)
SELECT own.conv_id, CAST(own.depth AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, own.n AS n_convs,
       coalesce(n_children, 0) AS n_children, leaves AS n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(own.ends, '')) AS ends_sha256
FROM own JOIN sums USING (key) LEFT JOIN kids USING (key) LEFT JOIN edge USING (key) LEFT JOIN own parent ON parent.key = edge.up""",
}
