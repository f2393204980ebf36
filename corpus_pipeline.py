"""A training-data pipeline of five stages, each by one operator of ``tabquorum.llm``.

Stages take (spark, docs, sf_dir) and return a DataFrame, which is written and read again before
the next one. All but the last return the columns of ``docs``, whatever these are called. Every
stage takes whole texts of any length, and an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers

from tabquorum.llm import decontamination, mixing, near, queries, tokens
from tabquorum.llm.columns import apart
from tabquorum.sources.shared import materialize


def good_documents(spark, docs, sf_dir):
    """Documents whose grade is the highest with probability one half or more.

    Rows are judged one by one by their text (null is empty); rows with equal texts stay or go
    together; doc_id is not looked at.
    """
    own, back = apart(docs, "text")
    return back(queries.graded(spark, own, sf_dir).where(queries.KEEP))


def without_near_copies(spark, docs, sf_dir):
    """One document of each near-duplicate class, that with the smallest doc_id.

    Rows without words or without doc_id stay; of rows equal in doc_id and text one stays.
    """
    return near.drop_near_duplicates(docs)


def without_benchmark(spark, docs, sf_dir):
    """Documents that are not contaminated by the benchmark.

    Rows are judged one by one by their text; null and empty texts stay, repeated rows alike.
    """
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark, docs, sf_dir):
    """Each document as often as the mix of sources takes it; documents without words stay once.

    A null source is a source of its own; rows equal in doc_id, source and size are taken alike.
    """
    return mixing.mixed_rows(docs, queries.MIX_WEIGHTS)


def tokenized(spark, docs, sf_dir):
    """Documents of the token file, in order of doc_id: doc_id, start, n_tokens, ids_crc32.

    A null doc_id comes first, rows with one doc_id in the order of their texts; a null or empty text
    is the end id alone.
    """
    return tokens.token_rows(docs, public_tokenizers.path(queries.TOKENIZER))


STAGES = [("quality", good_documents), ("near_duplicates", without_near_copies),
          ("decontamination", without_benchmark), ("mixing", mixed), ("tokens", tokenized)]

# Sampling hashes and a trained model have no SQL form; tests/llm/test_pipeline.py holds the stages
# against plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


__all__ = ["ORACLE_SQL", "STAGES", "run"]
