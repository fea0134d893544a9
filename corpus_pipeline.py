"""The corpus pipeline: five stages over ``documents``, each calling one of the
operators of ``barloom.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows the stage
before it kept.  All but the last return the columns of ``documents``; the
last returns the token ids.  A stage's result is written as Parquet to the
shared checkpoint folder and read again, so a lost executor costs at most the
stage that was running.
"""

from __future__ import annotations

import os
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barloom.llm import crf_langid, line_chunks, pieces, positional_index, simhash_trie  # noqa: E402
from barloom.llm.common import joined_path, read_table  # noqa: E402
from barloom.session import ensure_checkpoint_dir  # noqa: E402


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go."""
    return crf_langid.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Multi-line chunks stay at their first occurrence only; a document that
    loses all its lines goes."""
    return line_chunks.remove_repeats(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash_trie.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return positional_index.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document that is left, with the digests of ids and
    decoded text."""
    return pieces.encode_documents(docs, outputs=("ids",))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", tokenise),
]

#: The stages that learn a model or call a tokenizer have no SQL; the tests
#: hold the whole run against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents`` and return the last one's rows."""
    folder = joined_path(ensure_checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = joined_path(folder, f"{i}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
