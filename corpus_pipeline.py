"""Corpus pipeline: from raw documents to token digests of a mixed, clean corpus.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of ``docs``.

1. ``toxicity``: documents that the string-kernel machine finds toxic go.
2. ``near_duplicates``: one document of each group of near copies stays.
3. ``secrets``: found secrets are replaced by their kind.
4. ``mix``: documents are taken as often as the mix of sources takes them.
5. ``tokens``: every document is encoded; its ids are counted and digested.

Defined cases: null and empty texts pass every stage as they are and have no
tokens, but the mix takes no document without words; an empty table stays empty;
columns beside the ones that a stage reads are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import toxicity as tox
from shelfwise.llm.bpe_codec import op6_byte_bpe
from shelfwise.llm.common import read_table, stage, unstage
from shelfwise.llm.jaccard_join import one_per_group
from shelfwise.llm.mixing import mix_documents
from shelfwise.llm.secret_ledger import redact_documents


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a toxicity score of 0.5 or more.  The machine learns
    from labelled documents outside the held-out fifth."""
    return tox.drop_toxic(docs, tox.train_on_open_rows(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of linked ones."""
    return one_per_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets; all documents stay, n_chars follows the text."""
    return redact_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources meet their targets."""
    return mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes."""
    return op6_byte_bpe(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mix", mix), ("tokens", tokens)]

#: Training, graph components, random rounding and byte-pair merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        before, docs = docs, stage(function(spark, docs, sf_dir), f"pipeline-{name}")
        unstage(before)     # the next corpus is written: nothing reads this one any more
    return STAGES[-1][1](spark, docs, sf_dir)

