"""The corpus pipeline: documents to a mixed, tokenized training set.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over all rows that
the one before kept; all but the last return the columns of ``documents``. Its result
is to be written before the next one is called on what was written: when a stage
begins, the intermediate tables that earlier stages over the same folder stored are deleted, except those
that ``docs`` is still read from. Pipelines over different folders don't touch each other's.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wellspring.llm import mixing, pieces, quality, simhash, substring
from wellspring.llm._stage import drop_unread, recorded, store, table

_stored: dict[str, list[str]] = defaultdict(list)  # by the folder that a pipeline runs over


def _stage(run: Callable[[SparkSession, DataFrame, str], DataFrame]):
    @functools.wraps(run)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own = _stored[sf_dir]
        drop_unread(own, docs)
        with recorded(own):
            return run(spark, docs, sf_dir)
    return begun


@_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels``, rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


@_stage
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.keep_one_each(docs)


@_stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that occur elsewhere are cut out of the texts."""
    return substring.remove_substrings(docs)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their targets: a document appears once for each round that takes it."""
    return mixing.mixed_documents(docs)


@_stage
def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts are encoded with merge dropout, each round of a document with its own; ``n_tokens`` and ``ids`` replace the text."""
    return pieces.encode(docs, keep=[c for c in docs.columns if c != "text"], copies=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding", sentencepiece_encoding),
]

# The classifier's scores, fingerprints and segmentations are beyond SQL; tests/llm/test_pipeline.py
# holds every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "pipeline_" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
