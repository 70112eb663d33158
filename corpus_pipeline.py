"""From raw documents to packed token ids, in five stages.

Each stage reads what its predecessor wrote, whole, and hands on the columns of documents;
the last one's rows are packed sequences.  Mixing hands on an order: documents are dealt
to files in mix order and sorted inside them, and packing reads files in order.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import cloudpickle  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402

import caseflow  # noqa: E402
from caseflow.llm import common as C, decontamination, mixing, near_dup, packing, toxicity  # noqa: E402

# Python workers get the package with the function, so executors need no install.
cloudpickle.register_pickle_by_value(caseflow)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; models learn from the stage's own labelled documents."""
    return toxicity.drop_toxic(docs, C.table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8 or more."""
    return near_dup.drop_near_duplicates(docs, k=5, num=80, den=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontamination.decontaminate(docs, C.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out so that any stretch has the sources at their target weights."""
    return mixing.in_mix_order(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("packing", pack_tokens),
]

#: No SQL twin: language models, token ids and packing are beyond SQL; tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = C.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
