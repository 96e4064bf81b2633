"""Corpus pipeline over documents: quality rules, near-duplicates, repeated passages, personal data, packing.

STAGES are (name, function) pairs. Each function takes (spark, docs, sf_dir) and works on all rows that the one before
kept; all but the last return the columns of documents. A stage's result is written as Parquet and read again as the
next one's docs, so docs is always a plain scan of written files.
"""

from __future__ import annotations

from loomtext.llm import packing, pii, quality, simhash, suffixes
from loomtext.llm.common import discard, materialize


def quality_rules(spark, docs, sf_dir):
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates stays, the one of the smallest id."""
    return simhash.drop_near_duplicates(docs)


def repeated_passages(spark, docs, sf_dir):
    """Passages of 100 bytes or more that stand earlier in the corpus are cut from the texts."""
    return suffixes.drop_repeats(docs, written=True)


def personal_data(spark, docs, sf_dir):
    """Personal data is replaced by its kind."""
    return pii.redact(docs)


def best_fit_packing(spark, docs, sf_dir):
    """Pieces of documents with their places in sequences of 4096 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: Connected components, suffix order and bootstrapping are not expressible in SQL: the tests use brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
