"""The corpus pipeline: language, quality, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written
and read again as the next one's ``docs``.  All but the last return the columns
that they were given, whatever their names.  No stage has an exact SQL form, so
`ORACLE_SQL` is None and the tests compare `run` with brute force.

Null and empty texts, and texts without a letter, have no language and go in the
first stage; without a labelled row the second keeps everything.  Rows of one id and one
text are one document: all of them stay or go.  Of an id with several texts each row
is judged by its own.  Rows without an id are learnt from by no stage and linked with
nothing.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lociflow.llm import boosted, minhash, packing, phrases, ppm
from lociflow.llm.common import table, written

#: Passages of so many words that repeat are cut out.
PASSAGE_WORDS = 50
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus teaches; those without letters and those coded worse than raw bytes go."""
    return ppm.accepted(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by the labels, doesn't reject."""
    return boosted.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    return minhash.deduplicated(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand earlier in the corpus; a text that is nothing else is left empty."""
    return phrases.without_repeats(docs, PASSAGE_WORDS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin of each piece of each document."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language),
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_dedup),
    ("phrase_dedup", passage_dedup),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
