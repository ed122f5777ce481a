"""Clean and mix a corpus: five stages over the ``documents`` table, each one of the operators in ``tidemark.llm``.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over all rows the
stage before it kept; all but the last return the columns of ``docs``. ``run``
applies them in order and stores each result in the shared checkpoint folder,
so a lost executor repeats one stage's tasks and no more.

1. language: documents in which no language is found go (no letters, or no
   language with a probability of at least ``LANGUAGE_SCORE``).
2. near duplicates: one document of each class stays.
3. decontamination: documents that hold a benchmark item go.
4. mix: each document as often as its source's target asks for (0 to 3 times).
5. shards: ``shard`` and ``slot`` for every row.

Null texts have no language, so they leave in the first stage. Empty tables
pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, langid, mixing, near_dup, sharding
from tidemark.llm.common import table, written

LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; learned from the labelled documents that aren't held out."""
    model = langid.train(docs.filter(~langid.held_out()))
    found = langid.identify(docs, model, "__lang_pred", "__lang_score")
    return found.filter((found["__lang_pred"] != langid.UNKNOWN) & (found["__lang_score"] >= LANGUAGE_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest ``doc_id``."""
    return near_dup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the mix takes them."""
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot."""
    return sharding.shard(docs)


STAGES = [
    ("language", language),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mixture),
    ("shards", shards),
]

#: Hashed n-grams, min-hashes and random walks have no SQL form; tests compare ``run`` with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
