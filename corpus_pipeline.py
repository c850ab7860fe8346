"""A training corpus from `documents`: five stages, each on all that the one before kept.

toxicity drops documents predicted toxic, exact_dedup and near_dedup leave one document of each group
of copies, mixing draws a sample with the target shares of source, language and topic, pieces encodes
what is left. Every stage's result is written as Parquet and read back as the next one's documents,
so a lost executor costs tasks of one stage only. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from periodica.llm import exact_dedup, mixing, near_dedup, tokens
from periodica.llm import toxicity as toxic
from periodica.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; learned from the labels of the corpus's own documents."""
    model = toxic.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxic.clean_rows(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the longest."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a resemblance of 0.8 in five-word shingles."""
    return near_dedup.representatives(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of four fifths of the tokens, nearest to the production mix without repeats."""
    return mixing.sampled(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, n_pieces, pieces, lossless."""
    return tokens.encoded(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mix),
    ("pieces", pieces),
]

# a fitted classifier, sketches and keyed draws are beyond SQL; tests hold each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
