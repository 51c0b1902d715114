"""The training-data pipeline: five stages over documents, each written and read again.

Every stage but the last returns the columns it was given.  Rows with null
texts pass all stages (they are neither toxic nor duplicates, hold no benchmark
words and no secrets); an empty table stays empty; extra columns are kept.  Of
rows that are copies one stays: the one with the smallest id, among rows without
id the one with the smallest hash of its text; repeated rows count as one, unless
they have no words.  Ties are broken by id and text, so a rerun gives the same
rows.  Very long texts are read whole, in time and memory linear in them.  Where
no text is labelled toxic or none clean, no document goes as toxic, with a
warning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontaminate, minhash, mixing, secrets, toxicity
from ledgerline.llm.common import stage, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the random field does not score as toxic; it learns from the labels of the learning folds."""
    return toxicity.drop_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, similarity 0.8 or more."""
    return minhash.drop_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that hold a benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secret values masked."""
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to equal shares of all sources, in a global random order."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic), ("near_duplicates", deduplicated), ("decontamination", decontaminated), ("secrets", without_secrets), ("mixing", mixed)]

#: The toxicity stage fits a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
