"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, embeddings, filteraudit, language, minhash, mixing, negatives, pieces, quality, secrets, suffixes, toxicity, warc
from .common import table


def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, over=85, under=100)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(table(spark, sf_dir, "embeddings"), "id % 50 = 0", negatives.MOVED_LABEL)


def op12_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path  # where the vocabulary files of the registered query lie
    return pieces.report(table(spark, sf_dir, "documents"), path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_suffixes, op2_language, op3_warc, op4_toxicity, op5_quality, op6_embeddings, op7_secrets, op8_decontaminate, op9_minhash, op10_mixing,
        op11_negatives, op12_filters, op13_pieces)}

ORACLE: dict[str, str] = {"op6_embeddings": embeddings.ORACLE, "op8_decontaminate": decontaminate.ORACLE, "op9_minhash": minhash.ORACLE, "op10_mixing": mixing.ORACLE,
                          "op11_negatives": negatives.ORACLE, "op12_filters": filteraudit.ORACLE}
