"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.session import checkpoint_root, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's own switch: shuffle files go when the execution that made them has ended, not when the driver next collects garbage.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str, free_shuffles: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage and keeps what was computed when an executor is lost.  With
    ``free_shuffles`` the shuffle files of ``df`` are removed once it is written;
    a frame below it that is run again shuffles again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, str(free_shuffles or before == "true").lower())
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns as one struct, so that helper columns cannot clash with theirs; ``select(f"{name}.*")`` unpacks."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(name)


def same_key(a: Column, b: Column) -> Column:
    """``a = b`` for a join with an aggregate over ``b`` where a value may hold a large share of the rows.

    The second key makes Spark shuffle both sides for this join: the partitions
    of an aggregate that were used as they are could not be split by AQE.
    """
    return (a == b) & (F.xxhash64(a) == F.xxhash64(b))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_fold(column: str, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds`` (null ids: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


__all__ = ["checkpoint_root", "crc_fold", "packed", "same_key", "scratch_path", "shuffle_partitions", "stage", "table"]
