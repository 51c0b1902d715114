"""Access to the input tables of one data directory."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


class Tables:
    """Lazy parquet readers; one DataFrame per table so identical sub-plans can be reused.

    Reads never select columns up front: every consumer projects what it needs
    and Catalyst pushes that projection (and any filter) into the parquet scan.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return os.path.join(self.root, f"{name}.parquet")

    def state(self, names: tuple[str, ...]) -> tuple:
        """Number, bytes, newest time and names of the files of the named tables (listed, not read)."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(
            [self.path(n) for n in names]).select("path", "modificationTime", "length")
        return tuple(files.agg(F.count("path"), F.sum("length"), F.max("modificationTime"),
                               F.bit_xor(F.xxhash64("path", "modificationTime", "length"))).first())

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(self.path(name))
        return self._frames[name]
