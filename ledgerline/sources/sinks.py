"""Sinks: keyed upsert, full refresh, window overwrite, load metrics.

A keyed table is a folder of plain Parquet files in buckets by a hash of the key.
It grows by linear hashing: once the buckets hold more than ``BUCKET_BYTES`` on
average, the next bucket in turn is split in two, so an upsert reads and
rewrites the buckets that its updates touch and the few that it splits, whatever
the size of the table.  Rewritten buckets go to a folder of their own; the table
changes at once, when a file that names those folders is added to its
``directory``.  Every keyed load has a load order: which of two rows of a key
wins never depends on how rows are batched.
"""

from __future__ import annotations

import os
import uuid
from typing import Callable, NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ledgerline.session import scratch_path

#: Bytes that the buckets of a keyed table hold on average before it gets another one.
BUCKET_BYTES = 256 * 1024 * 1024
#: One row per bucket and upsert that rewrote it; the row of the latest upsert holds.
DIRECTORY = "upsert bigint, bucket int, folder string, bytes bigint"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: later (or iterative) use reads the written files instead
    of re-running the plan, and a lost executor does not re-run it either.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return False
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return True


def latest_per_key(updates: DataFrame, keys: Sequence[str], order_cols: Sequence[str], count: str | None = None) -> DataFrame:
    """One row per key: the one with the highest ``order_cols``, the load order; ``count`` names a column for its rows.

    An empty order says that all rows are of one load.  Rows of a key that tie
    are told apart by their content (maps as JSON), so the result does not
    depend on arrival.  Written as ``max_by(row, order)`` grouped by key: an
    aggregation with a map-side partial step, so a key holding a large share of
    the updates is reduced before the shuffle.
    """
    others = [c for c in updates.columns if c not in keys]
    types = {f.name: f.dataType for f in updates.schema.fields}
    content = [F.col(c) if _orderable(types[c]) else F.to_json(F.struct(c)) for c in others if c not in order_cols]
    rank = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate([*map(F.col, order_cols), *content, F.lit(0)])])
    best = updates.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in others]), rank).alias("_best"),
                                      *([F.count(F.lit(1)).alias(count)] if count else []))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in others], *([count] if count else [])).select(
        *updates.columns, *([count] if count else []))


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE`` as a set operation.

    Target rows whose key is updated are dropped (anti join) and the latest
    updates appended by name.  The latest updates are written once to the
    shared folder; the planner knows the size of those files and broadcasts
    or shuffles their keys accordingly.
    """
    dedup = materialize(latest_per_key(updates, keys, order_cols), "upsert_updates")
    kept = target.join(dedup.select(*keys), list(keys), "left_anti")
    return kept.unionByName(dedup.select(*target.columns))


def bucket_of(keys: Sequence[str], n: int) -> Column:
    """The bucket of a key among ``n``: the hash by the next power of two, or by the one before where that bucket is not there yet."""
    low = 1 << (n.bit_length() - 1)
    b = F.pmod(F.xxhash64(*keys), F.lit(2 * low))
    return F.when(b >= n, b - low).otherwise(b).cast("int")


def origin(bucket: int, n: int) -> int:
    """Which of the first ``n`` buckets the rows of ``bucket`` lay in."""
    while bucket >= n:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


def _bytes_by_bucket(spark: SparkSession, folder: str) -> dict[int, int]:
    """Sizes of the files in a folder (listed, not read) by bucket; -1 for files in none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    bucket = F.coalesce(F.regexp_extract("path", "/bucket=([0-9]+)/[^/]*$", 1).try_cast("int"), F.lit(-1))
    return {r.bucket: r.bytes for r in files.groupBy(bucket.alias("bucket")).agg(F.sum("length").alias("bytes")).collect()}


def _directory(spark: SparkSession, path: str) -> tuple[int, dict[int, tuple[str, int]]]:
    """Number of the latest upsert, and folder and bytes of every bucket (a row per ``BUCKET_BYTES`` of the table)."""
    rows = spark.read.schema(DIRECTORY).parquet(f"{path}/directory").groupBy("bucket").agg(
        F.max_by(F.struct("folder", "bytes"), "upsert").alias("at"), F.max("upsert").alias("upsert")).collect()
    return max((r.upsert for r in rows), default=0), {r.bucket: (r["at"].folder, r["at"].bytes) for r in rows}


def _bucket_rows(spark: SparkSession, path: str, buckets: dict[int, tuple[str, int]], schema: T.StructType | None = None) -> DataFrame:
    schema = schema or spark.read.parquet(f"{path}/columns").schema
    folders = [f"{path}/rows/{folder}/bucket={b}" for b, (folder, size) in sorted(buckets.items()) if size]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a keyed table as they are now; later upserts do not change this frame."""
    return _bucket_rows(spark, path, _directory(spark, path)[1])


def _switch(spark: SparkSession, path: str, rows: list[tuple[int, int, str, int]]) -> None:
    """Make rewritten buckets those of the table: one file, which is there or not."""
    spark.createDataFrame(rows, DIRECTORY).coalesce(1).write.mode("append").parquet(f"{path}/directory")


class LoadCounts(NamedTuple):
    """What a keyed load did: rows given, keys that are new, keys whose row was replaced, keys whose stored row was later."""
    rows_read: int
    inserted: int
    replaced: int
    outdated: int


def upsert_table(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str],
                 order_cols: Sequence[str], bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The table at ``path`` after :func:`load_table`."""
    load_table(spark, path, updates, keys, order_cols, bucket_bytes)
    return read_table(spark, path)


def load_table(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str],
               order_cols: Sequence[str], bucket_bytes: int = BUCKET_BYTES) -> LoadCounts:
    """S9 + S13: upsert ``updates`` into the keyed table at ``path``; the order columns are stored with the rows.

    Of an update and a stored row the later load wins, so the same rows in any
    number of calls, and a call that is repeated after a failure, give the same
    table.  A call that fails leaves the table as it was.  A table has one writer
    at a time.
    """
    new_path = scratch_path(spark, "upsert_updates")
    given = Observation("given")
    latest = latest_per_key(updates.observe(given, F.count(F.lit(1)).alias("rows")), keys, order_cols)
    latest.write.parquet(new_path)
    new = spark.read.schema(latest.schema).parquet(new_path)
    try:
        last, held = _directory(spark, path)
    except AnalysisException:  # there is no table yet
        new.limit(0).write.mode("overwrite").parquet(f"{path}/columns")
        last, held = 0, {}
    before = len(held)
    stored = sum(size for _, size in held.values()) + sum(_bytes_by_bucket(spark, new_path).values())
    after = max(before, 1, -(-stored // bucket_bytes))
    touched = {r.bucket for r in new.select(bucket_of(keys, after).alias("bucket")).distinct().collect()}  # numbers of buckets
    if before:
        sources = {origin(b, before) for b in [*touched, *range(before, after)]}
        rewritten = [b for b in range(after) if origin(b, before) in sources]
    else:
        sources, rewritten = set(), list(range(after))
    old = _bucket_rows(spark, path, {b: held[b] for b in sources})
    # Of rows that tie in everything the stored one wins: a repeated load replaces nothing.
    both = latest_per_key(old.withColumn("_stored", F.lit(1)).unionByName(new.withColumn("_stored", F.lit(0))), keys, [*order_cols], count="_rows")
    done = Observation("done")
    merged = both.observe(done, F.count_if(F.expr("_rows = 1 AND _stored = 0")).alias("inserted"),
                          F.count_if(F.expr("_rows = 2 AND _stored = 0")).alias("replaced"),
                          F.count_if(F.expr("_rows = 2 AND _stored = 1")).alias("outdated"))
    folder = uuid.uuid4().hex
    (merged.drop("_stored", "_rows").withColumn("bucket", bucket_of(keys, after)).hint("rebalance", "bucket")
     .write.partitionBy("bucket").parquet(f"{path}/rows/{folder}"))
    sizes = _bytes_by_bucket(spark, f"{path}/rows/{folder}")
    _switch(spark, path, [(last + 1, b, folder, sizes.get(b, 0)) for b in rewritten])
    counts = done.get
    return LoadCounts(int(given.get["rows"]), *(int(counts[c]) for c in ("inserted", "replaced", "outdated")))


def vacuum_table(spark: SparkSession, path: str) -> int:
    """Remove the bucket folders of a keyed table that later upserts, or failed ones, have left; returns how many.

    Frames that were read before those upserts can no longer be used.
    """
    from pyarrow import fs
    held = {f"{folder}/bucket={b}" for b, (folder, size) in _directory(spark, path)[1].items() if size}
    store, root = fs.FileSystem.from_uri(f"{path}/rows")
    gone = 0
    for folder in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        for bucket in store.get_file_info(fs.FileSelector(folder.path)) if folder.type == fs.FileType.Directory else ():
            if bucket.type == fs.FileType.Directory and f"{folder.base_name}/{bucket.base_name}" not in held:
                store.delete_dir(bucket.path)
                gone += 1
    return gone


def full_refresh(df: DataFrame, path: str) -> DataFrame:
    """``DROP TABLE`` + ``CREATE`` + ``INSERT``: the table at ``path`` is replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def overwrite_windows(df: DataFrame, path: str, partition_cols: Sequence[str],
                      windows: Sequence[Sequence[str]], source: DataFrame | None = None) -> None:
    """Replace the partitions ``windows`` (values of ``partition_cols``) by the rows of ``df``.

    Re-runs are idempotent; a reloaded window without rows is cleared, and rows
    of windows that are not listed are refused.  Which windows have rows is read
    from ``source``, if given: a frame with the same windows that is cheaper to scan.
    """
    given = {tuple(r) for r in (df if source is None else source).select(*partition_cols).distinct().collect()}  # one row per window
    if extra := given - {tuple(w) for w in windows}:
        raise ValueError(f"rows of windows that are not reloaded: {sorted(extra)}")
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))
    for window in windows:
        if tuple(window) not in given:
            folder = os.path.join(path, *[f"{c}={v}" for c, v in zip(partition_cols, window)])
            df.drop(*partition_cols).limit(0).write.mode("overwrite").parquet(folder)


def write_tagged(df: DataFrame, path: str, tag: str = "tag") -> Callable[[str], DataFrame]:
    """Write rows of several outputs in one pass, a partition per tag; returns a reader of one tag's rows."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(tag).parquet(path)
    return lambda value: df.sparkSession.read.schema(df.schema).parquet(path).where(F.col(tag) == value).drop(tag)


def write_with_metrics(frames: dict[str, DataFrame], root: str) -> DataFrame:
    """Write each table once and report its row count, observed during the write.

    ``observe`` counts the rows as they stream to the sink, so no second
    pass over the data is needed.  Returns (table_name, num_rows).
    """
    spark = next(iter(frames.values())).sparkSession
    rows = []
    for name, df in frames.items():
        obs = Observation(f"load_{name}")
        df.observe(obs, F.count(F.lit(1)).alias("num_rows")).write.mode("overwrite").parquet(
            os.path.join(root, name))
        rows.append((name, int(obs.get["num_rows"])))
    return spark.createDataFrame(rows, "table_name string, num_rows bigint")
