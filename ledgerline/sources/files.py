"""Typed readers for landed feed files.

Schemas are always declared (no inference).  The workbook feed is read from
its landed CSV export (workbook decoding is single-machine and not built); a
line break inside a quoted CSV field is not supported, since files are split at
line breaks, and makes the read fail.  JSON may be one record a line or one
array a file; arrays are split, too (``ledgerline.sources.jsonarray``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.sources import jsonarray


def _upper_schema(schema: T.StructType, renames: dict[str, str] | None = None) -> T.StructType:
    renames = renames or {}
    return T.StructType([T.StructField(renames.get(f.name, f.name.upper()), f.dataType, True)
                         for f in schema.fields])


def _lower_names(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Source header names to the declared lower-case names."""
    renames = renames or {}
    for c in df.columns:
        df = df.withColumnRenamed(c, renames.get(c, c.lower()))
    return df


#: What orders the loads of a keyed table: load date and window, then the file's time and name, then the place in it.
LOAD_ORDER = ("dt", "window_no", "load_window", "loaded_at", "load_file", "load_block", "load_row")
WINDOW = ("dt", "load_window")
#: Quotes inside a field are doubled, as spreadsheet exports and other readers have it.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "multiLine": False}


def with_file_order(df: DataFrame) -> DataFrame:
    """The time, name and block of the file that each row was read from."""
    return df.select("*", F.col("_metadata.file_modification_time").alias("loaded_at"),
                     F.col("_metadata.file_path").alias("load_file"), F.col("_metadata.file_block_start").alias("load_block"))


def with_row_order(df: DataFrame) -> DataFrame:
    """The place of each row in its block (rows of a block are read by one task, in order)."""
    return df.withColumn("load_row", F.monotonically_increasing_id())


def with_window_number(df: DataFrame) -> DataFrame:
    """``window_no``, the number at the end of the window's name: ``window10`` comes after ``window2``.

    Names without a number come before all others, by name.
    """
    return df.withColumn("window_no", F.regexp_extract("load_window", r"([0-9]+)\D*$", 1).try_cast("decimal(38,0)"))


def in_windows(windows: Sequence[tuple[str, str]]) -> Column:
    """Condition on the partition columns: (dt, load_window) is one of ``windows``."""
    found = F.lit(False)
    for dt, window in windows:
        found = found | ((F.col("dt") == dt) & (F.col("load_window") == window))
    return found


def _landed(reader, schema: T.StructType, root: str, fmt: str, windows: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """The windows under ``root`` (None: all) with ``dt``, ``load_window`` and the rest of the load order."""
    full = T.StructType(list(schema.fields) + [T.StructField(c, T.StringType()) for c in WINDOW])
    df = getattr(reader.schema(full).option("mode", "FAILFAST"), fmt)(root)
    df = df if windows is None else df.where(in_windows(windows))
    return with_row_order(with_window_number(with_file_order(df)))


def read_landed_feed1(spark: SparkSession, root: str, windows: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """S1 + S14: feed-1 exports of all or some windows, with their load order."""
    src = _upper_schema(schemas.RAW_DATASET_1, {"order_time_pst": schemas.FEED1_TIME_HEADER})
    # The partition columns are not in the files: header checks apply to the declared file columns only.
    df = _landed(spark.read.options(**CSV_OPTIONS).option("enforceSchema", True), src, root, "csv", windows)
    return _lower_names(df, {schemas.FEED1_TIME_HEADER: "order_time_pst"})


def read_landed_feed2(spark: SparkSession, root: str, array_records: bool = False,
                      windows: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """S3 + S14: feed-2 JSON of all or some windows (records in lines or one array a file), with their load order."""
    src = _upper_schema(schemas.RAW_DATASET_2)
    if not array_records:
        return _lower_names(_landed(spark.read, src, root, "json", windows))
    folders = [root] if windows is None else [f"{root}/dt={dt}/load_window={window}" for dt, window in windows]
    rows = jsonarray.read(spark, folders, src)
    for c in WINDOW:
        rows = rows.withColumn(c, F.regexp_extract("load_file", f"/{c}=([^/]+)/", 1))
    return with_window_number(_lower_names(rows))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The id mapping from its headed CSV export."""
    df = spark.read.schema(_upper_schema(schemas.RAW_MAPPING)).options(**CSV_OPTIONS).option("mode", "FAILFAST").csv(path)
    return _lower_names(df)


def write_mapping(df: DataFrame, path: str) -> None:
    df.select(*[F.col(c).alias(c.upper()) for c in df.columns]).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_feed1_csv(spark: SparkSession, path: str) -> DataFrame:
    """The order feed export with header ``ORDER_TIME  (PST)`` (two spaces)."""
    src = _upper_schema(schemas.RAW_DATASET_1, {"order_time_pst": schemas.FEED1_TIME_HEADER})
    df = spark.read.schema(src).options(**CSV_OPTIONS).option("mode", "FAILFAST").csv(path)
    return _lower_names(df, {schemas.FEED1_TIME_HEADER: "order_time_pst"})


def write_feed1_csv(df: DataFrame, path: str) -> None:
    """CSV with header, in the source's header spelling."""
    out = df.select(*[F.col(c).alias(schemas.FEED1_TIME_HEADER if c == "order_time_pst" else c.upper())
                      for c in df.columns])
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_feed2_json(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """S3: the denormalised order feed as JSON with upper-case keys; ``multiline``: one array a file."""
    src = _upper_schema(schemas.RAW_DATASET_2)
    if multiline:
        return _lower_names(jsonarray.read(spark, [path], src).select(*src.fieldNames()))
    return _lower_names(spark.read.schema(src).option("mode", "FAILFAST").json(path))


def write_feed2_json(df: DataFrame, path: str, array_records: bool = False) -> None:
    """Feed 2 as records in lines or as one array a file."""
    out = df.select(*[F.col(c).alias(c.upper()) for c in df.columns])
    if array_records:
        jsonarray.write(out, path)
    else:
        out.write.mode("overwrite").json(path)


def read_translations(spark: SparkSession, path: str, kind: str = "city", multiline: bool = False,
                      ordered: bool = False) -> DataFrame:
    """Scraped translation records ``{KEY, KEY_ENG, metadata{...}}``; ``ordered`` adds file time and place."""
    base = schemas.CITY_SOURCE if kind == "city" else schemas.DISTRICT_SOURCE
    src = T.StructType([T.StructField(f.name if f.name == "metadata" else f.name.upper(), f.dataType, True)
                        for f in base.fields])
    if multiline:
        rows = _lower_names(jsonarray.read(spark, [path], src))
        return rows if ordered else rows.select(*base.fieldNames())
    df = spark.read.schema(src).option("mode", "FAILFAST").json(path)
    return with_row_order(with_file_order(_lower_names(df))) if ordered else _lower_names(df)


def write_translations(df: DataFrame, path: str, array_records: bool = False) -> None:
    out = df.select(*[F.col(c).alias(c if c == "metadata" else c.upper()) for c in df.columns])
    if array_records:
        jsonarray.write(out, path)
    else:
        out.write.mode("overwrite").json(path)


def read_cluster_results(spark: SparkSession, path: str) -> DataFrame:
    """The city tier results CSV with header and a fixed schema."""
    src = T.StructType([T.StructField(f.name.upper() if f.name not in ("normalized_sales", "cluster") else f.name,
                                      f.dataType, True) for f in schemas.CITY_CLUSTERS.fields])
    return _lower_names(spark.read.schema(src).options(**CSV_OPTIONS).option("mode", "FAILFAST").csv(path))
