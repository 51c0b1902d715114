"""Exploratory checks as distributed operators.

Counts are computed in one aggregation pass per frame; membership tests use
existence joins (semi/anti or a broadcast flag) so no row is multiplied and
no group is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.rules import CITY_KNOWN, DISTRICT_KNOWN
from ledgerline.operators.joins import bounded_broadcast
from ledgerline.operators.quality import with_membership
from ledgerline.operators.tiers import global_row_number
from ledgerline.sources.sinks import materialize


#: Characters in a part of the substring index.
GRAM = 3


def duplicate_rows(df: DataFrame, key: str = "order_id") -> DataFrame:
    """Every row whose key occurs more than once, with the key's row count.

    Keys are counted with a partial (map-side) aggregate, so a key holding a
    large share of the rows never lands in one window partition.  The
    duplicated keys are written to the shared folder; the planner broadcasts
    them if the files are small, otherwise the join shuffles (AQE splits a
    skewed key).
    """
    dup = materialize(df.groupBy(key).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1"),
                      "duplicate_keys")
    return df.join(dup, key, "inner")


OVERLAP_COLUMNS = ("order_time_pst", "rptg_amt", "currency_cd", "order_qty")


def feed_overlap(feed1: DataFrame, feed2: DataFrame, key: str = "order_id") -> DataFrame:
    """The rows of either feed whose key also occurs in the other feed (expected empty).

    The shared keys are the intersection of the two distinct key sets (each
    reduced by a partial aggregate), written once and joined by what the size of
    those files suggests; each feed is semi-joined with them,
    so a key repeated in both feeds yields its rows once each, never the
    cross product of its rows.  Rows are tagged with their feed and carry the
    columns both feeds have (as text where the types differ).
    """
    shared = materialize(feed1.select(key).distinct().join(feed2.select(key).distinct(), key, "inner"), "shared_keys")

    def rows(feed: DataFrame, name: str) -> DataFrame:
        return feed.join(shared, key, "left_semi").select(
            key, F.lit(name).alias("feed"), *[F.col(c).cast("string").alias(c) for c in OVERLAP_COLUMNS])
    return rows(feed1, "feed1").unionByName(rows(feed2, "feed2"))


def unmapped_rows(feed: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Feed rows whose key is not in the dimension (a NULL key counts as unmapped)."""
    keys = bounded_broadcast(dim.select(F.col(key).alias("_dim_key")).distinct(), basis=dim)
    return feed.join(keys, feed[key] == keys["_dim_key"], "left_anti")


def unjoinable_reasons(feed: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows whose city or district is missing from the mapping, and why (one row)."""
    flagged = with_membership(
        with_membership(feed, mapping, "ship_to_city_cd", CITY_KNOWN),
        mapping, "ship_to_district_name", DISTRICT_KNOWN)
    city_bad, district_bad = ~F.col(CITY_KNOWN), ~F.col(DISTRICT_KNOWN)
    return flagged.agg(
        F.count_if(city_bad | district_bad).alias("unjoinable_rows"),
        F.count_if(district_bad).alias("due_to_district"),
        F.count_if(city_bad).alias("due_to_city"),
        F.count_if(city_bad & district_bad).alias("due_to_both"))


def missing_values(feed: DataFrame, dim: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of each column that the dimension lacks (EXCEPT DISTINCT).

    The feed's values are reduced to distinct ones (partial aggregation) and
    anti-joined with the dimension's values, broadcast after a size check;
    NULL matches NULL, as in EXCEPT.
    """
    out = None
    for c in columns:
        values = feed.select(F.col(c).alias("value")).distinct()
        known = bounded_broadcast(dim.select(F.col(c).alias("_known")).distinct(), basis=dim)
        diff = (values.join(known, values["value"].eqNullSafe(known["_known"]), "left_anti")
                .select(F.lit(c).alias("column_name"), "value"))
        out = diff if out is None else out.unionByName(diff)
    return out


def _grams(text: Column, size: int) -> Column:
    """The distinct parts of ``size`` characters, one starting at every character."""
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substr(text, i, F.lit(size)))))


def contains_match(values: DataFrame, names: DataFrame, value_col: str, name_col: str, size: int = GRAM) -> DataFrame:
    """For each distinct value, does it occur inside any name of the list?

    The names' parts of ``size`` characters form an index, a row per part and
    name.  A value asks for the names that hold its rarest part, and only these
    are searched; a value with a part that no name holds is in none.  Shorter
    values are looked up among the names' parts of their length.  Both are
    equi-joins, and the rows grow with the length of names and values.  NULL is
    part of nothing; the empty string is part of every name.
    """
    value, name = F.col(value_col), F.col("_name")
    asked = materialize(values.select(value_col).distinct(), "asked_values")
    listed = materialize(names.select(F.col(name_col).alias("_name")).where(name.isNotNull()).distinct()
                         .withColumn("_id", F.monotonically_increasing_id()), "listed_names")
    index = materialize(listed.select("_id", F.explode(_grams(name, size)).alias("_gram")), "name_parts")
    held_by = index.groupBy("_gram").agg(F.count(F.lit(1)).alias("_names"))

    parts = asked.where(F.length(value) >= size).select(value_col, F.explode(_grams(value, size)).alias("_part"))
    rare = (parts.join(held_by, F.col("_part") == F.col("_gram"), "left").groupBy(value_col)
            .agg(F.min(F.struct(F.coalesce("_names", F.lit(0)).alias("n"), F.col("_part").alias("part"))).alias("_rarest"))
            .where("_rarest.n > 0").select(value.alias("_value"), F.col("_rarest.part").alias("_part")))
    probed = rare.join(index, F.col("_part") == F.col("_gram")).select("_value", "_id").join(listed, "_id")
    found = probed.where(F.contains("_name", "_value")).select("_value")

    short = [listed.select(F.explode(_grams(name, n)).alias("_value")) for n in range(1, size)]
    for part in [*short, listed.select(F.lit("").alias("_value"))]:
        found = found.unionByName(part)
    found = found.distinct()
    return (asked.join(found, value == F.col("_value"), "left")
            .select(value_col, F.col("_value").isNotNull().alias("city_match")))


def unjoinable_rows(feed: DataFrame, mapping: DataFrame) -> DataFrame:
    """The rows whose city or district is missing from the mapping, each with its reasons."""
    flagged = with_membership(with_membership(feed, mapping, "ship_to_city_cd", CITY_KNOWN),
                              mapping, "ship_to_district_name", DISTRICT_KNOWN)
    return flagged.where(~F.col(CITY_KNOWN) | ~F.col(DISTRICT_KNOWN)).select(
        *feed.columns, (~F.col(CITY_KNOWN)).alias("city_missing"), (~F.col(DISTRICT_KNOWN)).alias("district_missing"))


# ------------------------------------------------------------------ column profile


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """Per column its type, non-null count, null count and distinct values (NULL is one value).

    Counts of all columns are one aggregate with a map-side step; distinct
    values are counted per column on a scan of that column alone, in its own
    type, each value leaving a task once.
    """
    types = dict(df.dtypes)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    known = counts.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"), F.col(c).alias("non_null_count"),
        (F.col("_rows") - F.col(c)).alias("null_count")) for c in df.columns])))
    unique = None
    for c in df.columns:
        one = df.select(c).distinct().agg(F.count(F.lit(1)).alias("n_unique")).select(F.lit(c).alias("column_name"), "n_unique")
        unique = one if unique is None else unique.unionByName(one)
    # One row per column on both sides.
    return known.join(F.broadcast(unique), "column_name").select(
        F.lit(table).alias("table_name"), "column_name", "data_type", "non_null_count", "null_count", "n_unique")


def value_bitmaps(df: DataFrame, part: str, columns: list[str]) -> DataFrame:
    """A14 by part: (column_name, part, bucket, bitmap), exact sets of the values of each column, told apart by their text.

    One scan leaves the distinct values of each part.  The distinct values of all
    parts are numbered in order, column by column, so that the numbers of a column
    are dense; a bitmap holds 32,768 of them.  NULL is no value.
    """
    cells = materialize(df.select(F.col(part).alias("part"), F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])))
        .where(F.col("value").isNotNull()).distinct(), "cells")
    numbers = global_row_number(cells.select("column_name", "value").distinct(),
                                [F.col("column_name").asc(), F.col("value").asc()])
    return (cells.join(numbers, ["column_name", "value"])
            .groupBy("column_name", "part", F.bitmap_bucket_number("_rn").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_rn")).alias("bitmap")))


def new_values(df: DataFrame, table: str, part: str, columns: list[str]) -> DataFrame:
    """Per column and part: its distinct values, and those that no earlier part holds.

    The bitmaps of the parts up to each part are merged per bucket, so that no
    value is looked at again; parts are few, and a bucket has one row per part.
    """
    so_far = Window.partitionBy("column_name", "bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("column_name", "bucket").orderBy("part")
    merged = materialize(value_bitmaps(df, part, columns), "value_bitmaps").select(
        "column_name", "part", "bucket", F.bitmap_count("bitmap").alias("own"),
        F.bitmap_count(F.bitmap_or_agg("bitmap").over(so_far)).alias("seen"))
    return (merged.withColumn("fresh", F.col("seen") - F.lag("seen", 1, 0).over(before))
            .groupBy("column_name", F.col("part").alias(part)).agg(F.sum("own").alias("n_unique"), F.sum("fresh").alias("n_new"))
            .select(F.lit(table).alias("table_name"), "column_name", part, "n_unique", "n_new"))


def describe_numeric(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Count, mean, sample standard deviation, min and max of numeric columns, one pass.

    All statistics of all columns are one aggregation (partial per task);
    the single result row is unpivoted to one row per column.
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"{c}__count").alias("count"),
        F.round(f"{c}__mean", 6).alias("mean"), F.round(f"{c}__std", 6).alias("std"),
        F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max")) for c in columns]))
    return wide.select(rows).select(F.lit(table).alias("table_name"), "*")


def not_integer_flag(value: Column) -> Column:
    """TRUE if not convertible or fractional, FALSE for a whole positive value,
    NULL (not counted) when it truncates to <= 0."""
    v = value.try_cast("double")
    return (F.when(v.isNull() | F.isnan(v), F.lit(True))
            .when(v >= 1, v != F.floor(v))
            .otherwise(F.lit(None).cast("boolean")))


def invalid_two_decimals(value: Column) -> Column:
    """invalid unless numeric, with at most two decimals, and > 0."""
    v = value.try_cast("double")
    valid = v.isNotNull() & (F.round(v, 2) == v) & (v > 0)
    return ~F.coalesce(valid, F.lit(False))


def rule_failure_counts(feed: DataFrame, feed_name: str) -> DataFrame:
    """The exploratory failure counts of one feed, all in one pass."""
    time = F.col("order_time_pst").cast("string")
    return feed.agg(
        F.lit(feed_name).alias("feed"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(not_integer_flag(F.col("order_qty"))).alias("not_integer_qty"),
        F.count_if(~F.coalesce(F.col("currency_cd") == "RMB", F.lit(False))).alias("not_rmb_currency"),
        F.count_if(invalid_two_decimals(F.col("rptg_amt"))).alias("invalid_amount"),
        F.count_if(~F.coalesce(time.rlike(r"^[0-9]+\z"), F.lit(False))).alias("non_numeric_time"))
