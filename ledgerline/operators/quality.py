"""Validation, exception logs and declarative table tests.

* ``qualify``             P1-P7: replace (or only log) values that fail their rule.
* ``exceptions_first``    P8: first failing rule per row, in rule order.
* ``exceptions_all``      P9/P10/U4: every failing rule per row, one row per (order, field).
* ``exceptions_json``     A12: the all-errors log folded to one JSON array per order.
* ``tagged``              P1, P8, P9: cleaned rows, first errors and all errors from one pass over a feed.
* ``dq_*``                T1-T4: unique, not_null, relationships, accepted_values.
* ``test_report``         T1-T4 for a declared list: two scans a table, whatever the number of tests.

All of them are projections or small aggregations over the feed; the only
join is the membership flag against a (checked, broadcast) dimension.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, NamedTuple, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.rules import CITY_KNOWN, DISTRICT_KNOWN, ID_KNOWN, Rule
from ledgerline.operators.joins import bounded_broadcast

FLAGS = (ID_KNOWN, CITY_KNOWN, DISTRICT_KNOWN)


def _known_keys(dim: DataFrame, key: str, flag: str) -> DataFrame:
    return (dim.select(F.col(key).alias(f"_k_{flag}")).where(F.col(f"_k_{flag}").isNotNull())
            .distinct().withColumn(flag, F.lit(True)))


def with_membership(feed: DataFrame, dim: DataFrame, key: str, flag: str,
                    feed_key: str | None = None) -> DataFrame:
    """Add boolean ``flag``: does ``feed[feed_key]`` occur in ``dim[key]``?

    An existence join: the distinct dimension keys are broadcast (after a
    size check) and left-joined, so the feed is neither shuffled nor
    multiplied.  Unmatched non-null keys get FALSE.
    """
    feed_key = feed_key or key
    known = bounded_broadcast(_known_keys(dim, key, flag), basis=dim)
    joined = feed.join(known, feed[feed_key] == known[f"_k_{flag}"], "left")
    return joined.drop(f"_k_{flag}").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def drop_flags(df: DataFrame) -> DataFrame:
    return df.drop(*[f for f in FLAGS if f in df.columns])


def qualify(feed: DataFrame, rules: Sequence[Rule], mode: str = "replace") -> DataFrame:
    """Keep each value only where its rule holds (``mode='replace'``).

    ``CASE WHEN cond THEN value END``: a FALSE or NULL check gives NULL.
    ``mode='log'`` leaves the values untouched (validation only).
    """
    if mode not in ("replace", "log"):
        raise ValueError(f"mode must be 'replace' or 'log', not {mode!r}")
    if mode == "log":
        return drop_flags(feed)
    by_field = {r.field: r for r in rules}
    cols = [F.when(by_field[c].valid(), F.col(c)).alias(c) if c in by_field else F.col(c)
            for c in feed.columns if c not in FLAGS]
    return feed.select(*cols)


def _failure(rule: Rule, null_is_error: bool) -> Column:
    failed = ~rule.valid()
    if null_is_error:
        failed = F.coalesce(failed, F.lit(False)) | F.col(rule.field).isNull()
    return failed


def exceptions_first(feed: DataFrame, rules: Sequence[Rule], key: str = "order_id",
                     null_is_error: bool = False) -> DataFrame:
    """(key, validation_error) with the first failing rule's message.

    With ``null_is_error=False`` a NULL input is not an error (``NOT NULL`` is NULL).
    """
    first = F.coalesce(*[F.when(_failure(r, null_is_error), F.lit(r.message)) for r in rules])
    return (feed.select(F.col(key), first.alias("validation_error"))
            .where(F.col("validation_error").isNotNull()))


def error_array(rules: Sequence[Rule], null_is_error: bool = True) -> Column:
    """All failing rules of a row as ``array<struct<field, message>>`` (empty when clean)."""
    items = F.array(*[F.when(_failure(r, null_is_error),
                             F.struct(F.lit(r.field).alias("field"), F.lit(r.message).alias("message")))
                      for r in rules])
    return F.filter(items, lambda e: e.isNotNull())


def exceptions_all(feed: DataFrame, rules: Sequence[Rule], key: str = "order_id",
                   null_is_error: bool = True, source: str | None = None) -> DataFrame:
    """One row per (key, failing field) with the rule message."""
    out = (feed.select(F.col(key), F.explode(error_array(rules, null_is_error)).alias("e"))
           .select(key, F.col("e.field").alias("field"), F.col("e.message").alias("message")))
    if source is not None:
        out = out.withColumn("source", F.lit(source))
    return out


def exceptions_json(errors: DataFrame, key: str = "order_id") -> DataFrame:
    """One row per key with its errors as a JSON array (sorted, with counts).

    Identical (field, message) pairs of a key are counted first, so a key
    that occurs in many rows still yields a bounded array.
    """
    counted = errors.groupBy(key, "field", "message").agg(F.count(F.lit(1)).alias("n"))
    return (counted.groupBy(key)
            .agg(F.to_json(F.sort_array(F.collect_list(F.struct("field", "message", "n"))))
                 .alias("error_message")))


#: Tags of the outputs of one pass.
CLEAN, FIRST_ERROR, ALL_ERRORS = "clean", "first_error", "all_errors"


def tagged(feed: DataFrame, rules: Sequence[Rule], contract: Sequence[Rule]) -> DataFrame:
    """P1 + P8 + P9 in one pass: every row gives its cleaned row, its first error by ``rules`` and all by ``contract``.

    Returns (tag, field, message, the feed's columns); an error row holds only
    the order id of the feed's columns.
    """
    columns = [c for c in feed.columns if c not in FLAGS]
    by_field = {r.field: r for r in rules}
    none = {c: F.lit(None).cast(feed.schema[c].dataType) for c in columns}
    text = F.lit(None).cast("string")

    def row(tag: str, field: Column, message: Column, values: dict[str, Column]) -> Column:
        return F.struct(F.lit(tag).alias("tag"), field.alias("field"), message.alias("message"),
                        *[values[c].alias(c) for c in columns])
    clean = {c: F.when(by_field[c].valid(), F.col(c)) if c in by_field else F.col(c) for c in columns}
    known = {**none, "order_id": F.col("order_id")}
    first = F.coalesce(*[F.when(_failure(r, False), F.lit(r.message)) for r in rules])
    outputs = F.concat(F.array(row(CLEAN, text, text, clean)),
                       F.filter(F.array(F.when(first.isNotNull(), row(FIRST_ERROR, text, first, known))), lambda x: x.isNotNull()),
                       F.transform(error_array(contract), lambda e: row(ALL_ERRORS, e["field"], e["message"], known)))
    return feed.select(F.inline(outputs))


# --------------------------------------------------------------------------
# Declarative table tests (T1-T4).  Each returns (table, column, test, failures)
# so several tests union into one report; failing rows are available from the
# ``*_rows`` variants.


def _report(table: str, column: str, test: str, failures: DataFrame) -> DataFrame:
    return failures.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
        F.lit(test).alias("test_name"), "failures")


def unique_rows(df: DataFrame, column: str) -> DataFrame:
    """T1 failing rows: non-null values that occur more than once, with their count."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1"))


def dq_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    return _report(table, column, "unique", unique_rows(df, column))


def not_null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def dq_not_null(df: DataFrame, table: str, *columns: str) -> DataFrame:
    """T2 for one or more columns, counted in one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[F.struct(
        F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit("not_null").alias("test_name"),
        F.col(c).cast("bigint").alias("failures")) for c in columns])))


def relationships_rows(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """T3 failing rows: non-null child keys without a parent row."""
    keys = bounded_broadcast(parent.select(F.col(field).alias("_parent_key")).distinct(), basis=parent)
    c = child.where(F.col(column).isNotNull())
    return c.join(keys, c[column] == keys["_parent_key"], "left_anti")


def dq_relationships(child: DataFrame, table: str, column: str, parent: DataFrame, field: str) -> DataFrame:
    return _report(table, column, "relationships", relationships_rows(child, column, parent, field))


def accepted_values_rows(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """T4 failing rows grouped by value: non-null values outside the list."""
    return (df.where(F.col(column).isNotNull() & ~F.col(column).isin(*list(values)))
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_records")))


def dq_accepted_values(df: DataFrame, table: str, column: str, values: Iterable[str]) -> DataFrame:
    """T4: the number of distinct non-null values outside the accepted list."""
    return _report(table, column, "accepted_values", accepted_values_rows(df, column, values))


class Test(NamedTuple):
    """A declared test of a column: ``unique``, ``not_null``, ``relationships`` (to a table's column) or ``accepted_values``."""
    table: str
    column: str
    kind: str
    to: tuple[str, str] | None = None
    values: tuple[str, ...] = ()


def _with_parents(df: DataFrame, tests: Sequence[Test], tables: dict[str, DataFrame]) -> DataFrame:
    """``df`` with a flag per relationships test: the key is in the parent."""
    for i, t in enumerate(tests):
        if t.kind == "relationships":
            parent, field = t.to
            df = with_membership(df, tables[parent], field, f"_parent_{i}", t.column)
    return df


def _failing(t: Test, i: int) -> Column:
    """Whether a row fails a test that looks at one row."""
    c = F.col(t.column)
    if t.kind == "not_null":
        return c.isNull()
    if t.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(*t.values)
    return c.isNotNull() & ~F.col(f"_parent_{i}")


def _by_table(tests: Sequence[Test]) -> dict[str, tuple[list[Test], list[Test]]]:
    """Tests of each table: those that look at one row, and ``unique``."""
    out: dict[str, tuple[list[Test], list[Test]]] = {}
    for t in tests:
        out.setdefault(t.table, ([], []))[t.kind == "unique"].append(t)
    return out


def test_report(tables: dict[str, DataFrame], tests: Sequence[Test]) -> DataFrame:
    """(table_name, column_name, test_name, failures) of every declared test.

    All tests of a table that look at one row are one aggregate on one scan; each
    ``unique`` column is a keyed aggregate on a scan of that column.
    """
    reports = []
    for name, (rowwise, unique) in _by_table(tests).items():
        if rowwise:
            flagged = _with_parents(tables[name], rowwise, tables)
            # Values that are not accepted count once each, all other failures by row.
            counts = flagged.agg(*[(F.count_distinct(F.when(_failing(t, i), F.col(t.column))) if t.kind == "accepted_values"
                                    else F.count_if(_failing(t, i))).alias(f"t{i}") for i, t in enumerate(rowwise)])
            reports.append(counts.select(F.inline(F.array(*[F.struct(
                F.lit(name).alias("table_name"), F.lit(t.column).alias("column_name"), F.lit(t.kind).alias("test_name"),
                F.col(f"t{i}").cast("bigint").alias("failures")) for i, t in enumerate(rowwise)]))))
        reports += [dq_unique(tables[name], name, t.column) for t in unique]
    return reduce(DataFrame.unionByName, reports)


def failing_rows(tables: dict[str, DataFrame], tests: Sequence[Test], key: str = "order_id") -> DataFrame:
    """(table_name, column_name, test_name, row_key, failing_value, n_records): what fails the declared tests.

    A row per failing row, and per value that is not unique or not accepted
    (those have no single row).  One scan a table for all tests that look at one
    row, one for each ``unique`` column.
    """
    out = []
    for name, (rowwise, unique) in _by_table(tests).items():
        if rowwise:
            flagged = _with_parents(tables[name], rowwise, tables)
            found = F.filter(F.array(*[F.when(_failing(t, i), F.struct(
                F.lit(t.column).alias("column_name"), F.lit(t.kind).alias("test_name"),
                F.when(F.lit(t.kind != "accepted_values"), F.col(key)).cast("string").alias("row_key"),
                F.col(t.column).cast("string").alias("failing_value"))) for i, t in enumerate(rowwise)]), lambda x: x.isNotNull())
            rows = flagged.select(F.inline(found))
            # Partial counts: a value that many rows hold leaves a task once.
            rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n_records"))
            out.append(rows.select(F.lit(name).alias("table_name"), *rows.columns))
        out += [unique_rows(tables[name], t.column).select(
            F.lit(name).alias("table_name"), F.lit(t.column).alias("column_name"), F.lit("unique").alias("test_name"),
            F.lit(None).cast("string").alias("row_key"), F.col(t.column).cast("string").alias("failing_value"), "n_records") for t in unique]
    return reduce(DataFrame.unionByName, out)
