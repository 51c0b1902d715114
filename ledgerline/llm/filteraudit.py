"""How filters interact, from sorted posting lists of the documents that fail them.

Each filter has, per part and range of row numbers, the sorted list of the rows
that fail it.  What a filter removes after others is the difference of its list
and the union of theirs; both are made by galloping merges (a run of one list
up to the next head of the others is found by doubling steps and copied whole).
The lists of good and toxic rows are met with the differences in the same way.
A task holds the lists of one range, at most ``RANGE`` rows whatever the size of
the part; sizes are summed over ranges.

The removals of a filter depend on the set of filters before it, not on their
order, so 5 filters need 80 differences and 31 unions for all 120 orders.

Rows are numbered as they are written (Spark's partition number and the place in
it), so ranges are dense and repeated or null ids do not matter.

Defined results: a null text counts as empty; null and empty ``lang`` are one
part, ``''``; every row is a document, also repeated ones; a row without id
never fails the copy filter and makes no other row fail it, and rows of one id
and text are no copies of each other; a document is good (toxic) if any label
row of its id says so, null or missing labels say nothing; whole texts are read,
however long; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import combinations, permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import same_key, shuffle_partitions, stage

# The filters and their bounds.
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 3
SYMBOLS = r"[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = r"[\x20\x09-\x0D]+"

#: Row numbers in a range (a power of two).
RANGE = 1 << 15


def row_filters(text: Column) -> dict[str, Column]:
    """The filters that look at one text, true where it fails."""
    words = F.array_remove(F.split(text, _BETWEEN), "")
    n = F.size(words)
    return {"A": n < MIN_WORDS, "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * n,
            "C": 100 * (F.length(text) - F.length(F.translate(text, CAPITALS, ""))) > MAX_CAPITALS * F.length(text),
            "D": text.rlike(SYMBOLS)}


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, row, A..E, good, toxic): one row per document, numbered."""
    text = F.coalesce("text", F.lit(""))
    seen = docs.select(F.col("doc_id").alias("id"), F.coalesce("lang", F.lit("")).alias("part"), F.sha2(text.cast("binary"), 256).alias("digest"),
                       *[c.alias(k) for k, c in row_filters(text).items()])
    seen = stage(seen, "filters")
    first = seen.where("id IS NOT NULL").groupBy(F.col("digest").alias("_d")).agg(F.min("id").alias("_first"))
    marks = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id"))
             .agg(F.max(F.col("quality").eqNullSafe(1)).alias("good"), F.max(F.col("toxic").eqNullSafe(1)).alias("toxic")))
    known = (seen.join(first, same_key(F.col("digest"), F.col("_d")), "left").withColumn("E", F.coalesce(F.col("id") > F.col("_first"), F.lit(False)))
             .join(marks, same_key(F.col("id"), F.col("_id")), "left"))
    return stage(known.select("part", F.monotonically_increasing_id().alias("row"), *FILTERS,
                              *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]), "failures")


def posting_lists(failed: DataFrame) -> DataFrame:
    """(part, range, n, A..E, good, toxic): sorted row numbers of each range, counted from its start."""
    at = F.shiftright("row", RANGE.bit_length() - 1)
    place = F.col("row").bitwiseAND(F.lit(RANGE - 1)).cast("int")
    lists = [F.array_sort(F.collect_list(F.when(F.col(c), place))).alias(c) for c in (*FILTERS, "good", "toxic")]
    return stage(failed.groupBy("part", at.alias("range")).agg(F.count(F.lit(1)).alias("n"), *lists), "postings")


def gallop(into: list[int], key: int, at: int) -> int:
    """The first place from ``at`` on that is not less than ``key``: doubling steps, then a search between the last two."""
    step = 1
    while at + step < len(into) and into[at + step] < key:
        at += step
        step *= 2
    return bisect_left(into, key, at, min(len(into), at + step + 1))


def union(lists: list[list[int]]) -> list[int]:
    """All numbers of sorted lists, once each."""
    heads = [[x[0], 0, x] for x in lists if x]
    out: list[int] = []
    while heads:
        heads.sort(key=lambda h: h[0])
        first, at, x = heads[0]
        if len(heads) == 1:
            out += x[at:]
            break
        if heads[1][0] > first:  # a run of one list
            end = gallop(x, heads[1][0], at)
            out += x[at:end]
            heads[0][1] = end
        else:
            out.append(first)
            for h in heads:
                if h[0] != first:
                    break
                h[1] += 1
        heads = [[x[at], at, x] for _, at, x in heads if at < len(x)]
    return out


def difference(x: list[int], gone: list[int]) -> list[int]:
    """The numbers of ``x`` that ``gone`` does not hold, both sorted."""
    out: list[int] = []
    at = other = 0
    while at < len(x):
        other = gallop(gone, x[at], other)
        if other == len(gone):
            out += x[at:]
            break
        end = gallop(x, gone[other], at)
        out += x[at:end]
        at = end + (end < len(x) and x[end] == gone[other])
    return out


def common(x: list[int], y: list[int]) -> int:
    """How many numbers two sorted lists share."""
    return len(x) - len(difference(x, y))


def _sizes(lists: dict[str, list[int]]) -> Iterator[tuple[str, str, int, int, int, int]]:
    """(filter, filters before it, removed, union of all of them, good ones and toxic ones removed) for every set before it."""
    for size in range(len(FILTERS)):
        for before in combinations(FILTERS, size):
            gone = union([lists[f] for f in before])
            for f in FILTERS:
                if f not in before:
                    removed = difference(lists[f], gone)
                    yield (f, "".join(before), len(removed), len(gone) + len(removed), common(removed, lists["good"]),
                           common(removed, lists["toxic"]))


def interactions(postings: DataFrame) -> DataFrame:
    """(part, filter, before, total, failing, removed, gone, good_lost, toxic_lost): sums over all ranges."""
    counts = ("total", "failing", "removed", "gone", "good_lost", "toxic_lost")
    names = ["part", "filter", "before", *counts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                lists = {c: b.column(c)[i].values.to_pylist() for c in (*FILTERS, "good", "toxic")}
                part, n = b.column("part")[i].as_py(), b.column("n")[i].as_py()
                rows = [(part, f, before, n, len(lists[f]), *sizes) for f, before, *sizes in _sizes(lists)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
    # Dealt by a stated number: little data, much work, so AQE must not merge the tasks.
    dealt = postings.repartition(shuffle_partitions(postings.sparkSession), "part", "range")
    sizes = dealt.mapInArrow(run, "part string, filter string, before string, " + ", ".join(f"{c} long" for c in counts))
    return sizes.groupBy("part", "filter", "before").agg(*[F.sum(c).alias(c) for c in counts])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    sums = stage(interactions(posting_lists(failures(docs, labels))), "interactions")
    spark, k = docs.sparkSession, len(FILTERS)
    steps = spark.createDataFrame([("".join(p), s + 1, p[s], "".join(sorted(p[:s]))) for p in permutations(FILTERS) for s in range(k)],
                                  "filter_order string, step int, _filter string, _before string")
    # A set of b filters comes first in b! (k-1-b)! orders in which the filter follows.
    orders = [factorial(b) * factorial(k - 1 - b) for b in range(k)]
    weight = F.element_at(F.array(*[F.lit(x) for x in orders]), F.length("before") + 1)
    alone = sums.groupBy(F.col("part").alias("_part"), F.col("filter").alias("_of")).agg(
        F.sum(F.col("removed") * weight).alias("shapley"), F.sum(F.when(F.length("before") == k - 1, F.col("removed"))).alias("unique_fails"))
    step = sums.join(F.broadcast(steps), (F.col("filter") == F.col("_filter")) & (F.col("before") == F.col("_before")))  # 600 rows
    return (step.join(alone, (F.col("part") == F.col("_part")) & (F.col("filter") == F.col("_of")))
            .select("part", "filter_order", "step", (F.col("total") - F.col("gone")).alias("kept"), "removed",
                    (F.col("failing") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley"))


ORACLE = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first_id FROM texts),
marks AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
          FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN d.doc_id > first_id THEN 'E' ELSE '' END) AS failed
  FROM words d LEFT JOIN marks m ON d.doc_id = m.doc_id),
cells AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM fails GROUP BY ALL),
orders AS (
  SELECT '' AS o
  UNION ALL
  SELECT o || f FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(f) WHERE NOT contains(o, f)),
steps AS (SELECT o AS filter_order, i AS step, substr(o, i, 1) AS f, substr(o, 1, i - 1) AS before
          FROM orders, range(1, 6) r(i) WHERE length(o) = 5),
counted AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN translate(failed, before || f, '') = failed THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(failed, f) AND translate(failed, before, '') = failed THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(failed, f) AND translate(failed, before, '') <> failed THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failed = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(failed, f) AND translate(failed, before, '') = failed THEN n_good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(failed, f) AND translate(failed, before, '') = failed THEN n_toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""
