"""City spend tiers.

City totals are an aggregate of the fact table with one row per city, so
their size is bounded by the geography dimension, not by the data volume.
The statistics (mean, population standard deviation) are one aggregation
joined back on a constant key.  Tiers and the elbow are exact: in one dimension
the clusters of least squared error are runs of the sorted totals, and dynamic
programming finds their cuts, without seeds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.joins import bounded_broadcast
from ledgerline.sources.sinks import materialize

#: Ends of clusters that a task works on at least.
ENDS_PER_TASK = 2000


def city_totals(gold: DataFrame, city_dim: DataFrame) -> DataFrame:
    """A13 + J12: total spend per (non-null) city with its translation attributes."""
    totals = (gold.where(F.col("ship_to_city_cd").isNotNull())
              .groupBy("ship_to_city_cd").agg(F.sum("rmb_dollars").alias("total")))
    attrs = bounded_broadcast(city_dim.select("ship_to_city_cd", "ship_to_city_cd_eng", "province",
                                              "per_capita_usd"), basis=city_dim)
    return (totals.join(attrs, "ship_to_city_cd", "left")
            .select("ship_to_city_cd", F.col("total").cast("double").alias("rmb_dollars"),
                    "ship_to_city_cd_eng", "province", "per_capita_usd"))


def zscores(totals: DataFrame, col: str = "rmb_dollars", out: str = "normalized_sales") -> DataFrame:
    """M1: (x - mean) / population standard deviation (what a standard scaler computes)."""
    stats = totals.agg(F.avg(col).alias("_mu"), F.stddev_pop(col).alias("_sigma")).withColumn("_one", F.lit(1))
    # ``stats`` is a global aggregate: exactly one row, so the broadcast size is proven.
    joined = totals.withColumn("_one", F.lit(1)).join(F.broadcast(stats), "_one")
    z = F.when(F.col("_sigma") == 0, F.lit(0.0)).otherwise((F.col(col) - F.col("_mu")) / F.col("_sigma"))
    return joined.withColumn(out, z).drop("_one", "_mu", "_sigma")


class Totals(NamedTuple):
    """Sorted distinct values and, up to each of them, how many cities there are, their sum and their sum of squares."""
    values: np.ndarray
    n: np.ndarray
    sums: np.ndarray
    squares: np.ndarray

    def error(self, cut: np.ndarray, end: int) -> np.ndarray:
        """Squared error of one cluster of the values from each ``cut`` up to ``end``."""
        n, s = self.n[end] - self.n[cut], self.sums[end] - self.sums[cut]
        return np.maximum(self.squares[end] - self.squares[cut] - s * s / n, 0.0)


def sorted_totals(df: DataFrame, col: str) -> Totals:
    """The distinct values of ``col`` in order (at most one per city: a frame of the size of the geography dimension)."""
    rows = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(col).collect()
    x, n = np.array([r[0] for r in rows], float), np.array([r.n for r in rows], float)
    return Totals(x, *(np.concatenate(([0.0], np.cumsum(c))) for c in (n, n * x, n * x * x)))


def best_cuts(t: Totals, before: np.ndarray, k: int, first: int, last: int) -> Iterator[tuple[int, float, int]]:
    """(end, least error, last cut) of ``k`` clusters of the first ``end`` values, for all ends from ``first`` to ``last``.

    ``before`` holds the least errors with one cluster less.  The best last cut
    never moves left as the end moves right, so the middle end's cut halves the
    cuts to try for the ends on either side of it.
    """
    todo = [(first, last, k - 1, last - 1)]
    while todo:
        lo, hi, low_cut, high_cut = todo.pop()
        if lo > hi:
            continue
        end = (lo + hi) // 2
        cuts = np.arange(low_cut, min(high_cut, end - 1) + 1)
        errors = before[cuts] + t.error(cuts, end)
        at = int(errors.argmin())
        yield end, float(errors[at]), int(cuts[at])
        todo += [(lo, end - 1, low_cut, int(cuts[at])), (end + 1, hi, int(cuts[at]), high_cut)]


def clusterings(df: DataFrame, col: str, most: int) -> tuple[Totals, list[np.ndarray], list[np.ndarray]]:
    """For 1 to ``most`` clusters, the least errors and last cuts of the first values; index 0 is no cluster.

    Each number of clusters is one step of parallel tasks, a range of ends each;
    the errors of the step before travel with the task.
    """
    spark, t = df.sparkSession, sorted_totals(df, col)
    n = len(t.values)
    errors, cuts = [np.concatenate(([0.0], np.full(n, np.inf)))], [np.zeros(n + 1, int)]
    for k in range(1, min(most, n) + 1):
        before = errors[-1]

        def solve(batches: Iterator[pa.RecordBatch], k: int = k, before: np.ndarray = before) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for first, last in zip(*(c.to_pylist() for c in b.columns)):
                    ends, least, cut = zip(*best_cuts(t, before, k, first, last))
                    yield pa.RecordBatch.from_arrays([pa.array(ends, pa.int64()), pa.array(least), pa.array(cut, pa.int64())],
                                                     names=["end", "error", "cut"])
        parts = max(1, min(spark.sparkContext.defaultParallelism, (n - k + 1) // ENDS_PER_TASK))
        bounds = np.linspace(k, n + 1, parts + 1).astype(int).tolist()
        jobs = spark.createDataFrame([(a, b - 1) for a, b in zip(bounds, bounds[1:]) if a < b], "first long, last long")
        rows = jobs.repartition(parts, "first").mapInArrow(solve, "end long, error double, cut long").collect()  # one per distinct total
        errors.append(np.full(n + 1, np.inf))
        cuts.append(np.zeros(n + 1, int))
        for r in rows:
            errors[k][r.end], cuts[k][r.end] = r.error, r.cut
    return t, errors, cuts


def elbow(df: DataFrame, ks=range(1, 10), col: str = "normalized_sales") -> DataFrame:
    """M2: the least squared error of k clusters, for every k up to the number of rows."""
    df = materialize(df.select(col), "tier_input")
    t, errors, _ = clusterings(df, col, max(ks))
    n, rows = len(t.values), int(t.n[-1])
    sse = [(int(k), round(float(errors[min(k, n)][n]), 6)) for k in ks if k <= rows]
    return df.sparkSession.createDataFrame(sse, "k int, sse double")


def kmeans_tiers(totals: DataFrame, k: int = 3) -> DataFrame:
    """M3 + M4: the ``k`` clusters of least squared error on z-scored spend; ``cluster`` and ``tier`` count from the lowest spend.

    Equal totals are in one tier; with fewer distinct totals than ``k`` there are
    as many tiers as totals.
    """
    z = materialize(zscores(totals), "tier_input")  # written: a total that is computed again may differ in its last bit
    t, _, cuts = clusterings(z, "normalized_sales", k)
    starts, end = [], len(t.values)
    for c in range(min(k, end), 1, -1):
        end = int(cuts[c][end])
        starts.append(float(t.values[end]))
    tier = reduce(lambda a, b: a + b, [(F.col("normalized_sales") >= x).cast("int") for x in starts], F.lit(0))
    return z.withColumn("cluster", tier).withColumn("tier", tier).select(*_TIER_COLUMNS)


_TIER_COLUMNS = ("ship_to_city_cd", "rmb_dollars", "ship_to_city_cd_eng", "province", "per_capita_usd",
                 "normalized_sales", "cluster", "tier")


def tier_checks(totals: DataFrame, k: int = 3) -> DataFrame:
    """What must hold for any right set of tiers (one row): all cities tiered, SSE of one cluster, ordered and
    disjoint tiers, labels as near to their centre as to any other, and SSE no higher than with one cluster."""
    out = kmeans_tiers(totals, k)
    z = zscores(totals)
    by_tier = materialize(out.groupBy("tier").agg(
        F.count(F.lit(1)).alias("n"), F.avg("normalized_sales").alias("centre"),
        F.var_pop("normalized_sales").alias("v"), F.min("normalized_sales").alias("lo"), F.max("normalized_sales").alias("hi")), "tier_stats")
    nxt = by_tier.select((F.col("tier") - 1).alias("_t"), F.col("lo").alias("next_lo"), F.col("centre").alias("next_centre"))
    apart = by_tier.join(nxt, F.col("tier") == F.col("_t"))  # k rows
    sse = by_tier.agg(F.sum(F.col("n") * F.col("v")).alias("sse"), F.sum("n").alias("tiered"))
    steps = apart.agg(F.coalesce(F.min(F.col("centre") < F.col("next_centre")), F.lit(True)).alias("tiers_ordered"),
                      F.coalesce(F.min(F.col("hi") < F.col("next_lo")), F.lit(True)).alias("tiers_disjoint"),
                      F.coalesce(F.min((F.col("hi") <= (F.col("centre") + F.col("next_centre")) / 2 + 1e-9)
                                       & (F.col("next_lo") >= (F.col("centre") + F.col("next_centre")) / 2 - 1e-9)), F.lit(True))
                      .alias("labels_nearest"))
    one = z.agg(F.count(F.lit(1)).alias("n_cities"), F.round(F.sum(F.col("normalized_sales") ** 2), 6).alias("sse_one"))
    # Three frames of one row each.
    return (one.crossJoin(F.broadcast(sse)).crossJoin(F.broadcast(steps))
            .select("n_cities", (F.col("tiered") == F.col("n_cities")).alias("all_tiered"), "sse_one",
                    (F.col("sse") <= F.col("sse_one") + 1e-6).alias("sse_not_higher"),
                    "tiers_ordered", "tiers_disjoint", "labels_nearest"))


def _numbered(df: DataFrame, order: list, partitions: int | None = None) -> tuple[DataFrame, int]:
    """``df`` with an exact 1-based ``_rn`` in ``order``, and the total row count."""
    parts = partitions or df.sparkSession.sparkContext.defaultParallelism
    ranged = materialize(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                         .withColumn("_pid", F.spark_partition_id()), "ordered_rows")
    # One count per partition (``parts`` numbers, not data) -> cumulative offsets, as zipWithIndex does.
    counts = sorted((r["_pid"], r["_n"]) for r in
                    ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect())
    offsets, running = [], 0
    for pid, n in counts:
        offsets.append((pid, running))
        running += n
    spark = df.sparkSession
    earlier = spark.createDataFrame(offsets or [(0, 0)], "_pid int, _offset bigint")
    local = F.row_number().over(Window.partitionBy("_pid").orderBy(*order))
    numbered = (ranged.join(F.broadcast(earlier), "_pid")  # one row per partition
                .withColumn("_rn", F.col("_offset") + local).drop("_pid", "_offset"))
    return numbered, running


def global_row_number(df: DataFrame, order: list, partitions: int | None = None) -> DataFrame:
    """Exact 1-based row number ``_rn`` in ``order`` without moving all rows to one task.

    Rows are range-partitioned on the order (sampled bounds), numbered within
    their partition, and shifted by the row count of all earlier partitions;
    the per-partition counts are one small aggregate broadcast back.  The
    ordered frame is written once so partition ids are stable on recompute.
    """
    return _numbered(df, order, partitions)[0]


def ntile_tiers(totals: DataFrame, n: int = 3) -> DataFrame:
    """M5: ``n`` tiers of equal city count by spend (ties broken by city code), SQL NTILE semantics.

    With N rows, q = N // n and r = N % n, the first r tiers hold q + 1 rows;
    N comes from the partition counts of the numbering step.
    """
    order = [F.col("rmb_dollars").asc_nulls_last(), F.col("ship_to_city_cd").asc_nulls_last()]
    numbered, total = _numbered(totals.select("ship_to_city_cd", "rmb_dollars"), order)
    q, r = total // n, total % n
    big = r * (q + 1)
    rn = F.col("_rn")
    if q == 0:  # fewer rows than tiers: row i is tier i
        tier = rn
    else:
        tier = F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1).otherwise(r + F.floor((rn - big - 1) / q) + 1)
    return numbered.select("ship_to_city_cd", "rmb_dollars", tier.cast("int").alias("tier"))
