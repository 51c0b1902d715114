"""Connected components by alternating large-star and small-star rounds.

Each round is two aggregations with a map-side minimum and two equi-joins, so a
node with very many links is reduced before the shuffle and split in the join.
Rounds are written to the shared folder; nothing but a row of totals reaches
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import same_key, stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    low = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.min("a")).alias("m"))
    return (both.where("b > a").join(low, same_key(F.col("a"), F.col("u")))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come as (larger, smaller)."""
    low = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = (edges.join(low, same_key(F.col("a"), F.col("u"))).select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.union(low.select("u", "m")).where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return r.n, r.x or 0


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) for every node of an edge but the smallest of its component.

    ``edges`` has two long columns; self-loops, repeats and either direction are
    allowed.  A node that is missing from the result is its own component.
    """
    a, b = edges.columns
    edges = stage(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(),
                  f"{name}-0")
    state, round_ = _state(edges), 0
    while state[0]:
        round_ += 1
        edges = stage(_small_star(_large_star(edges)), f"{name}-{round_}")
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
