"""Hard negatives by a vertical scan of quantised vectors (branch and bound on decomposed data).

Vectors are quantised to integers, so that scores (inner products) are exact and
equal on every machine.  Rows of one length are dealt over blocks and each block
is stored column by column, with the least and greatest value of every column.

An anchor's block meets every block of rows of its length (the queries are a
fixed share of the rows, against all rows).  The scan reads the columns in the
order of the anchor's descending magnitudes, a few at a time, and adds them to
the partial scores of the candidates.  What the columns still to come can add
lies between two sums of column extremes, so each candidate has an interval; a
bitmap holds those that may still count, and columns are read for them alone:

1. Positives: same label.  A candidate goes once the k-th best lower end is
   above its upper end.
2. Negatives: other labels, a score window for each positive.  A candidate stays
   as long as its interval meets a window in which fewer than ``per_positive``
   candidates surely lie above it.

The best of each block are merged by rank per anchor and positive, with Spark's
group limit before the shuffle.  A block holds a bounded number of cells, so a
vector with any number of copies is spread over blocks and nothing is capped.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; nor do rows whose squared length after
quantising reaches 2**62, since scores are longs.  Equal rows (id, label,
vector) count once; different rows of one id count each, but none of an anchor's
own id is its positive or negative, and rows of one id and score come in the
order of label and vector.  Vectors of different lengths never meet, empty ones
score 0.  An anchor without positives, or a positive without rows in its window,
gives no row.  Ties go to the smaller id; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import shuffle_partitions, stage
from .runs import complete_runs

SCALE = 256
POSITIVES, PER_POSITIVE = 5, 3
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 50, 95
#: Cells (rows x columns) in a block of rows, and in a block of anchors.
CELLS, ANCHOR_CELLS = 1 << 18, 1 << 15
#: Columns read at once.
STEP = 8


def quantised(vectors: DataFrame, label: str = "label", scale: int = SCALE) -> DataFrame:
    """(id, label, vector): the rows that take part, once each, components as ``floor(scale * x)``."""
    x = F.transform("embedding", lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.expr(label).cast("long").alias("label"),
                          F.col("embedding")).where("id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    length2 = F.aggregate(x, F.lit(0.0), lambda a, c: a + c * c)
    return (rows.where(finite).where(length2 < F.lit(2.0 ** 62))
            .select("id", "label", F.transform(x, lambda c: c.cast("int")).alias("vector")).distinct())


def _blocks(rows: DataFrame, cells: int, name: str) -> DataFrame:
    """One row per block: (dim, block, n, ids, labels, cells, low, high), the cells column by column.

    Rows are dealt at random over the blocks of their length; a block has a
    Poisson number of rows around ``cells / dim``.
    """
    sizes = rows.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("of"))
    sizes = stage(sizes.select("dim", F.ceil(F.col("of") * F.greatest("dim", F.lit(1)) / cells).alias("blocks")), f"{name}-sizes")
    dealt = (rows.withColumn("dim", F.size("vector")).join(sizes, "dim")
             .select(F.col("dim").cast("long").alias("dim"), F.pmod(F.xxhash64("id", "label", "vector"), F.col("blocks")).alias("block"),
                     "id", "label", "vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, bounds in complete_runs(batches, 2):
            vectors = t.column("vector").combine_chunks()
            flat, ids, labels = vectors.flatten().to_numpy(), t.column("id").to_numpy(), t.column("label").to_numpy()
            at = np.concatenate(([0], np.cumsum(np.repeat(t.column("dim").to_numpy()[bounds[:-1]], np.diff(bounds)))))
            for s, e in zip(bounds[:-1], bounds[1:]):
                dim = t.column("dim")[s].as_py()
                columns = flat[at[s]:at[e]].reshape(e - s, dim).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim]), pa.array([t.column("block")[s].as_py()]), pa.array([int(e - s)]), pa.array([ids[s:e]]),
                     pa.array([labels[s:e]]), pa.array([np.ascontiguousarray(columns).ravel()], pa.list_(pa.int32())),
                     pa.array([columns.min(1)], pa.list_(pa.int32())), pa.array([columns.max(1)], pa.list_(pa.int32()))],
                    names=["dim", "block", "n", "ids", "labels", "cells", "low", "high"])
    dealt = dealt.repartition(shuffle_partitions(rows.sparkSession), "dim", "block").sortWithinPartitions(
        "dim", "block", "id", "label", "vector")
    return stage(dealt.mapInArrow(run, "dim long, block long, n long, ids array<long>, labels array<long>, "
                                       "cells array<int>, low array<int>, high array<int>"), name)


class Block(NamedTuple):
    """Rows of a block, column by column."""
    ids: np.ndarray
    labels: np.ndarray
    columns: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def read(b: pa.RecordBatch, i: int, prefix: str = "") -> Block:
        def of(c: str) -> np.ndarray:
            return b.column(prefix + c)[i].values.to_numpy().astype(np.int64)
        ids = of("ids")
        return Block(ids, of("labels"), of("cells").reshape(-1, len(ids)), of("low"), of("high"))


def _kth_best(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def scan(block: Block, anchor: np.ndarray, candidates: np.ndarray, k: int,
         windows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the block that may be among the ``k`` best candidates of some window, and their exact scores.

    ``windows`` holds inclusive bounds of the score (None: all scores).  No row of
    a result is missing; a few more may be there.
    """
    alive = np.flatnonzero(candidates)
    order = np.argsort(-np.abs(anchor), kind="stable")
    a = anchor[order]
    ends = np.stack([a * block.low[order].astype(np.float64), a * block.high[order].astype(np.float64)])
    slack = np.abs(ends).max(0).sum() * 2.0 ** -40  # more than rounding can make out
    # What the columns from a place on can add: at least, at most.
    least = np.append(np.cumsum(ends.min(0)[::-1])[::-1], 0.0) - slack
    most = np.append(np.cumsum(ends.max(0)[::-1])[::-1], 0.0) + slack
    scores = np.zeros(len(alive), np.int64)
    bounds = np.array([[-np.inf, np.inf]]) if windows is None else windows
    for at in range(0, len(order), STEP):
        if not len(alive):
            break
        part = order[at:at + STEP]
        whole = len(alive) == len(block.ids)
        scores += a[at:at + STEP] @ (block.columns[part] if whole else block.columns[part[:, None], alive])
        read = min(at + STEP, len(order))
        low, high = scores + least[read], scores + most[read]
        kept = np.zeros(len(alive), bool)
        for lo, hi in bounds:
            sure = low[(low >= lo) & (high <= hi)]
            kept |= (high >= max(lo, _kth_best(sure, k))) & (low <= hi)
        if not kept.all():
            alive, scores = alive[kept], scores[kept]
    return alive, scores


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _meeting(blocks: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every block of anchors (columns ``a_...``) beside every block of rows of its length."""
    parts = shuffle_partitions(blocks.sparkSession)
    last = blocks.groupBy(F.col("dim").alias("_dim")).agg(F.max("block").alias("_last"))
    sent = (anchors.join(last, F.col("dim") == F.col("_dim"))
            .select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns],
                    F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))).alias("to")))
    # Dealt by a stated number: little data, much work, so AQE must not merge the tasks.
    return blocks.repartition(parts, "dim", "block").join(
        sent.repartition(parts, "a_dim", "to"), (F.col("dim") == F.col("a_dim")) & (F.col("block") == F.col("to")))


def _scanned(met: DataFrame, found: Callable[[pa.RecordBatch, int, Block, Block], Iterator[tuple]], columns: str) -> DataFrame:
    """(dim, block, place) of the anchors of every meeting, with the rows that ``found`` makes of it."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                rows = list(found(b, i, Block.read(b, i), Block.read(b, i, "a_")))
                if rows:
                    dim, block = b.column("a_dim")[i].as_py(), b.column("a_block")[i].as_py()
                    cells = [pa.array([int(r[c]) for r in rows], pa.int64()) for c in range(len(names))]
                    yield pa.RecordBatch.from_arrays([pa.array([dim] * len(rows)), pa.array([block] * len(rows)), *cells],
                                                     names=["dim", "block", *names])
    return met.mapInArrow(run, f"dim long, block long, {columns}")


def mine(vectors: DataFrame, is_anchor: str, label: str = "label", positives: int = POSITIVES,
         per_positive: int = PER_POSITIVE, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a SQL condition on the column ``id``; ``label`` a SQL expression
    over the columns of ``vectors``.
    """
    rows = stage(quantised(vectors, label, scale), "quantised")
    blocks = _blocks(rows, CELLS, "row-blocks")
    anchors = _blocks(rows.where(is_anchor), ANCHOR_CELLS, "anchor-blocks")

    def near(b: pa.RecordBatch, i: int, block: Block, asked: Block) -> Iterator[tuple]:
        for place, (anchor, label_, x) in enumerate(zip(asked.ids, asked.labels, asked.columns.T)):
            at, scores = scan(block, x, (block.labels == label_) & (block.ids != anchor), positives)
            for t in _best(block.ids[at], scores, positives):
                yield place, anchor, block.ids[at[t]], scores[t]

    here = _scanned(_meeting(blocks, anchors), near, "place long, anchor long, positive long, score long")
    first = Window.partitionBy("dim", "block", "place").orderBy(F.desc("score"), "positive")
    found = here.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= positives)
    found = stage(found.groupBy("dim", "block").agg(F.array_sort(F.collect_list(
        F.struct("place", F.col("nth").cast("long").alias("nth"), "positive", "score"))).alias("found")), "positives")

    def hard(b: pa.RecordBatch, i: int, block: Block, asked: Block) -> Iterator[tuple]:
        known = b.column("a_found")[i].values
        place, nth, positive, score = (known.field(c).to_numpy() for c in ("place", "nth", "positive", "score"))
        cuts = np.flatnonzero(np.diff(place, prepend=-1, append=-1))
        for s, e in zip(cuts, cuts[1:]):
            anchor, x = asked.ids[place[s]], asked.columns[:, place[s]]
            # Whole scores with: low * positive <= 100 * negative <= high * positive.
            window = np.stack([-(-low * score[s:e] // 100), high * score[s:e] // 100], 1)
            at, scores = scan(block, x, (block.labels != asked.labels[place[s]]) & (block.ids != anchor), per_positive,
                              np.unique(window, axis=0))
            for n, (lo, hi) in zip(range(s, e), window):
                inside = np.flatnonzero((scores >= lo) & (scores <= hi))
                for t in inside[_best(block.ids[at[inside]], scores[inside], per_positive)]:
                    yield place[n], nth[n], anchor, positive[n], score[n], block.ids[at[t]], scores[t]

    asked = anchors.join(found, ["dim", "block"])
    here = _scanned(_meeting(blocks, asked), hard, "place long, nth long, anchor_id long, positive_id long, "
                                                   "positive_score long, negative_id long, negative_score long")
    first = Window.partitionBy("dim", "block", "place", "nth").orderBy(F.desc("negative_score"), "negative_id")
    return (here.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= per_positive)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


#: The label of the registered query: every seventh row's is moved by one.
MOVED_LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"

ORACLE = """
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.id AS anchor_id, a.label AS anchor_label, b.id, b.label, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.id <> b.id AND len(a.v) = len(b.v) WHERE a.id % 50 = 0),
positives AS (
  SELECT anchor_id, anchor_label, id AS positive_id, score AS positive_score FROM scores WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
     AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
