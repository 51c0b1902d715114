"""Mixing sources to target weights by Poisson replication.

Every document is repeated k times, k drawn from a Poisson distribution whose
mean is the repetition rate of its source: ``size x weight / count``.  The draw
inverts the distribution at a uniform number taken from a hash of (seed,
doc_id, source, text), so a rerun after a lost executor gives the same copies.
Copies are put in a global pseudo-random order by a second hash.

A source's distribution is tabled around its mean only, over some 24 standard
deviations, so the table grows with the square root of the rate.

Defined results: a null source is a source of its own; a source without a
target weight has rate 0; null ids and texts are hashed as such; very long texts
are hashed whole; an empty table gives an empty mix; extra columns are carried
through, but for columns named ``mix_copy`` or ``mix_key``, which are replaced;
repeated rows (same id, source and text) draw the same number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import packed, stage

SEED = 20240611
#: Entries of the sources' tables (8 bytes each) that are sent to all tasks; beyond it sources are joined by shuffle.
BROADCAST_ENTRIES = 8_000_000
#: Copies of a row that are made at once.
COPIES = 10_000
#: u < 1 - 2**-52 at most, so the inversion ends long before this many terms past the mean.
_SPAN = 2.0 ** 52


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an md5 over the parts."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("double") / F.lit(_SPAN)


def poisson_table(rate: float) -> tuple[int, np.ndarray]:
    """(k, cdf): P(K <= k), P(K <= k + 1), ... from far below the mean to far above it.

    Probabilities are relative to that of the mode and divided by their sum, so a
    large mean does not underflow; what lies outside is below 1e-30.
    """
    width = 12.0 * math.sqrt(rate) + 40.0
    first, mode, last = max(0, int(rate - width)), int(rate), int(rate + width)
    k = np.arange(first, last + 1, dtype=np.float64)
    steps = math.log(rate) - np.log(np.maximum(k, 1.0))  # from k - 1 to k
    log_p = np.concatenate((-np.cumsum(steps[1:mode - first + 1][::-1])[::-1], [0.0], np.cumsum(steps[mode - first + 1:])))
    cdf = np.cumsum(np.exp(log_p))
    return first, cdf / cdf[-1]


def _tables(rates: DataFrame) -> DataFrame:
    """(of, first, cdf) of the sources with a rate above 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, rate in enumerate(b.column(1).to_pylist()):
                first, cdf = poisson_table(rate)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), pa.array([first], pa.int64()), pa.array([cdf], pa.list_(pa.float64()))],
                                                 names=["of", "first", "cdf"])
    kind = rates.schema["source"].dataType.simpleString()
    return rates.select("source", "rate").where("rate > 0").mapInArrow(run, f"of {kind}, first long, cdf array<double>")


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None,
                 size: float | None = None) -> DataFrame:
    """(source, n_docs, rate): repetition rate of each source.

    ``weights`` are target shares (normalised here); None gives every source
    the same share.  ``size`` is the wanted number of documents (None: as many as given).
    """
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    if weights is None:
        weighted = counts.withColumn("weight", F.lit(1.0))
    else:
        pairs = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
        weighted = counts.withColumn("weight", F.coalesce(F.try_element_at(pairs, F.col("source")), F.lit(0.0)))
    totals = weighted.agg(F.sum("weight").alias("w"), F.sum("n_docs").alias("n"))
    wanted = F.lit(float(size)) if size is not None else F.col("n").cast("double")
    return weighted.crossJoin(F.broadcast(totals)).select(  # one row of totals
        "source", "n_docs", (wanted * F.col("weight") / F.col("w") / F.col("n_docs")).alias("rate"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, size: float | None = None,
        seed: int = SEED) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, ``mix_copy`` (1..k) and ``mix_key``, ordered by ``mix_key``."""
    if weights is not None and not math.fsum(weights.values()) > 0:
        raise ValueError("target weights must sum to more than 0")
    tables = stage(_tables(source_rates(docs, weights, size)), "poisson")
    entries = tables.agg(F.sum(F.size("cdf").cast("long"))).first()[0] or 0
    text = F.md5(F.col("text").cast("binary"))
    ident = (F.col("doc_id"), F.col("source"), text)
    rows = docs.select(packed(docs), F.col("source").alias("source"), text.alias("text"), uniform(F.lit(seed), *ident).alias("u"))
    drawn = rows.join(F.broadcast(tables) if entries <= BROADCAST_ENTRIES else tables, F.col("source").eqNullSafe(F.col("of")))
    # The table's last entry is 1, above every u.  At its first one the cdf is what lies below the table and nothing else.
    n = F.col("first") + F.size(F.filter("cdf", lambda c: c <= F.col("u")))
    drawn = drawn.select("row", "text", n.alias("n")).where("n > 0")
    lots = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))
    lot = drawn.select("row", "text", "n", F.explode(lots).alias("lot"))
    within = F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES).cast("long"), F.col("n") - F.col("lot") * COPIES))
    copies = lot.select("row", "text", "lot", F.explode(within).alias("place"))
    copies = copies.select("row", "text", (F.col("lot") * COPIES + F.col("place")).cast("int").alias("mix_copy"))
    key = uniform(F.lit(f"order{seed}"), F.col("row.doc_id"), F.col("row.source"), F.col("text"), F.col("mix_copy"))
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("mix_copy", "mix_key")]
    return copies.withColumn("mix_key", key).orderBy("mix_key", "row.doc_id", "mix_copy").select(*kept, "mix_copy", "mix_key")


ORACLE = f"""
WITH counts AS (SELECT source, count(*) AS n_docs FROM documents GROUP BY source),
totals AS (SELECT count(*) AS w, sum(n_docs) AS n FROM counts),
rates AS (SELECT source, CAST(n AS DOUBLE) * 1.0 / w / n_docs AS rate FROM counts, totals),
cdf AS (
  SELECT source, k, sum(exp(-rate + k * ln(rate) - CASE WHEN k = 0 THEN 0 ELSE lgamma(k + 1) END))
         OVER (PARTITION BY source ORDER BY k) AS c
  FROM (SELECT source, rate, unnest(range(0, CAST(rate + 12 * sqrt(rate) + 41 AS BIGINT))) AS k FROM rates)),
drawn AS (
  SELECT d.*, CAST(('0x' || substr(md5(concat_ws('|', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), '~'),
         coalesce(source, '~'), coalesce(md5(text), '~'))), 1, 13)) AS BIGINT) / {_SPAN} AS u
  FROM documents d),
counted AS (
  SELECT d.doc_id, d.source, d.lang, d.text, d.n_chars, count(*) AS n
  FROM drawn d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source AND cdf.c <= d.u
  GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, CAST(g AS INTEGER) AS mix_copy,
       CAST(('0x' || substr(md5(concat_ws('|', 'order{SEED}', coalesce(CAST(doc_id AS VARCHAR), '~'),
       coalesce(source, '~'), coalesce(md5(text), '~'), CAST(g AS VARCHAR))), 1, 13)) AS BIGINT) / {_SPAN} AS mix_key
FROM counted, unnest(range(1, n + 1)) t(g)
"""
