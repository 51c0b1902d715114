"""Bounded samples of labelled rows for fitting a model on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stage

#: Sizes of up to this many classes are sent to the scan of the rows; beyond it the join is shuffled.
BROADCAST_CLASSES = 100_000
#: Drawn per wanted row, so that the hash threshold leaves enough of them.
_SLACK = 1.5


def per_class(rows: DataFrame, label: str, key: str, wanted: int) -> DataFrame:
    """About ``1.5 x wanted`` rows of each class (all rows of a smaller one), drawn by a hash of ``key``.

    A class of any size is thinned where it is read, before anything moves; the
    lowest hash of each class is always drawn, so that no class is left out.
    """
    unit = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sizes = stage(rows.groupBy(F.col(label).alias("_class")).agg(
        (F.lit(_SLACK * wanted) / F.count(F.lit(1))).alias("_share"), F.min(unit).alias("_least")), "classes")
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_CLASSES else sizes
    drawn = rows.join(sizes, F.col(label) == F.col("_class"))
    return drawn.where((unit < F.col("_share")) | (unit == F.col("_least"))).drop("_class", "_share", "_least")


#: Stretches that stand for a long text.
STRETCHES = 6


def stretches(text: Column, key: Column, most: int) -> Column:
    """A text of up to ``most`` characters whole; of a longer one ``STRETCHES`` stretches spread over all of it, placed by a hash."""
    size = most // STRETCHES
    unit = F.pmod(F.xxhash64(key, F.lit("stretch")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    starts = [1 + F.floor((F.length(text) - size) * (unit + k) / STRETCHES).cast("int") for k in range(STRETCHES)]
    return F.when(F.length(text) <= most, text).otherwise(F.concat_ws("\n", *[F.substr(text, s, F.lit(size)) for s in starts]))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, wanted: int, chars: int, most: int | None = None) -> list[tuple[str, int]]:
    """(text, label): texts of each class in hash order, until ``wanted`` texts or ``chars`` characters are full.

    Texts are whole or, with ``most``, long ones by stretches of all of them.
    The shortest text drawn of a class is always taken.  Only ids are drawn from
    ``labels``; the bounded set of them is broadcast to the scan of the texts.  If
    the ids drawn of a class have no text, ids are drawn again from those that
    have one.  Ids with contradicting labels are left out.
    """
    clean = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.min(label).alias("y"), F.max(label).alias("_top")).where("y = _top").drop("_top"))
    usable = docs.where(F.length("text") > 0).select("doc_id", "text")
    # The drawn rows only: at most some 1.5 x wanted of a class.
    by_class = Window.partitionBy("y")
    in_order = by_class.orderBy(F.xxhash64("doc_id"), "text")

    def found(ids: DataFrame) -> list[tuple[str, int]]:
        drawn = per_class(ids, "y", "doc_id", wanted).select(F.col("doc_id").alias("_id"), "y")
        rows = (usable.join(F.broadcast(drawn), F.col("doc_id") == F.col("_id"))  # at most 1.5 x wanted x 2 ids, but for chance
                .groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.min_by("y", "doc_id").alias("y"))  # the same ones in every run
                .withColumn("text", F.col("text") if most is None else stretches(F.col("text"), F.col("doc_id"), most))
                .withColumn("_n", F.length("text"))
                .withColumn("_sum", F.sum("_n").over(in_order)).withColumn("_rank", F.row_number().over(in_order))
                .withColumn("_short", F.row_number().over(by_class.orderBy("_n", F.xxhash64("doc_id"), "text"))))
        rows = rows.where(((F.col("_sum") <= chars) & (F.col("_rank") <= wanted)) | (F.col("_short") == 1))
        return [(r.text, int(r.y)) for r in rows.orderBy(F.xxhash64("doc_id"), "text").select("text", "y").toLocalIterator()]

    out = found(clean)
    if len({y for _, y in out}) < 2:
        out = found(clean.join(usable.select(F.col("doc_id").alias("_id")), F.col("doc_id") == F.col("_id"), "left_semi"))
    return out
