"""Near-duplicate documents by bottom-k sketches of word shingles.

One hash function maps a shingle to 64 bits; a document keeps the ``K`` smallest
values of its set.  The union sketch of two documents, the ``K`` smallest of both
sketches together, holds their common values in proportion to their Jaccard
similarity.

1. Equal sets collapse to a class by digest; its id is the smallest doc_id (for
   ``drop_near_duplicates`` a number given when the classes are written).
2. Retained values form inverted lists.  Values held by one class only are
   dropped; of the others each class enters only its rarest: two sketches that
   must share ``o`` of ``r`` values meet within the ``r - o + 1`` rarest of each
   (values ordered by number of classes, then value).
3. Lists up to ``LIST`` classes give pairs, which the union sketch estimates
   and filters.  A longer list gives one link of each class to the list's
   pivot, unfiltered, so that no pair in it is lost.  The components of these
   links are candidate groups: every pair that may be similar lies in one.
4. A group of more than one block first meets ``LEADERS`` of its classes, drawn by
   hash, by exact comparison: classes that are linked to a leader form its family
   and need no comparison with each other, so a family of any size costs a few
   comparisons a class.
5. Within a group, in blocks bounded in rows, shingles and bytes of text, only
   between neighbouring bands of set size and not within a family, full sets are
   intersected exactly through inverted lists; links at or over the threshold
   join classes, and the components of those links are the result.  In a task a
   class is not compared with those that it is joined to already.

Steps 2 and 3 miss a pair at the threshold only if its union sketch holds five
standard deviations fewer common values than expected (about 1e-6, and less
above the threshold); sets of at most ``K`` shingles are their own sketch and
are compared without chance.

Defined results: null and empty texts, and texts without words, have the empty
set and link with nothing, so that all such rows stay; an empty table gives an
empty result; extra columns are ignored by ``near_duplicates`` and kept by
``drop_near_duplicates``.  The report of ``near_duplicates`` is by doc_id: a null
doc_id links with nothing there, its component is null and it is kept; rows that
share a doc_id are one document, whose text is the one with words and the
smallest hash, and all of them get its component.  ``drop_near_duplicates`` works
on rows: every text with words is compared, whatever its id.  Very long texts are
compared whole, as a block of their own.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import packed, same_key, shuffle_partitions, stage
from .components import connected_components
from .runs import complete_runs

K = 64
#: Classes in an inverted list that still gives pairs; longer lists give links to a pivot.
LIST = 48
#: Shingles in a block; two blocks are compared in a task's memory.  A row counts as ``ROW_SHINGLES`` at least, and
#: ``SHINGLE_BYTES`` of its text as one.
BLOCK_SHINGLES, ROW_SHINGLES, SHINGLE_BYTES = 200_000, 40, 16
#: Classes of a large group that all others meet first.
LEADERS = 8
#: Ids up to this many are sent to the scan of the texts; beyond it the join is shuffled.
BROADCAST_IDS = 500_000

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _scatter(h: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the public splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return np.empty(0, np.int64)
    digest = xxhash.xxh3_64_intdigest
    if len(words) < size:
        return np.array([digest(b" ".join(words), seed=len(words))], np.uint64).view(np.int64)
    w = np.array([digest(x) for x in words], np.uint64)
    n = len(w) - size + 1
    h = np.full(n, _M3, np.uint64)
    for i in range(size):
        h = (h ^ w[i:i + n]) * _M1
        h = (h << np.uint64(31) | h >> np.uint64(33)) * _M2
    return np.unique(_scatter(h).view(np.int64))


def shared_values(threshold: float) -> int:
    """How many of ``K`` retained values a pair at the threshold shares, less five standard deviations."""
    return int(K * threshold - 5 * math.sqrt(K * threshold * (1 - threshold)))


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, th, n, weight, digest, sketch) of every document: hash of the text, size of the set, its share of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                n, weight, digests, kept = [], [], [], []
                for text in b.column(2):
                    t = text.as_py()
                    s = shingle_set(t, size)
                    n.append(len(s))
                    weight.append(max(len(s), ROW_SHINGLES, len(t or "") // SHINGLE_BYTES))
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    kept.append(s[:K])
                bounds = np.concatenate(([0], np.cumsum([len(x) for x in kept]))).astype(np.int32)
                values = np.concatenate(kept) if kept else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(weight, pa.int64()), pa.array(digests, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, pa.int64()))],
                    names=["doc_id", "th", "n", "weight", "digest", "sketch"])
    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(
        run, "doc_id long, th long, n long, weight long, digest binary, sketch array<long>")


def _lists(classes: DataFrame, threshold: float) -> DataFrame:
    """(value, id, n, singles): the inverted lists, each class under its rarest shared values only."""
    entries = classes.select("id", "n", F.explode("sketch").alias("value"))
    held = entries.groupBy("value").agg(F.count(F.lit(1)).alias("held")).where("held > 1").withColumnRenamed("value", "_v")
    shared = entries.join(held, same_key(F.col("value"), F.col("_v"))).drop("_v")
    r = F.least(F.col("n"), F.lit(K))
    need = F.least(F.ceil(F.lit(threshold) * r - 1e-9), F.lit(shared_values(threshold)))
    by_class = Window.partitionBy("id")
    ranked = shared.select("value", "id", "n", F.row_number().over(by_class.orderBy("held", "value")).alias("rank"),
                           (r - F.count(F.lit(1)).over(by_class)).alias("singles"))
    return ranked.where(F.col("rank") <= r - need + 1 - F.col("singles")).drop("rank")


def _estimated(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose union sketch does not rule the threshold out."""
    side = lambda c: classes.select(F.col("id").alias(c), F.col("sketch").alias(f"s{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, K)
    hit = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    return both.where(hit * F.lit(K) >= F.lit(shared_values(threshold)) * F.size(union)).select("a", "b")


def _families(big: DataFrame, text: DataFrame, size: int, threshold: tuple[int, int]) -> DataFrame:
    """(id, family, low): the classes linked to a leader of their group, the leaders' number and the smallest leader's id.

    ``big`` has the classes (grp, id, chunks) of large groups; leaders that are linked to each other lead one family.
    """
    over, under = threshold
    nth = F.row_number().over(Window.partitionBy("grp").orderBy(F.xxhash64("id"), "id")).cast("long")
    leaders = big.withColumn("leader", nth).where(F.col("leader") <= LEADERS)
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")
    rows = (big.select("grp", F.pmod(F.xxhash64("id"), F.col("chunks")).alias("chunk"), F.lit(0).cast("long").alias("leader"), "id")
            .union(leaders.select("grp", chunk, "leader", "id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, bounds in complete_runs(batches, 2):
            ids, leads, text_ = t.column("id").to_numpy(), t.column("leader").to_numpy() > 0, t.column("text")
            found: list[tuple[int, int, int]] = []
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                first = s + int(leads[s:e].sum())
                ahead = [shingle_set(text_[i].as_py(), size) for i in range(s, first)]
                low = smallest_joined(ahead, ids[s:first], over, under)
                for i in range(first, e):
                    own = shingle_set(text_[i].as_py(), size)
                    for r, lead in enumerate(ahead):
                        most = min(len(own), len(lead))
                        if under * most < over * max(len(own), len(lead)):
                            continue
                        common = len(np.intersect1d(own, lead, assume_unique=True))
                        if under * common >= over * (len(own) + len(lead) - common):
                            found.append((int(ids[i]), int(np.flatnonzero(low == low[r])[0]), int(low[r])))
                            break
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["id", "family", "low"])
    dealt = (rows.join(text, F.col("id") == F.col("_id")).select("grp", "chunk", "leader", "id", "text")
             .repartition(shuffle_partitions(big.sparkSession), "grp", "chunk").sortWithinPartitions("grp", "chunk", F.desc("leader"), "id"))
    return dealt.mapInArrow(run, "id long, family long, low long")


def _blocks(members: DataFrame, threshold: float) -> DataFrame:
    """(grp, i, j, own, id, n): each class in the pairs of blocks that it takes part in.

    Sizes of a similar pair differ by less than one band, so a block meets its
    own band and the next ones, but not its own family (-1: no family).  The
    classes of one group, band and family are dealt over blocks by weight.
    """
    m = members.withColumn("band", F.floor(F.log("n") / F.lit(-math.log(threshold))).cast("long"))
    cells = m.groupBy("grp", "band", "family").agg(F.ceil(F.sum("weight") / BLOCK_SHINGLES).alias("blocks"))
    # A block's number is its band, family and place; pairs are (smaller, larger).
    number = lambda band, family, place: band * F.lit(1 << 24) + (family + 1) * F.lit(1 << 20) + place
    other = cells.select(F.col("grp").alias("_g"), F.col("band").alias("_b"), F.col("family").alias("_f"), F.col("blocks").alias("_n"))
    near = cells.join(other, (F.col("grp") == F.col("_g")) & (F.abs(F.col("band") - F.col("_b")) <= 1)
                      & ((F.col("family") != F.col("_f")) | (F.col("family") < 0)))
    near = near.groupBy(F.col("grp").alias("_g"), F.col("band").alias("_b"), F.col("family").alias("_f"), "blocks").agg(
        F.collect_list(F.struct("_b", "_f", "_n")).alias("cells"))  # three bands of at most LEADERS + 1 families
    m = m.join(near, same_key(F.col("grp"), F.col("_g")) & (F.col("band") == F.col("_b")) & (F.col("family") == F.col("_f")))
    own = number(F.col("band"), F.col("family"), F.pmod(F.xxhash64("id"), F.col("blocks")))
    partners = F.flatten(F.transform("cells", lambda c: F.transform(
        F.sequence(F.lit(0).cast("long"), c["_n"] - 1), lambda place: number(c["_b"], c["_f"], place))))
    m = m.select("grp", "id", "n", own.alias("own"), F.explode(partners).alias("other"))
    return m.select("grp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "n")


def _exact(texts: DataFrame, size: int, threshold: tuple[int, int]) -> DataFrame:
    """(a, b): links within each pair of blocks, as one edge per class to the smallest it reaches there."""
    over, under = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, bounds in complete_runs(batches, 3):
            ids, text = t.column("id").to_numpy(), t.column("text")
            a, b = [], []
            for s, e in zip(bounds[:-1], bounds[1:]):
                if e - s < 2:
                    continue
                low = smallest_joined([shingle_set(text[int(i)].as_py(), size) for i in range(s, e)], ids[s:e], over, under)
                moved = low < ids[s:e]
                a.append(ids[s:e][moved])
                b.append(low[moved])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
    keys = ["grp", "i", "j"]
    dealt = (texts.select(*keys, "id", "text").repartition(shuffle_partitions(texts.sparkSession), *keys)
             .sortWithinPartitions(*keys, "id"))
    return dealt.mapInArrow(run, "a long, b long")


def smallest_joined(sets: list[np.ndarray], ids: np.ndarray, over: int, under: int) -> np.ndarray:
    """For every set the smallest id that it reaches by links: under * |intersection| >= over * |union|.

    Common values are counted through inverted lists, one row against all that it
    is not joined to yet: memory is in proportion to the values, whatever the
    number of rows.
    """
    rows = len(sets)
    n = np.array([len(s) for s in sets], np.int64)
    begin = np.concatenate(([0], np.cumsum(n)))
    _, place = np.unique(np.concatenate(sets), return_inverse=True)
    held = np.bincount(place)
    ends = np.cumsum(held)
    owner = np.repeat(np.arange(rows), n)[np.argsort(place, kind="stable")]  # the lists, one after the other
    part, parts = np.arange(rows), rows
    for r in range(rows - 1):
        if parts == 1:
            break
        apart = part[r + 1:] != part[r]
        if not apart.any():
            continue
        v = place[begin[r]:begin[r + 1]]
        size = held[v]
        before = np.cumsum(size) - size
        met = owner[np.repeat(ends[v] - size - before, size) + np.arange(size.sum())]
        common = np.bincount(met[met > r] - r - 1, minlength=rows - r - 1)
        linked = apart & (under * common >= over * (n[r] + n[r + 1:] - common))
        if linked.any():
            joined = np.unique(part[r + 1:][linked])
            part[np.isin(part, joined)] = part[r]
            parts -= len(joined)
    low = np.full(rows, np.iinfo(np.int64).max)
    np.minimum.at(low, part, ids)
    return low[part]


def _linked(docs: DataFrame, classes: DataFrame, size: int, over: int, under: int) -> DataFrame:
    """(id, component) of the classes that are not the smallest of their component.

    ``classes`` are (id, th, digest, n, weight, sketch); th is the hash of a text that has the class's set.
    """
    threshold = over / under
    lists = stage(_lists(classes, threshold), "lists")
    heads = lists.groupBy(F.col("value").alias("_v")).agg(F.count(F.lit(1)).alias("held"),
                                                         F.min_by("id", F.struct("singles", "id")).alias("pivot"))
    entries = stage(lists.join(heads.where("held > 1"), same_key(F.col("value"), F.col("_v"))).drop("_v"), "entries")
    short = entries.where(F.col("held") <= LIST).select("value", "id", "n")
    other = short.select(F.col("value").alias("_v"), F.col("id").alias("b"), F.col("n").alias("_n"))
    pairs = (short.join(other, F.col("value") == F.col("_v"))
             .where((F.col("id") < F.col("b")) & (F.least("n", "_n") >= F.lit(threshold) * F.greatest("n", "_n") - 1e-6))
             .select(F.col("id").alias("a"), "b").distinct())
    stars = entries.where((F.col("held") > LIST) & (F.col("id") != F.col("pivot"))).select(F.col("id").alias("a"), F.col("pivot").alias("b"))
    moved = connected_components(_estimated(stage(pairs, "pairs"), classes, threshold).union(stars), "candidates")
    groups = moved.union(moved.select(F.col("component").alias("id"), "component").distinct())
    members = stage(classes.select("id", "n", "weight", "th").join(groups, "id").select(
        "id", "n", "weight", "th", F.col("component").alias("grp")), "members")
    few = members.count() <= BROADCAST_IDS
    ids = members.select(F.col("id").alias("_id"), F.col("th").alias("_th"))
    text = (docs.select(F.xxhash64("text").alias("th"), "text").where("text IS NOT NULL")
            .join(F.broadcast(ids) if few else ids, F.col("th") == F.col("_th"))
            .groupBy("_id").agg(F.min("text").alias("text")))
    chunks = F.ceil(F.col("weight") / BLOCK_SHINGLES)
    large = stage(members.groupBy(F.col("grp").alias("_g")).agg(F.sum("weight").alias("weight")).where(chunks > 1)
                  .select("_g", chunks.alias("chunks")), "large-groups")
    led = None
    if large.limit(1).count():
        text = stage(text, "candidate-texts")  # read twice
        big = members.join(large, same_key(F.col("grp"), F.col("_g"))).select("grp", "id", "chunks")
        led = stage(_families(big, text, size, (over, under)), "families")
        members = members.join(led.select("id", "family"), "id", "left").fillna(-1, ["family"])
    else:
        members = members.withColumn("family", F.lit(-1).cast("long"))
    blocks = stage(_blocks(members, threshold), "blocks")
    near = _exact(blocks.join(text, F.col("id") == F.col("_id")), size, (over, under))
    if led is not None:
        near = near.union(led.select(F.col("id").alias("a"), F.col("low").alias("b")))
    return connected_components(near, "near")


def near_duplicates(docs: DataFrame, size: int = 5, over: int = 80, under: int = 100) -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id, kept).

    ``size`` words a shingle; linked at ``under`` x intersection >= ``over`` x union.
    """
    sk = stage(sketches(docs, size), "sketches")
    own = stage(sk.where("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min_by("digest", "th").alias("own"), F.min("th").alias("th")), "own")
    first = own.groupBy(F.col("own").alias("digest")).agg(F.min("doc_id").alias("id"), F.min_by("th", "doc_id").alias("th"))
    kept = sk.where("n > 0").groupBy("digest").agg(F.first("n").alias("n"), F.max("weight").alias("weight"), F.first("sketch").alias("sketch"))
    classes = stage(first.join(kept, "digest"), "classes")
    found = _linked(docs, classes, size, over, under)
    label = (classes.select("digest", "id").join(found, "id", "left")
             .select(F.col("digest").alias("_d"), F.coalesce("component", "id").alias("_c")))
    docs_own = own.join(label, F.col("own") == F.col("_d")).select(F.col("doc_id").alias("_id"), "_c")
    component = F.coalesce(F.col("_c"), F.col("doc_id"))
    return (sk.select("doc_id", "n").join(docs_own, F.col("doc_id") == F.col("_id"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                    F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")))


def drop_near_duplicates(docs: DataFrame, size: int = 5, over: int = 80, under: int = 100) -> DataFrame:
    """``docs`` with one row of each group; all columns stay.

    All texts are compared, also those of a shared or null id.  Of a group the row
    with the smallest id stays, in a group without ids the one with the smallest
    hash of its text; repeated rows count as one.
    """
    sk = stage(sketches(docs, size), "sketches")
    texts = stage(sk.where("n > 0").groupBy("doc_id", "th").agg(F.first("digest").alias("digest"), F.count(F.lit(1)).alias("rows")), "texts")
    kept = sk.where("n > 0").groupBy("digest").agg(F.first("n").alias("n"), F.max("weight").alias("weight"),
                                                   F.first("sketch").alias("sketch"), F.min("th").alias("th"))
    classes = stage(kept.withColumn("id", F.monotonically_increasing_id()), "classes")
    found = _linked(docs, classes, size, over, under)
    label = (classes.select("digest", "id").join(found, "id", "left")
             .select(F.col("digest").alias("_d"), F.coalesce("component", "id").alias("grp")))
    # same_key: many rows may have one set, or be one group.
    texts = stage(texts.join(label, same_key(F.col("digest"), F.col("_d"))).select("doc_id", "th", "rows", "grp"), "labelled")
    heads = texts.groupBy(F.col("grp").alias("_g")).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("head"))
    judged = (texts.join(heads, same_key(F.col("grp"), F.col("_g")))
              .withColumn("first", F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("th") == F.col("head.th"))))
    judged = stage(judged.where("NOT first OR rows > 1").select(F.col("doc_id").alias("_gone"), F.col("th").alias("_th"), "first"), "judged")
    th = F.xxhash64(docs["text"])
    same = docs["doc_id"].eqNullSafe(judged["_gone"]) & (th == judged["_th"])
    once = docs.join(judged, same, "left_anti")
    repeated = judged.where("first").drop("first")
    times = repeated.count()
    if not times:
        return once
    again = docs.select(packed(docs), docs["doc_id"].alias("_id"), th.alias("_t")).join(
        F.broadcast(repeated) if times <= BROADCAST_IDS else repeated, F.col("_id").eqNullSafe(F.col("_gone")) & (F.col("_t") == F.col("_th")))
    one = again.groupBy("_id", "_t").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*")
    return once.union(one)


ORACLE = r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, CASE WHEN len(w) > 0 THEN 1 ELSE 0 END) + 1)) AS i FROM tokens)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS u, doc_id AS v FROM documents
  UNION
  SELECT reach.u, both_ways.b FROM reach JOIN both_ways ON reach.v = both_ways.a),
component AS (SELECT u, min(v) AS c FROM reach GROUP BY u)
SELECT t.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, t.doc_id = c AS kept
FROM tokens t LEFT JOIN sizes s ON t.doc_id = s.doc_id JOIN component ON u = t.doc_id
"""
