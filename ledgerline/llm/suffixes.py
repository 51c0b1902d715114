"""Exact substring dedup: equal blocks by digest, all other suffixes range-partitioned and sorted in buckets.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier is
removed (earlier: smaller doc_id, or same document and earlier start).

Sorting all suffixes of a corpus would move each byte a hundred times.  Instead
each window of ``LENGTH`` bytes is represented by one of its places, its anchor:
the leftmost of the ``K``-byte strings in it with the smallest hash.  Equal
windows have their anchor at the same place, and neighbouring windows mostly
share one, so that one record in some 39 bytes stands for all windows.

1. ``anchors``: a task finds the anchors of its texts.  A record is the hash of
   the anchor's leading bytes, a digest of all bytes of its windows (the block;
   64 bits each, which together name a block), and where it is.  Of equal blocks
   in a task only the first goes on; the others are repeats.
2. Equal blocks of different tasks meet, and the first stays.  Then the blocks of
   each anchor are counted: one with a single block has no repeat, the blocks of
   the others are undecided.
3. The undecided blocks are fetched from the texts and range-partitioned by the
   ``K`` leading bytes of their anchors, with splitters sampled by Spark.  In a
   bucket all suffixes at window starts are sorted to ``LENGTH`` bytes by a
   multikey quicksort (8 bytes a round, only groups still tied go on); of equal
   ones all but the first are repeats.  An anchor with very many blocks is spread
   over neighbouring buckets, whose distinct suffixes are then compared across
   the boundaries by 128-bit digest.
4. The repeats of a document are merged, joined to its text and cut out.

No text leaves its row but as an undecided block.  What meets in one place is a
block, at most once per task, or a bucket of ``BUCKET`` blocks or so; anchors are
counted with a map-side step.

Defined results: a null text is empty; texts shorter than ``LENGTH`` lose
nothing; rows without id come after all others, in the order of a hash of their
text; rows that share a doc_id are told apart by all 64 bits of that hash, and equal
rows count as one document and get the same result; extra columns are ignored by
``report`` and kept by ``remove_repeats``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import packed, same_key, shuffle_partitions, stage
from .runs import complete_runs
from .tokens import _INVERSE, _ODD, _SCATTER, finish

LENGTH, K = 100, 24
#: Strings of K bytes in a window.
SPAN = LENGTH - K + 1
#: Bytes of a group of texts that are worked on at once; longer texts are cut, with windows across the cuts kept.
GROUP = 1 << 19
#: Undecided blocks of one anchor in one bucket.
BUCKET = 2000
NO_ID = (1 << 63) - 1
_PLACE = 20  # bits for a place in a group


def _doc(df: DataFrame) -> tuple[Column, Column]:
    """(doc, th): the order of documents, and what tells rows of one id apart."""
    return (F.coalesce(df["doc_id"].cast("long"), F.lit(NO_ID)).alias("doc"),
            F.xxhash64(df["text"]).alias("th"))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        x = np.full(1 << _PLACE, base, np.uint64)
        x[0] = 1
        return np.cumprod(x)
    return run(_ODD), run(_INVERSE)


class Digests:
    """Digests of any stretch of a buffer from one running sum."""

    def __init__(self, buffer: np.ndarray) -> None:
        self._sum = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(_SCATTER[buffer] * _powers()[0][:len(buffer)], out=self._sum[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._sum[end] - self._sum[start]) * _powers()[1][start]


def _words(buffer: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as one number."""
    return np.ndarray(len(buffer) - 7, "<u8", buffer, strides=(1,))


def _groups(offsets: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
    """Texts (number, first byte, end) in groups; a long text in pieces that overlap by LENGTH - 1 bytes."""
    held: list[tuple[int, int, int]] = []
    size = 0
    for k, (s, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        while e - s >= LENGTH:
            end = min(e, s + GROUP + LENGTH - 1)
            if size + end - s > GROUP + LENGTH and held:
                yield held
                held, size = [], 0
            held.append((k, s, end))
            size += end - s
            s = end - LENGTH + 1 if end < e else e
    if held:
        yield held


def anchors(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, lead, block, place, low, high): the anchors of texts that lie end to end in ``data``.

    ``place`` is the anchor's, ``low`` and ``high`` are its first and last window
    start, all within the text.
    """
    low_bits = np.uint64((1 << _PLACE) - 1)
    for group in _groups(offsets):
        first = group[0][1]
        if all(a[2] == b[1] for a, b in zip(group, group[1:])):
            buffer = data[first:group[-1][2]]
        else:
            buffer = np.concatenate([data[s:e] for _, s, e in group])
        begin = np.concatenate(([0], np.cumsum([e - s for _, s, e in group])))
        w = _words(buffer)
        n = len(buffer) - K + 1
        h = finish(w[:n] * np.uint64(0x9E3779B97F4A7C15) + w[8:8 + n] * np.uint64(0xC2B2AE3D27D4EB4F)
                   + (w[16:16 + n] ^ (w[:n] >> np.uint64(7))) * np.uint64(0x165667B19E3779F9))
        m, width = (h & ~low_bits) | np.arange(n, dtype=np.uint64), 1
        while width * 2 <= SPAN:
            m, width = np.minimum(m[:-width], m[width:]), width * 2
        if width < SPAN:
            m = np.minimum(m[:width - SPAN], m[SPAN - width:])
        inside = np.ones(len(m), bool)
        for end in begin[1:-1]:
            inside[max(0, end - LENGTH + 1):end] = False
        starts = np.flatnonzero(inside)
        at = (m[starts] & low_bits).astype(np.int64)
        cut = np.concatenate(([True], at[1:] != at[:-1]))
        head = np.flatnonzero(cut)
        low, high, x = starts[head], starts[np.append(head[1:], len(starts)) - 1], at[head]
        block = finish(Digests(buffer).of(low, high + LENGTH)
                       + ((x - low) * 256 + (high - low)).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))
        piece = np.searchsorted(begin, x, "right") - 1
        text = np.array([k for k, _, _ in group])[piece]
        shift = np.array([s - offsets[k] for k, s, _ in group])[piece] - begin[piece]
        yield text, h[x].view(np.int64), block.view(np.int64), x + shift, low + shift, high + shift


def _strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column end to end, and the offsets of its rows; nulls are empty."""
    column = column.fill_null("") if column.null_count else column
    offsets = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_string(column.type) else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), offsets


_FOUND = "lead long, block long, doc long, th long, place long, low long, high long"
_NAMES = [c.split()[0] for c in _FOUND.split(", ")]
#: A record with this lead and block says that its windows are repeats; leads are spread to deal such records evenly.
REPEAT = -1


def _emit(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[at:at + 50_000]) for c in columns], names=_NAMES)


def _merged(doc: np.ndarray, th: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """Ranges of window starts, those that touch merged, as records of repeats."""
    order = np.lexsort((low, th, doc))
    doc, th, low, high = doc[order], th[order], low[order], high[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]) | (low[1:] > high[:-1] + 1)
    head = np.flatnonzero(new)
    top = np.maximum.reduceat(high, head) if len(head) else high
    doc, th, low = doc[head], th[head], low[head]
    lead = finish(doc.astype(np.uint64) * np.uint64(3) + th.astype(np.uint64) + low.astype(np.uint64)).view(np.int64)
    nothing = np.full(len(doc), REPEAT, np.int64)
    return [lead, nothing, doc, th, nothing, low, top]


def _later(same: np.ndarray, doc: np.ndarray, th: np.ndarray, place: np.ndarray) -> np.ndarray:
    """In rows sorted by kind, document and place: which are not the first of their kind (nor the first once more).

    ``same`` numbers the kinds in row order.
    """
    head = np.searchsorted(same, same, "left")
    return (doc != doc[head]) | (th != th[head]) | (place != place[head])


def _records(docs: DataFrame) -> DataFrame:
    """Step 1: anchors that are the first of their block in a task, and the repeats found there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = []
        for b in batches:
            doc, th = b.column(0).to_numpy(), b.column(1).to_numpy()
            for text, lead, block, place, low, high in anchors(*_strings(b.column(2))):
                parts.append([lead, block, doc[text], th[text], place.astype(np.int32),
                              (place - low).astype(np.int8), (high - place).astype(np.int8)])
        if not parts:
            return
        lead, block, doc, th, place, before, after = (np.concatenate(c) for c in zip(*parts))
        del parts
        order = np.lexsort((place, th, doc, block, lead))
        lead, block, doc, th, place, before, after = (c[order] for c in (lead, block, doc, th, place, before, after))
        new = np.concatenate(([True], (lead[1:] != lead[:-1]) | (block[1:] != block[:-1])))
        repeat = _later(np.cumsum(new), doc, th, place)
        low, high = place.astype(np.int64) - before, place.astype(np.int64) + after
        yield from _emit(_merged(doc[repeat], th[repeat], low[repeat], high[repeat]))
        yield from _emit([lead[new], block[new], doc[new], th[new], place[new].astype(np.int64), low[new], high[new]])
    rows = docs.select(*_doc(docs), "text")
    return rows.mapInArrow(run, _FOUND)


def _once(records: DataFrame) -> DataFrame:
    """Step 2: the first of equal blocks, and the others as repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, _ in complete_runs(batches, 2):
            lead, block, doc, th, place, low, high = (t.column(c).to_numpy() for c in _NAMES)
            told = place == REPEAT
            if told.any():
                yield from _emit([c[told] for c in (lead, block, doc, th, place, low, high)])
                lead, block, doc, th, place, low, high = (c[~told] for c in (lead, block, doc, th, place, low, high))
            if not len(lead):
                continue
            new = np.concatenate(([True], (lead[1:] != lead[:-1]) | (block[1:] != block[:-1])))
            repeat = _later(np.cumsum(new), doc, th, place)
            if repeat.any():
                yield from _emit(_merged(doc[repeat], th[repeat], low[repeat], high[repeat]))
            yield from _emit([c[new] for c in (lead, block, doc, th, place, low, high)])
    keys = ("lead", "block")
    dealt = records.repartition(shuffle_partitions(records.sparkSession), *keys).sortWithinPartitions(*keys, "doc", "th", "place")
    return dealt.mapInArrow(run, _FOUND)


def _several(blocks: DataFrame) -> DataFrame:
    """The blocks of anchors that have several, ``block`` being their bucket.

    Buckets count from 0; a number with 2^32 added belongs to an anchor with several buckets.
    """
    kinds = blocks.groupBy(F.col("lead").alias("_lead")).agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    buckets = F.ceil(F.col("kinds") / BUCKET)
    spread = F.pmod(F.xxhash64("block"), buckets) + F.lit(1 << 32)
    return (blocks.join(kinds, same_key(F.col("lead"), F.col("_lead")))
            .withColumn("block", F.when(buckets > 1, spread).otherwise(F.lit(0).cast("long"))).select(*_NAMES))


def _fetched(undecided: DataFrame, docs: DataFrame) -> DataFrame:
    """The bytes of the undecided blocks, cut from the texts."""
    per_doc = undecided.groupBy("doc", "th").agg(F.collect_list(F.struct("lead", F.col("block").alias("bucket"), "place", "low", "high")).alias("b"))
    doc, th = _doc(docs)
    texts = docs.select(doc.alias("_doc"), th.alias("_th"), F.col("text").cast("binary").alias("raw"))
    found = per_doc.join(texts, same_key(F.col("doc"), F.col("_doc")) & (F.col("th") == F.col("_th")))
    cut = found.select("doc", "th", "raw", F.explode("b").alias("b")).select("b.lead", "b.bucket", "doc", "th", "b.place", "b.low", "b.high", "raw")
    bytes_ = F.substring("raw", F.col("low").cast("int") + 1, (F.col("high") - F.col("low")).cast("int") + LENGTH)
    leading = F.substring("raw", F.col("place").cast("int") + 1, F.lit(K))
    return cut.select("lead", "bucket", "doc", "th", "place", "low", "high", bytes_.alias("bytes"), leading.alias("leading")).distinct()


def multikey_sort(buffer: np.ndarray, start: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Numbers equal for suffixes of one group that agree in LENGTH bytes; -1 where nothing else does.

    A multikey quicksort, all groups at once: each round splits the groups still
    tied by the next 8 bytes and lets go of suffixes left alone.
    """
    words = _words(np.concatenate([buffer, np.zeros(8, np.uint8)]))
    out = np.full(len(start), -1, np.int64)
    alive = np.arange(len(start))
    tie = np.unique(group, return_inverse=True)[1]
    for depth in [*range(0, LENGTH - 7, 8), *([LENGTH - 8] if LENGTH % 8 else [])]:
        key = words[start[alive] + depth]
        order = np.lexsort((key, tie))
        alive, tie, key = alive[order], tie[order], key[order]
        new = np.ones(len(alive), bool)
        new[1:] = (tie[1:] != tie[:-1]) | (key[1:] != key[:-1])
        tie = np.cumsum(new) - 1
        keep = np.bincount(tie)[tie] > 1 if len(tie) else new
        alive, tie = alive[keep], tie[keep]
    out[alive] = tie
    return out


def _sorted_buckets(blocks: DataFrame) -> DataFrame:
    """Step 3: repeats found by sorting the suffixes of each bucket, and the suffixes to compare across buckets.

    A row is a range of repeated window starts, or, with a digest in ``lead``
    and ``block`` and the start in ``low``, a distinct suffix of a spread anchor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, _ in complete_runs(batches, 2):
            lead, bucket, doc, th, place, low, high = (t.column(c).to_numpy() for c in ("lead", "bucket", "doc", "th", "place", "low", "high"))
            raw = t.column("bytes").combine_chunks()
            buffer, offsets = _strings(raw)
            buffer, begin = buffer[offsets[0]:offsets[-1]], offsets[:-1] - offsets[0]
            count = high - low + 1
            row = np.repeat(np.arange(len(low)), count)
            step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            window = low[row] + step
            run_ = np.cumsum(np.concatenate(([0], (lead[1:] != lead[:-1]) | (bucket[1:] != bucket[:-1]))))
            kind = multikey_sort(buffer, begin[row] + step, run_[row] * (SPAN + 1) + place[row] - window)
            tied = np.flatnonzero(kind >= 0)
            order = tied[np.lexsort((window[tied], th[row[tied]], doc[row[tied]], kind[tied]))]
            r = row[order]
            repeat = _later(kind[order], doc[r], th[r], window[order])
            r, w = r[repeat], window[order][repeat]
            if len(r):
                yield from _emit(_merged(doc[r], th[r], w, w))
            spread = bucket[row] >= 1 << 32
            if spread.any():
                spread[order[repeat]] = False
                s = np.flatnonzero(spread)
                part, digest = _digest_parts(buffer, begin[row[s]] + step[s])
                yield from _emit([part, digest, doc[row[s]], th[row[s]], place[row[s]] - window[s], window[s], window[s]])
    # Equal leading bytes have equal leads, so a run of both is a bucket's part of one anchor.
    dealt = blocks.repartitionByRange(shuffle_partitions(blocks.sparkSession), "leading", "bucket").sortWithinPartitions(
        "leading", "bucket", "doc", "th", "low")
    return dealt.drop("leading").mapInArrow(run, _FOUND)


def _digest_parts(buffer: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits over LENGTH bytes from each start."""
    words = _words(np.concatenate([buffer, np.zeros(8, np.uint8)]))
    a, b = np.full(len(start), 1, np.uint64), np.full(len(start), 2, np.uint64)
    for depth in [*range(0, LENGTH - 7, 8), LENGTH - 8]:
        w = words[start + depth]
        a = finish(a * np.uint64(_ODD) + w)
        b = finish((b ^ w) * np.uint64(0xC2B2AE3D27D4EB4F))
    return a.view(np.int64), b.view(np.int64)


def _across(suffixes: DataFrame) -> DataFrame:
    """Distinct suffixes of spread anchors that start earlier in another bucket."""
    me = F.struct("doc", "th", "low")
    first = suffixes.groupBy(F.col("lead").alias("_l"), F.col("block").alias("_b")).agg(
        F.min(me).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return (suffixes.join(first, same_key(F.col("lead"), F.col("_l")) & (F.col("block") == F.col("_b")))
            .where(me > F.col("first")).select("doc", "th", "low", "high"))


def repeats(docs: DataFrame) -> DataFrame:
    """(doc, th, spans): ranges of bytes to remove, [start, end) and not yet merged, per document that has any."""
    found = stage(_once(_records(docs)), "anchors", free_shuffles=True)
    undecided = stage(_several(found.where(F.col("place") != REPEAT)), "undecided", free_shuffles=True)
    blocks = stage(_fetched(undecided, docs), "blocks", free_shuffles=True)
    ordered = stage(_sorted_buckets(blocks), "suffixes", free_shuffles=True)
    is_repeat = F.col("place") == REPEAT
    cols = ("doc", "th", "low", "high")
    marks = (found.where(is_repeat).select(*cols).union(ordered.where(is_repeat).select(*cols))
             .union(_across(ordered.where(~is_repeat))))
    return marks.groupBy("doc", "th").agg(F.collect_list(F.struct("low", (F.col("high") + LENGTH).alias("end"))).alias("spans"))


def _kept(raw: bytes, low: np.ndarray, end: np.ndarray) -> tuple[bytes, int]:
    """What is left of a text without the ranges, and the number of maximal ranges."""
    order = np.argsort(low)
    low, end = low[order], np.maximum.accumulate(end[order])
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > end[:-1]
    start, stop = low[new], np.append(end[:-1][new[1:]], end[-1])
    parts, at = [], 0
    for s, e in zip(start.tolist(), stop.tolist()):
        parts.append(raw[at:s])
        at = e
    parts.append(raw[at:])
    return b"".join(parts), len(start)


def _joined(docs: DataFrame) -> DataFrame:
    """(row, spans): each row of ``docs`` as a struct, with the ranges to remove or null."""
    doc, th = _doc(docs)
    spans = repeats(docs).select(F.col("doc").alias("_doc"), F.col("th").alias("_th"), "spans")
    return (docs.select(packed(docs), doc, th).join(spans, same_key(F.col("doc"), F.col("_doc")) & (F.col("th") == F.col("_th")), "left")
            .select("row", "spans"))


def _ranges(spans: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    flat = spans.flatten()
    low, end = flat.field("low").to_numpy(), flat.field("end").to_numpy()
    n = np.array([len(x) if x.is_valid else 0 for x in spans], np.int64)
    for s, k in zip(np.cumsum(n) - n, n):
        yield (low[s:s + k], end[s:s + k]) if k else None


def report(docs: DataFrame) -> DataFrame:
    """One row per document: bytes, bytes removed, maximal removed runs, digest of what is left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for raw, found in zip(b.column(1), _ranges(b.column(2))):
                raw = raw.as_py() or b""
                kept, runs = _kept(raw, *found) if found else (raw, 0)
                out.append((len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return _joined(docs.select("doc_id", "text")).select("row.doc_id", F.col("row.text").cast("binary").alias("raw"), "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes cut out of the texts (a cut inside a character leaves a replacement mark)."""
    schema, k = docs.schema, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = b.column(0).flatten()
            texts = []
            for t, found in zip(columns[k], _ranges(b.column(1))):
                texts.append(_kept(t.as_py().encode(), *found)[0].decode("utf-8", "replace") if found else t.as_py())
            columns[k] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
    return _joined(docs).mapInArrow(run, schema)
