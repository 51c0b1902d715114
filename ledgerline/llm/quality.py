"""Document quality by a factorisation machine.

Inputs of a document are its hashed words (counts, scaled to length one),
statistics of its structure and its size.  Besides a weight each input has a
vector of ``RANK`` numbers, and every pair of inputs adds the product of their
vectors; the sum over all pairs is had in linear time as half of (square of the
sum less sum of the squares), vector place by vector place.

Fitting takes whole texts of each label until ``SAMPLE`` texts or ``SAMPLE_CHARS``
characters are full: a documented, bounded sample.  Scoring reads whole texts.

Defined results: a null or empty text has no words and is scored by its
statistics, all 0; without labels of both kinds the score is 0; a row without id
counts as held out; labels other than 0 and 1 and contradicting ones are not
learned from; an ``n_chars`` that is null or no number counts
as 0; repeated rows get equal results;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import crc_fold
from .sampling import labelled_texts
from .tokens import groups

FOLDS, HELD_OUT = 3, 1
SAMPLE, SAMPLE_CHARS = 1500, 6_000_000
BITS, RANK = 16, 8
ROUNDS, RATE, DECAY = 60, 0.1, 1e-4
CUT = 0.5
#: Texts that a task scores at once.
ROWS = 1000

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SIGN = np.zeros(256, bool)
_SIGN[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'"]] = True
_LINE = np.zeros(256, bool)
_LINE[10] = True
_KINDS = (_UPPER, _DIGIT, _SIGN, _LINE)
#: words, bytes a word, share of distinct words, share of the most frequent word, shares of upper-case letters,
#: digits, signs and line ends among the bytes, size column
STATS = 5 + len(_KINDS)


class Model(NamedTuple):
    bias: float
    linear: np.ndarray   # hashed words, then statistics
    factor: np.ndarray   # the same by RANK
    mean: np.ndarray
    scale: np.ndarray


class Inputs(NamedTuple):
    document: np.ndarray  # of each entry, ascending
    index: np.ndarray
    value: np.ndarray
    stats: np.ndarray     # documents x STATS


def inputs(texts: list[str | None], sizes: list[int | None]) -> Inputs:
    n = len(texts)
    keys, counts, totals, chars = [], np.zeros((n, len(_KINDS))), np.zeros(n), np.zeros(n)
    words, letters = np.zeros(n), np.zeros(n)
    for owner, begin, w in groups(texts):
        end = np.append(begin[1:], len(w.raw))
        for k, kind in enumerate(_KINDS):
            total = np.concatenate(([0], np.cumsum(kind[w.raw])))
            np.add.at(counts[:, k], owner, total[end] - total[begin])
        np.add.at(chars, owner, end - begin)
        words += np.bincount(w.document, minlength=n)
        letters += np.bincount(w.document, w.end - w.start, n)
        keys.append(w.document.astype(np.int64) << BITS | (w.word() >> np.uint64(64 - BITS)).astype(np.int64))
    key, count = np.unique(np.concatenate(keys) if keys else np.empty(0, np.int64), return_counts=True)
    document, index = key >> BITS, key & ((1 << BITS) - 1)
    totals = np.sqrt(np.bincount(document, count.astype(np.float64) ** 2, n))
    value = count / totals[document]
    most = np.zeros(n)
    np.maximum.at(most, document, count)
    distinct = np.bincount(document, minlength=n)
    some = np.maximum(words, 1)
    stats = np.column_stack([np.log1p(words), letters / some, distinct / some, most / some,
                             counts / np.maximum(chars, 1)[:, None], np.log1p([max(0, s or 0) for s in sizes])])
    return Inputs(document, index.astype(np.int32), value.astype(np.float32), stats)


def _raw(m: Model, x: Inputs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores before the logistic function, the sums of vectors and the scaled statistics."""
    n, first = len(x.stats), 1 << BITS
    z = np.clip((x.stats - m.mean) / m.scale, -4, 4)
    linear = np.bincount(x.document, m.linear[x.index] * x.value, n) + z @ m.linear[first:]
    sums, squares = z @ m.factor[first:], z ** 2 @ m.factor[first:] ** 2
    for r in range(m.factor.shape[1]):
        part = m.factor[x.index, r] * x.value
        sums[:, r] += np.bincount(x.document, part, n)
        squares[:, r] += np.bincount(x.document, part ** 2, n)
    return m.bias + linear + 0.5 * (sums ** 2 - squares).sum(1), sums, z


def probability(m: Model, x: Inputs) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_raw(m, x)[0], -30, 30)))


def fit(sample: list[tuple[str, int]]) -> Model | None:
    """Adaptive gradient descent on the logistic loss, both labels weighing the same."""
    y = np.array([v for _, v in sample], np.float64)
    if len(np.unique(y)) < 2:
        return None
    x = inputs([t for t, _ in sample], [len(t) for t, _ in sample])
    n, first = len(y), 1 << BITS
    size = first + STATS
    rng = np.random.default_rng(11)
    m = Model(0.0, np.zeros(size), rng.normal(0, 0.02, (size, RANK)), x.stats.mean(0), x.stats.std(0) + 1e-6)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / n
    linear_sq, factor_sq, bias_sq = np.full(size, 1e-8), np.full((size, RANK), 1e-8), 1e-8
    for _ in range(ROUNDS):
        raw, sums, z = _raw(m, x)
        error = weight * (y - 1 / (1 + np.exp(-np.clip(raw, -30, 30))))
        ex = error[x.document] * x.value
        linear = np.concatenate([np.bincount(x.index, ex, first), z.T @ error]) - DECAY * m.linear
        factor = np.empty((size, RANK))
        own = np.bincount(x.index, ex * x.value, first)
        for r in range(RANK):
            factor[:first, r] = np.bincount(x.index, ex * sums[x.document, r], first) - own * m.factor[:first, r]
        factor[first:] = z.T @ (error[:, None] * sums) - (z ** 2).T @ error[:, None] * m.factor[first:]
        factor -= DECAY * m.factor
        linear_sq += linear ** 2
        factor_sq += factor ** 2
        bias_sq += error.sum() ** 2
        m = m._replace(bias=m.bias + RATE * error.sum() / np.sqrt(bias_sq),
                       linear=m.linear + RATE * linear / np.sqrt(linear_sq),
                       factor=m.factor + RATE * factor / np.sqrt(factor_sq))
    return m._replace(linear=m.linear.astype(np.float32), factor=m.factor.astype(np.float32))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                s = (probability(model, inputs(b.column(2).to_pylist(), b.column(3).to_pylist())) if model
                     else np.zeros(b.num_rows))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= CUT).astype(np.int32))],
                                                 names=["doc_id", "held_out", "score", "predicted"])
    held_out = F.coalesce(crc_fold("doc_id", FOLDS) == HELD_OUT, F.lit(True))
    size = F.col("n_chars").try_cast("long") if "n_chars" in docs.columns else F.length("text").cast("long")
    return docs.select("doc_id", held_out.alias("held_out"), "text", size.alias("size")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    learn = labels.where(crc_fold("doc_id", FOLDS) != HELD_OUT)
    return score(docs, fit(labelled_texts(docs, learn, "quality", SAMPLE, SAMPLE_CHARS)))
