"""Toxic spans and document scores from a linear-chain conditional random field.

Every word is tagged toxic or not by a chain over hashed features: the word, its
beginnings and its end, lower-cased.  Labels speak of documents, so the labelled
tokens are derived first: in a toxic training document those words are positive
of which a feature occurs in clearly more toxic than clean documents; all words
of clean documents are negative.  The chain is fitted to these tags by gradient
ascent on its likelihood.

Forward and backward messages of a two-state chain are one number each, the odds
of toxic against not; documents advance in lockstep.  The marginals of a
document give its expected number of toxic words and the strongest one; a
logistic function of both is the score, and words at 0.5 or more are the
offending spans.

Fitting takes texts of each label until ``SAMPLE`` texts or ``SAMPLE_CHARS``
characters are full, of a text longer than ``MOST_CHARS`` stretches spread over
all of it: a documented, bounded sample.  Scoring reads whole texts.

Defined results: a null or empty text has no words and gets the score of a
document without toxic words; without labels of both kinds the score is 0; a
row without id counts as held out; labels other than 0 and 1 and contradicting
ones are not learned from; repeated rows get equal results; extra columns are
ignored by ``score`` and kept by ``drop_toxic``.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import crc_fold
from .sampling import labelled_texts
from .tokens import finish, groups

FOLDS, HELD_OUT = 5, 0
SAMPLE, SAMPLE_CHARS, MOST_CHARS = 1500, 9_000_000, 6000
#: The fitted weights lie in a table of 2 ** BITS places; each place also holds 16 bits of its feature's hash.
BITS = 20
PREFIXES, SUFFIXES = (4, 5, 6), (4,)
#: A feature marks a word as toxic if this many toxic documents hold it, at least this share of all toxic ones, and
#: this many times the share of clean ones.  Documents with one signature (near copies) count once.
MIN_DOCS, MIN_SHARE, MIN_RATIO, SIGNATURES = 3, 0.02, 20.0, 4
ROUNDS, RATE, DECAY = 30, 0.5, 0.01
CUT, LIKELY = 0.5, 0.25
#: Texts that a task scores at once.
ROWS = 1000


class Model(NamedTuple):
    weights: np.ndarray     # of the features, for toxic against not
    checks: np.ndarray      # which feature a place belongs to
    bias: float
    change: np.ndarray      # 2 x 2 log potentials from tag to tag
    document: np.ndarray    # constant, log of expected toxic words, strongest marginal


def _features(words) -> np.ndarray:
    return np.stack([words.word(), *[words.prefix(n) for n in PREFIXES], *[words.suffix(n) for n in SUFFIXES]], 1)


def _place(f: np.ndarray) -> np.ndarray:
    return (f >> np.uint64(64 - BITS)).astype(np.int32)


def _table(feature: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and checks by place; of two features at a place the heavier has it."""
    order = np.argsort(np.abs(weight), kind="stable")
    weights, checks = np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.uint16)
    at = _place(feature[order])
    weights[at], checks[at] = weight[order], feature[order].astype(np.uint16)
    return weights, checks


class Chains:
    """Documents as runs of tokens, longest first, so that step t works on the first so many."""

    def __init__(self, lengths: np.ndarray) -> None:
        start = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        order = np.argsort(-lengths, kind="stable")
        self.start, self.length = start[order], lengths[order]
        longest = int(self.length[0]) if len(lengths) else 0
        self.active = np.searchsorted(-self.length, -np.arange(longest), "left")

    def messages(self, odds: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Odds of toxic by what stands before and at a token, and by what follows it."""
        (p00, p01), (p10, p11) = np.exp(change)
        ahead, behind = np.empty_like(odds), np.ones_like(odds)
        last = None
        for t, n in enumerate(self.active):
            at = self.start[:n] + t
            a = odds[at] if last is None else odds[at] * (p01 + last[:n] * p11) / (p00 + last[:n] * p10)
            ahead[at] = last = np.minimum(a, 1e12)
        for t in range(len(self.active) - 2, -1, -1):
            n = self.active[t + 1]
            at = self.start[:n] + t
            x = odds[at + 1] * behind[at + 1]
            behind[at] = (p10 + p11 * x) / (p00 + p01 * x)
        return ahead, behind


def _node(model: Model, f: np.ndarray) -> np.ndarray:
    """Log odds of each token by its own features."""
    out = np.full(len(f), model.bias)
    for k in range(f.shape[1]):
        at = _place(f[:, k])
        out += np.where(model.checks[at] == f[:, k].astype(np.uint16), model.weights[at], 0)
    return out


def _sums(weights: np.ndarray, f: np.ndarray, bias: float) -> np.ndarray:
    out = np.full(len(f), bias)
    for k in range(f.shape[1]):
        out += weights[f[:, k]]
    return out


def _exp(node: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(node, -30, 25))


def _signatures(word: np.ndarray, document: np.ndarray, toxic: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """A number per document, equal for most near copies (the smallest hash of its word pairs), and each number's label."""
    pair = word.astype(np.uint64)
    pair[:-1] = finish(pair[:-1] << np.uint64(32) ^ pair[1:] ^ np.uint64(salt << 60)) >> np.uint64(2)
    lowest = np.full(len(toxic), 1 << 62, np.int64)
    np.minimum.at(lowest, document, pair.astype(np.int64))
    _, first, signature = np.unique(lowest * 2 + toxic, return_index=True, return_inverse=True)
    return signature, toxic[first]


def _tags(f: np.ndarray, n: int, document: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Token labels: words of toxic documents with a feature that marks toxic documents."""
    held, total = np.full((2, n), np.inf), np.full(2, np.inf)
    for salt in range(SIGNATURES):
        signature, label = _signatures(f[:, 0], document, toxic, salt)
        now = np.zeros((2, n))
        for k in range(f.shape[1]):
            pair = np.unique(signature[document].astype(np.int64) * n + f[:, k])
            np.add.at(now, (label[pair // n], pair % n), 1)
        held[1] = np.minimum(held[1], now[1])
        held[0] = now[0] if salt == 0 else np.maximum(held[0], now[0])
        total = np.minimum(total, np.bincount(label, minlength=2))
    share = (held + 0.5) / (total[:, None] + 1)
    marks = (held[1] >= max(MIN_DOCS, MIN_SHARE * total[1])) & (share[1] >= MIN_RATIO * share[0])
    return marks[f].any(1) & (toxic[document] == 1)


def fit(sample: list[tuple[str, int]]) -> Model | None:
    """The chain and the document function; None without documents of both labels."""
    toxic = np.array([y for _, y in sample], np.int64)
    if len(np.unique(toxic)) < 2:
        return None
    parts = [(w.document, _features(w)) for _, _, w in groups([t for t, _ in sample])]
    document, feature, f = np.concatenate([d for d, _ in parts]), [], []
    for k in range(parts[0][1].shape[1]):  # features of one kind at a time: less memory than all at once
        known, number = np.unique(np.concatenate([x[:, k] for _, x in parts]), return_inverse=True)
        f.append((number + sum(map(len, feature))).astype(np.int32))
        feature.append(known)
    feature, f = np.concatenate(feature), np.stack(f, 1)
    del parts
    n = len(feature)
    lengths = np.bincount(document, minlength=len(sample))
    tag = _tags(f, n, document, toxic).astype(np.float64)
    first = np.concatenate(([True], document[1:] != document[:-1]))
    inner = np.flatnonzero(~first)
    before, here = tag[inner - 1], tag[inner]
    seen = np.array([[((1 - before) * (1 - here)).sum(), ((1 - before) * here).sum()],
                     [(before * (1 - here)).sum(), (before * here).sum()]])
    weights, bias = np.zeros(n), math.log((tag.sum() + 1) / (len(tag) - tag.sum() + 1))
    change = np.zeros((2, 2))
    squares, bias_sq, change_sq = np.full(n, 1e-6), 1e-6, np.full((2, 2), 1e-6)
    chains = Chains(lengths)
    for _ in range(ROUNDS):
        odds = _exp(_sums(weights, f, bias))
        ahead, behind = chains.messages(odds, change)
        p = ahead * behind / (1 + ahead * behind)
        error = tag - p
        step = -DECAY * weights
        for k in range(f.shape[1]):
            step += np.bincount(f[:, k], error, n)
        # Expected moves from tag to tag.
        pot = np.exp(change)
        a, x = ahead[inner - 1], odds[inner] * behind[inner]
        joint = np.array([[pot[0, 0] + 0 * a, pot[0, 1] * x], [a * pot[1, 0], a * pot[1, 1] * x]])
        expected = (joint / joint.sum((0, 1))).sum(2)
        squares += step ** 2
        weights = weights + RATE * step / np.sqrt(squares)
        bias_step = error.sum()
        bias_sq += bias_step ** 2
        bias += RATE * bias_step / math.sqrt(bias_sq)
        change_step = seen - expected
        change_sq += change_step ** 2
        change = change + RATE * change_step / np.sqrt(change_sq)
    ahead, behind = chains.messages(_exp(_sums(weights, f, bias)), change)
    p = ahead * behind / (1 + ahead * behind)
    return Model(*_table(feature, weights), bias, change,
                 document=_logistic(_evidence(p, document, len(sample)), toxic))


def _evidence(p: np.ndarray, document: np.ndarray, n: int) -> np.ndarray:
    """(1, log of the expected toxic words, strongest marginal) of each document; faint marginals do not add up."""
    expected = np.bincount(document, np.where(p >= LIKELY, p, 0), n) if len(p) else np.zeros(n)
    strongest = np.zeros(n)
    np.maximum.at(strongest, document, p)
    return np.stack([np.ones(n), np.log(expected + 0.01), strongest], 1)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton's method with a small ridge; both labels weigh the same."""
    w, weight = np.zeros(x.shape[1]), np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())
    ridge = np.eye(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ w)
    return w


def _spans(document: np.ndarray, place: np.ndarray, size: np.ndarray, p: np.ndarray, texts: list[str | None]) -> list[str]:
    """Offending words of each document as start:end in code points."""
    out = [""] * len(texts)
    hit = np.flatnonzero(p >= CUT)
    for d in np.unique(document[hit]).tolist():
        own = hit[document[hit] == d] if len(texts) > 1 else hit
        raw = np.frombuffer(texts[d].encode("utf-8", "surrogatepass"), np.uint8)
        before = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))  # characters that begin before each byte
        ends = np.stack([before[place[own]], before[place[own] + size[own]]], 1)
        out[d] = ",".join(f"{s}:{e}" for s, e in ends.tolist())
    return out


def _judge(model: Model, texts: list[str | None], spans: bool = True) -> tuple[np.ndarray, list[str]]:
    """Scores and, if wanted, spans; of each group of texts only the log odds of its words are kept."""
    parts = [(w.document, w.place, w.end - w.start, _node(model, _features(w))) for _, _, w in groups(texts)]
    if not parts:
        parts = [(np.empty(0, np.int64),) * 3 + (np.empty(0),)]
    document, place, size, node = (np.concatenate(c) for c in zip(*parts))
    p = np.empty(0)
    if len(node):
        ahead, behind = Chains(np.bincount(document, minlength=len(texts))).messages(_exp(node), model.change)
        p = ahead * behind / (1 + ahead * behind)
    x = _evidence(p, document, len(texts)) @ model.document
    return 1 / (1 + np.exp(-np.clip(x, -30, 30))), _spans(document, place, size, p, texts) if spans else []


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                texts = b.column(2).to_pylist()
                s, spans = _judge(model, texts) if model else (np.zeros(len(texts)), [""] * len(texts))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(s), pa.array((s >= CUT).astype(np.int32)), pa.array(spans)],
                    names=["doc_id", "held_out", "score", "predicted", "spans"])
    held_out = F.coalesce(crc_fold("doc_id", FOLDS) == HELD_OUT, F.lit(True))
    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int, spans string")


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    return fit(labelled_texts(docs, labels.where(crc_fold("doc_id", FOLDS) != HELD_OUT), "toxic", SAMPLE, SAMPLE_CHARS, MOST_CHARS))


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, learn(docs, labels))


def drop_toxic(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` without the rows that score 0.5 or more; all columns stay.  Without a model all rows stay, with a warning."""
    if model is None:
        warnings.warn("no labelled texts of both kinds: no document is dropped as toxic", stacklevel=2)
        return docs
    k = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                yield b.filter(pa.array(_judge(model, b.column(k).to_pylist(), spans=False)[0] < CUT))
    return docs.mapInArrow(run, docs.schema)
