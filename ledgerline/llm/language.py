"""Language identification by cross-parsing entropy.

Labelled text of each language is turned into a suffix automaton.  A text is
parsed against each: the longest match with the language's text is a phrase,
and the next phrase starts behind it.  Phrases x log2(length of the language's
text) / length of the parsed text estimates the cross entropy; the language
with the fewest such normalised phrases wins, the alphabetically first on a tie.

Automata are tables of states by letters, and thousands of pieces of text walk
them in lockstep.  Every letter of every script is kept apart: a table has
columns for the ``DENSE`` most frequent symbols of its language, and moves by
further letters are looked up by binary search.  Whole texts are parsed, cut into pieces of ``PIECE`` letters
alike for all languages.  Letters are lower-cased; what lies between words
counts as one space.

Fitting draws some ``SAMPLE_ROWS`` labelled texts per language, at least one, and
takes of each a window of ``WINDOW`` letters, at a place drawn by a hash from the
whole text, until ``SAMPLE_LETTERS`` are full: a documented, bounded sample.  The number of languages has no limit; time
and memory grow with it.

Defined results: a null text or one without letters is ``und`` with score 0;
rows without language, text or id are not learned from; a row without id counts
as held out; without any labelled text all rows are ``und``; repeated rows get
equal results; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import crc_fold
from .sampling import per_class

FOLDS, HELD_OUT = 3, 1
SAMPLE_ROWS, SAMPLE_LETTERS, WINDOW = 100, 20_000, 2_000
PIECE, GROUP = 256, 1 << 21
DENSE = 63
#: Letters that are in no sample are one symbol: they are in no language's text, so nothing tells them apart.
_SPACE, _END, _UNKNOWN = 0, 1, 2

Sample = tuple[tuple[str, str], ...]  # (language, text), sorted by language


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def letters(text: str) -> str:
    """Lower-cased words with single spaces between."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return _squeezed(np.where(_letters()[codes], codes, 32)).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def _squeezed(codes: np.ndarray, space: int = 32) -> np.ndarray:
    keep = codes != space
    keep[1:] |= codes[:-1] != space
    return codes[keep]


class Automata:
    """The automata of all languages; every letter of any sample is a symbol of its own.

    A language's ``DENSE`` most frequent symbols are columns of its table; moves
    by its other letters are looked up in a sorted list of (state, symbol).
    """

    def __init__(self, sample: Sample) -> None:
        self.languages = [lang for lang, _ in sample]
        codes = [np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) for _, text in sample]
        known = np.unique(np.concatenate(codes))
        known = known[known != 32]
        self.symbol = np.where(_letters(), _UNKNOWN, _SPACE).astype(np.int32)
        self.symbol[known] = np.arange(len(known)) + _UNKNOWN + 1
        self.bits = [math.log2(max(2, len(c))) for c in codes]
        self.walks = [_Walk(self.symbol[c], len(known) + _UNKNOWN + 1) for c in codes]

    def phrases(self, pieces: np.ndarray) -> np.ndarray:
        """Phrases of each piece (row, filled up with ``_END``) in each language."""
        steps = np.ascontiguousarray(pieces.T).astype(np.int32)
        return np.stack([walk.phrases(steps) for walk in self.walks], 1)


class _Walk:
    """One language's automaton; state 0 is the root, which no letter leads to, so 0 means no transition."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        state, symbol, to, states = _suffix_automaton(text)
        often = np.argsort(-np.bincount(text, minlength=symbols), kind="stable")[:min(DENSE, len(np.unique(text)))]
        self.width, self.symbols = len(often) + 1, symbols
        self.column = np.zeros(symbols, np.int32)  # column 0 stays empty
        self.column[often] = np.arange(len(often)) + 1
        dense = self.column[symbol] > 0
        table = np.zeros((states, self.width), np.int32)
        table[state[dense], self.column[symbol[dense]]] = to[dense]
        self.next = table.ravel()
        key = state[~dense] * symbols + symbol[~dense]
        order = np.argsort(key)
        self.key, self.to = key[order], to[~dense][order].astype(np.int32)
        self.start = np.zeros(symbols, np.int32)
        self.start[symbol[state == 0]] = to[state == 0]
        self.unseen = (self.start == 0).astype(np.int32)
        self.unseen[_END] = 0  # the end of a text closes a phrase and opens none

    def phrases(self, steps: np.ndarray) -> np.ndarray:
        state, n = np.zeros(steps.shape[1], np.int32), np.zeros(steps.shape[1], np.int32)
        for c in steps:
            to = self.next.take(state * self.width + self.column.take(c))
            stop = np.flatnonzero(to == 0)
            if len(stop) and len(self.key):
                key = state[stop].astype(np.int64) * self.symbols + c[stop]
                at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
                to[stop] = np.where(self.key[at] == key, self.to[at], 0)
                stop = stop[to[stop] == 0]
            if len(stop):
                sym = c[stop]
                n[stop] += (state[stop] != 0) + self.unseen[sym]
                to[stop] = self.start[sym]
            state = to
        return n + (state != 0)


def _suffix_automaton(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Transitions (state, symbol, next state) of the automaton of all substrings, and the number of states."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text.tolist():
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(nxt[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[cur] = clone
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
        last = cur
    state = np.repeat(np.arange(len(nxt)), [len(x) for x in nxt])
    symbol = np.fromiter((c for x in nxt for c in x), np.int64, len(state))
    to = np.fromiter((q for x in nxt for q in x.values()), np.int64, len(state))
    return state, symbol, to, len(nxt)


@lru_cache(maxsize=1)
def _automata(sample: Sample) -> Automata:
    return Automata(sample)


def fit(docs: DataFrame) -> Sample:
    """The bounded sample of labelled text per language, drawn from the learning folds."""
    usable = docs.where((crc_fold("doc_id", FOLDS) != HELD_OUT) & F.col("lang").isNotNull()
                        & F.col("text").rlike(r"\p{L}")).select("doc_id", "lang", "text")
    whole = F.regexp_replace("text", r"[^\p{L}]+", " ")
    start = 1 + F.pmod(F.xxhash64("doc_id", F.lit("window")), F.greatest(F.lit(1), F.length(whole) - WINDOW + 1))
    window = F.substr(whole, start.cast("int"), F.lit(WINDOW))
    rows = (per_class(usable, "lang", "doc_id", SAMPLE_ROWS).groupBy("lang", F.xxhash64("text").alias("h"))
            .agg(F.min(window).alias("text")).orderBy("lang", "h"))
    texts: dict[str, list[str]] = {}
    size: Counter = Counter()
    for r in rows.toLocalIterator():
        if size[r.lang] < SAMPLE_LETTERS and (t := letters(r.text)).strip():
            texts.setdefault(r.lang, []).append(t)
            size[r.lang] += len(t)
    return tuple((lang, " ".join(t)) for lang, t in sorted(texts.items()))


def _measured(texts: list[str | None], model: Automata) -> Iterator[tuple[int, np.ndarray, int]]:
    """(index, phrases by language, letters) of every text that has letters."""
    held: list[tuple[int, np.ndarray]] = []
    size = 0

    def parse() -> Iterator[tuple[int, np.ndarray, int]]:
        counts = [-(-len(s) // PIECE) for _, s in held]
        pieces = np.full((sum(counts), PIECE), _END, np.int32)
        at = np.concatenate(([0], np.cumsum(counts)))
        for (_, s), a in zip(held, at):
            pieces.reshape(-1)[a * PIECE:a * PIECE + len(s)] = s
        n = np.add.reduceat(model.phrases(pieces), at[:-1])
        for (k, s), p in zip(held, n):
            yield k, p, len(s)

    for k, text in enumerate(texts):
        if not text:
            continue
        s = _squeezed(model.symbol[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)], _SPACE)
        if not s.any():
            continue
        held.append((k, s))
        size += len(s)
        if size >= GROUP:
            yield from parse()
            held, size = [], 0
    if held:
        yield from parse()


def predict(docs: DataFrame, sample: Sample) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _automata(sample) if sample else None
        for b in batches:
            lang, score = ["und"] * b.num_rows, [0.0] * b.num_rows
            if model:
                bits = np.array(model.bits)
                for k, phrases, n in _measured(b.column(2).to_pylist(), model):
                    entropy = phrases * bits / n
                    best = int(entropy.argmin())
                    lang[k] = model.languages[best]
                    score[k] = float(1 / np.exp(-(entropy - entropy[best]) * math.sqrt(n)).sum())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang), pa.array(score)],
                                             names=["doc_id", "held_out", "lang_pred", "score"])
    held_out = F.coalesce(crc_fold("doc_id", FOLDS) == HELD_OUT, F.lit(True))
    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs))
