"""Words of many texts at once, on the bytes of a buffer.

A word is a run of ASCII letters, digits and bytes above 127, A-Z lower-cased.
Hashes of any substring come from one running sum: byte values are scattered to
64 bits, weighted by powers of an odd constant, and the difference of two sums
is divided by the power at the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

PIECE = 1 << 20
_ODD = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_ODD, -1, 1 << 64)

_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SCATTER = np.random.default_rng(20240611).integers(1, 2 ** 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        x = np.full(n, base, np.uint64)
        x[0] = 1
        return np.cumprod(x)
    return run(_ODD), run(_INVERSE)


def finish(h: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the public splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of a buffer: ``start`` and ``end`` in bytes, and hashes of parts of them."""

    def __init__(self, buffer: np.ndarray) -> None:
        inside = np.concatenate(([False], _IN_WORD[buffer], [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edge[::2], edge[1::2]
        self.raw = buffer
        power, self._back = _powers(max(PIECE, 1 << int(len(buffer)).bit_length()))
        self._sum = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(_SCATTER[_LOWER[buffer]] * power[:len(buffer)], out=self._sum[1:])

    def hash(self, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
        h = (self._sum[end] - self._sum[start]) * self._back[start]
        return finish(h + np.uint64(seed * 0x632BE59BD9B4E019 % (1 << 64)))

    def word(self) -> np.ndarray:
        return self.hash(self.start, self.end, 1)

    def prefix(self, n: int) -> np.ndarray:
        return self.hash(self.start, np.minimum(self.end, self.start + n), 1 + n)

    def suffix(self, n: int) -> np.ndarray:
        return self.hash(np.maximum(self.start, self.end - n), self.end, 101 + n)


def pieces(text: bytes) -> Iterator[tuple[int, bytes]]:
    """A long text in pieces that end between words (a run without such a place is cut)."""
    at = 0
    while len(text) - at > PIECE:
        window = np.frombuffer(text, np.uint8, PIECE, at)
        gaps = np.flatnonzero(~_IN_WORD[window[-65536:]])
        cut = PIECE - 65536 + int(gaps[-1]) + 1 if len(gaps) else PIECE
        yield at, text[at:at + cut]
        at += cut
    yield at, text[at:]


def groups(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, Words]]:
    """(documents, offsets, words) of groups of about a megabyte.

    ``documents`` numbers the texts (or pieces of one) in the group, ``offsets``
    has the place of each in the group's buffer less its place in the text.
    """
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for k, t in enumerate(texts):
        for at, piece in pieces((t or "").encode("utf-8", "surrogatepass")):
            if size + len(piece) > PIECE and held:
                yield _group(held)
                held, size = [], 0
            held.append((k, at, piece))
            size += len(piece) + 1
    if held:
        yield _group(held)


def _group(held: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, Words]:
    begin = np.concatenate(([0], np.cumsum([len(p) + 1 for _, _, p in held])))[:-1]
    words = Words(np.frombuffer(b"\n".join(p for _, _, p in held), np.uint8))
    piece = np.searchsorted(begin, words.start, "right") - 1
    words.document = np.array([k for k, _, _ in held])[piece]
    words.place = words.start - begin[piece] + np.array([at for _, at, _ in held])[piece]
    return np.array([k for k, _, _ in held]), begin, words
