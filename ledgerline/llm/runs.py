"""Consecutive rows of equal keys in a sorted partition, from Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def complete_runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs with the run bounds; the first ``n_keys`` columns (longs) are the key.

    Holds one run and one batch at a time.
    """
    tail: list[pa.Table] = []
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        if tail and _key(tail[-1], -1, n_keys) == _key(t, 0, n_keys) == _key(t, t.num_rows - 1, n_keys):
            tail.append(t)  # still the same run
            continue
        t = pa.concat_tables([*tail, t])
        cuts = _cuts(t, n_keys)
        if len(cuts):
            yield t.slice(0, cuts[-1]).combine_chunks(), np.concatenate(([0], cuts))
            t = t.slice(cuts[-1])
        tail = [t]
    if tail:
        t = pa.concat_tables(tail).combine_chunks()
        yield t, np.array([0, t.num_rows])


def _key(t: pa.Table, i: int, n_keys: int) -> tuple:
    i = i if i >= 0 else t.num_rows + i
    return tuple(t.column(k)[i].as_py() for k in range(n_keys))


def _cuts(t: pa.Table, n_keys: int) -> np.ndarray:
    """The rows at which a key differs from the one before."""
    differs = np.zeros(max(0, t.num_rows - 1), bool)
    for k in range(n_keys):
        c = t.column(k).to_numpy()
        differs |= c[1:] != c[:-1]
    return np.flatnonzero(differs) + 1


def smallest_linked(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix, the smallest id reachable from each row."""
    low = ids.copy()
    has = linked.any(1)
    while has.any():
        rows = np.flatnonzero(has)
        new = low.copy()
        new[rows] = np.minimum(low[rows], np.where(linked[rows], low[None, :], np.iinfo(np.int64).max).min(1))
        if (new == low).all():
            break
        low = new
    return low
