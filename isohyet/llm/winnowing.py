"""Winnowed anchors: of each window of `length` units the one k-gram with the smallest hash.

The choice depends on what is in the window alone, so equal windows have equal anchors, wherever they are.  An anchor owns
the windows that chose it; they are a run of neighbouring starts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from .chunks import SENT, SLICE, Chunk, buckets_for, doubled, over, repeated_keys, send_keys, sliding_minimum
from .common import mix, written


class Anchors(NamedTuple):
    key: np.ndarray  # hash of the k-gram
    start: np.ndarray  # first window that it owns
    n: np.ndarray  # number of windows that it owns
    at: np.ndarray  # where the k-gram begins

    def windows(self) -> np.ndarray:
        """Starts of all owned windows, in order."""
        return np.repeat(self.start - np.cumsum(self.n) + self.n, self.n) + np.arange(int(self.n.sum()))

    def where(self, keep: np.ndarray) -> Anchors:
        return Anchors(*(x[keep] for x in self))


#: Bits of a key that hold a place; longer sequences are gone through in runs of so many windows.
PLACES = 27


def winnow(units: np.ndarray, doc: np.ndarray, length: int, k: int) -> Anchors:
    """Anchors of the windows that lie in one document; doc says of which document a unit is."""
    n, most = len(units) - length + 1, 1 << PLACES
    runs = [_run(units[a : a + most + length - 1], doc[a : a + most + length - 1], length, k, a) for a in range(0, max(n, 0), most)]
    if len(runs) == 1:
        return runs[0]
    return Anchors(*(np.concatenate([np.zeros(0, t), *(r[i] for r in runs)]) for i, t in enumerate((np.uint64, np.int64, np.int64, np.int64))))


def _run(units: np.ndarray, doc: np.ndarray, length: int, k: int, shift: int) -> Anchors:
    n = len(units) - length + 1
    grams, best = np.empty(len(units) - k + 1, dtype=np.uint64), np.empty(n, dtype=np.uint64)
    low = np.uint64((1 << (PLACES + 1)) - 1)
    for i in range(0, n, SLICE):
        some = doubled(units[i : i + SLICE + length - 1], k)
        grams[i : i + len(some)] = some
        best[i : i + SLICE] = sliding_minimum((some & ~low) | np.arange(i, i + len(some), dtype=np.uint64), length - k + 1)
    starts = np.flatnonzero(doc[:n] == doc[length - 1 :])
    at = (best[starts] & low).astype(np.int64)
    first = class_starts(at)
    # the smallest of many hashes is small; mixed anew, keys spread evenly over buckets
    return Anchors(mix(grams[at[first]] ^ np.uint64(0xC2B2AE3D27D4EB4F)), starts[first] + shift, np.diff(np.r_[first, len(starts)]), at[first] + shift)


def repeated_anchors(chunks: DataFrame, n_chunks: int, prepared, length: int, k: int, other_documents: bool, hot_rows: int) -> DataFrame:
    """(chunk, repeated, hot) as repeated_keys has it, of anchors; written.

    prepared(chunk) gives units and doc; other_documents: what one document has several times counts once.
    """
    n_buckets = buckets_for(n_chunks)

    def send(chunk: Chunk, row: dict) -> Iterator[dict]:
        units, doc = prepared(chunk)[:2]
        anchors = winnow(units, doc, length, k)
        order = np.argsort(anchors.key, kind="stable")
        keys = anchors.key[order]
        if not len(keys):
            return
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        if other_documents:
            ids = chunk.doc_ids[doc[anchors.start[order]]]
            counts = 1 + (np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first))
        else:
            counts = np.diff(np.r_[first, len(keys)])
        yield from send_keys(chunk, keys[first], counts, n_buckets)

    return written(repeated_keys(over(chunks, send, SENT), hot_rows), "anchors")


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of set flags."""
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return edges[::2], edges[1::2]


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of n places lie in [s, s + length) of one of the starts."""
    depth = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(np.minimum(starts + length, n), minlength=n + 1)[: n + 1]
    return np.cumsum(depth)[:n] > 0


def class_starts(sorted_keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if len(sorted_keys) else np.zeros(0, dtype=np.int64)
