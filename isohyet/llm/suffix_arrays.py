"""Suffix arrays in numpy: Larsson-Sadakane refinement, Kasai's common prefixes, binary search in sorted places."""

from __future__ import annotations

import numpy as np


def eight_bytes(text: np.ndarray) -> np.ndarray:
    """At each place the next eight bytes as a number in their order; zeros after the end."""
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
    out = np.zeros(len(text), dtype=np.uint64)
    for j in range(8):
        out = out << np.uint64(8) | padded[j : j + len(text)]
    return out


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` bytes or more.

    A suffix's rank is the first place of its group.  Groups begin as those of eight equal bytes; each round splits what
    is not yet alone in its group by the rank that lies as far ahead as is sorted, which doubles that.
    """
    n = len(text)
    head = eight_bytes(text)
    order = np.argsort(head, kind="stable").astype(np.int64)
    begins = np.r_[True, head[order][1:] != head[order][:-1]] if n else np.zeros(0, dtype=bool)
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
    done = 8
    while done < depth:
        alone = begins & np.r_[begins[1:], True]
        places = np.flatnonzero(~alone)
        if not len(places):
            break
        suffixes = order[places]
        ahead = rank[np.minimum(suffixes + done, n)] + 1
        key = rank[suffixes].astype(np.uint64) << np.uint64(32) | ahead.astype(np.uint64)
        by = np.argsort(key, kind="stable")
        key, suffixes = key[by], suffixes[by]
        order[places] = suffixes
        first = np.r_[True, key[1:] != key[:-1]]
        begins[places] = first
        rank[suffixes] = np.maximum.accumulate(np.where(first, places, 0))
        done *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, cap: int, lane: int = 256) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in order, cap at most (Kasai).

    What a place has in common with its neighbour, the next place has too, but for one byte.  That holds where the two
    are in order; from cap on they may not be, so the next place then counts anew.  The text is cut into lanes that go
    on side by side, each from its own start.
    """
    n = len(order)
    out = np.zeros(n, dtype=np.int64)
    if n < 2:
        return out
    at = np.empty(n, dtype=np.int64)
    at[order] = np.arange(n)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    head = eight_bytes(text)
    starts = np.arange(0, n, lane)
    have = np.zeros(len(starts), dtype=np.int64)
    for step in range(lane):
        i = starts + step
        live = i < n
        i, have = i[live], have[live]
        starts = starts[live]
        other = before[i]
        have = np.where((other < 0) | (have == cap), 0, np.maximum(have - 1, 0))
        grow = np.flatnonzero((other >= 0) & (have < cap))
        while len(grow):
            a, b = i[grow] + have[grow], other[grow] + have[grow]
            inside = np.minimum(n - a, n - b)
            grow, a, b, inside = (x[inside > 0] for x in (grow, a, b, inside))
            x = head[a] ^ head[b]
            same = np.full(len(x), 8)
            for k in range(8):
                same -= x >= np.uint64(1 << (8 * k))
            same = np.minimum(same, inside)
            have[grow] += same
            grow = grow[(same == 8) & (have[grow] < cap)]
        have = np.minimum(have, cap)
        out[at[i]] = have
    return out


def search(head: np.ndarray, places: np.ndarray, sought: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each sought place of a text: how many of the sorted places have smaller strings, and whether one has the same.

    head: eight_bytes of the text; strings have `length` bytes, 8 or more.
    """
    steps = np.array([*range(0, length - 7, 8), length - 8])
    low, high = np.zeros(len(sought), dtype=np.int64), np.full(len(sought), len(places), dtype=np.int64)
    there = np.zeros(len(sought), dtype=bool)
    for i in range(0, len(sought), 16384):
        s = slice(i, i + 16384)
        low[s], there[s] = _search(head, places, sought[s], steps, low[s], high[s], there[s])
    return low, there


def _search(head, places, sought, steps, low, high, there):
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) // 2
        a, b = head[places[mid][:, None] + steps], head[sought[open_][:, None] + steps]
        differ = a != b
        first = differ.argmax(1)
        pick = np.arange(len(open_))
        less = a[pick, first] < b[pick, first]
        there[open_] |= ~differ.any(1)
        low[open_[less]] = mid[less] + 1
        high[open_[~less]] = mid[~less]
    return low, there
