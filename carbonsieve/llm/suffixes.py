"""Suffix arrays of sequences of symbols, by prefix doubling in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def stretches(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of true values start and end (exclusive)."""
    steps = np.diff(np.concatenate([[False], kinds, [False]]).astype(np.int8))
    return np.flatnonzero(steps > 0), np.flatnonzero(steps < 0)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), starts[1], ..."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def sorted_suffixes(keys: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes of a sequence in order, and by rounds the rank of each: equal ranks of round
    k mean that the first 2**k symbols are equal.

    A symbol that is marked as ``alone`` differs from all others; the last one must be.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    at = keys[order]
    single = alone[order]
    fresh = np.ones(n, bool)
    fresh[1:] = (at[1:] != at[:-1]) | single[1:] | single[:-1]
    first = np.flatnonzero(fresh)
    sizes = np.diff(np.append(first, n))
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(first, sizes)
    ranks = [rank]
    places = np.flatnonzero(np.repeat(sizes > 1, sizes))
    step = 1
    while len(places):
        at = order[places]
        key = (rank[at].astype(np.int64) << 32) | rank[at + step]
        again = np.argsort(key, kind="stable")
        at, key = at[again], key[again]
        order[places] = at
        fresh = np.ones(len(at), bool)
        fresh[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(fresh)
        sizes = np.diff(np.append(first, len(at)))
        rank = rank.copy()
        rank[at] = np.repeat(places[first], sizes)
        ranks.append(rank)
        places = places[np.repeat(sizes > 1, sizes)]
        step *= 2
    return order, ranks


def common_prefixes(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols the suffixes at ``a`` and at ``b`` (other places) share."""
    length = np.zeros(len(a), np.int64)
    for k in reversed(range(len(ranks))):
        length += (ranks[k][a + length] == ranks[k][b + length]).astype(np.int64) << k
    return length


def words_of(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """All words of lists of words, one after another without the empty ones, and the bounds of
    each list's."""
    words, bounds = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    filled = np.diff(np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]) > 0 if len(words) else np.empty(0, bool)
    if filled.all():
        return words, bounds
    return words.filter(pa.array(filled)), np.concatenate([[0], np.cumsum(filled)])[bounds]
