"""Encoding texts by their distinct pieces: what a batch says often is encoded once.

Splitting, finding the distinct pieces and putting ids together are done for a batch at once by
Arrow and numpy; only pieces that the worker has not met lately reach an encoder.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class PieceCache:
    """What pieces encode to, in two generations of bounded size: when the newer is full it
    becomes the older, and what the older held and nobody asked for again is gone."""

    def __init__(self, limit: int, longest: int = 64):
        self.limit, self.longest = limit, longest
        self.new: dict[Hashable, bytes] = {}
        self.old: dict[Hashable, bytes] = {}

    def look_up(self, pieces: list, encode: Callable[[list], list[bytes]]) -> list[bytes]:
        """Those of distinct ``pieces``; ``encode`` maps the unseen ones to their bytes."""
        found = list(map(self.new.get, pieces))
        open_at = [k for k, v in enumerate(found) if v is None]
        if self.old:
            for k in open_at:
                found[k] = self.old.get(pieces[k])
        missing = [k for k in open_at if found[k] is None]
        for k, v in zip(missing, encode([pieces[k] for k in missing]) if missing else [], strict=True):
            found[k] = v
        if len(self.new) + len(open_at) > self.limit:
            self.old, self.new = self.new, {}
        self.new.update((pieces[k], found[k]) for k in open_at[: self.limit] if len(pieces[k]) <= self.longest)
        return found


def text_runs(texts: pa.Array, limit: int = 8 << 20) -> Iterator[pa.Array]:
    """Slices of about ``limit`` bytes, nulls as empty values."""
    texts = pc.fill_null(texts, pa.scalar("").cast(texts.type))
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + limit, "right")))
        yield texts.slice(at, stop - at)
        at = stop


def flat_ids(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all values one after another, and the bounds of each value's."""
    bounds = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1].astype(np.int64) if len(ids) else np.zeros(1, np.int64)
    data = ids.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data else np.empty(0, np.uint8)
    # a copy where the first value does not start at a whole number
    flat = np.frombuffer(flat.tobytes(), "<u4") if bounds[0] % 4 else flat.view("<u4")
    return flat, (bounds - bounds[0]) // 4


def from_flat(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The other way round."""
    data = pa.py_buffer(np.ascontiguousarray(ids, "<u4"))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((4 * bounds).astype(np.int32)), data])


def ids_array(parts: list[pa.Array]) -> pa.Array:
    return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())


def encode_pieces(split: pa.ListArray, ids_of: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """The ids of texts given as lists of pieces. ``ids_of`` gives those of distinct pieces."""
    found = split.flatten().dictionary_encode()
    flat, starts = flat_ids(ids_of(found.dictionary))
    which = found.indices.to_numpy()
    n = np.diff(starts)[which]
    stops = np.concatenate([[0], np.cumsum(n)])
    # fewer ids than bytes in a batch, so 32 bits do
    ids = flat[np.repeat((starts[which] - stops[:-1]).astype(np.int32), n) + np.arange(stops[-1], dtype=np.int32)]
    offsets = split.offsets.to_numpy()
    return from_flat(ids, stops[offsets - offsets[0]])


def by_kind(texts: pa.Array, plain: pa.Array, one: Callable[[pa.Array], pa.Array], other: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """``one`` of the texts that are plain and ``other`` of the rest, in the order of the texts."""
    is_plain = plain.to_numpy(zero_copy_only=False)
    if is_plain.all():
        return one(texts)
    if not is_plain.any():
        return other(texts)
    both = pa.concat_arrays([one(texts.filter(plain)), other(texts.filter(pc.invert(plain)))])
    place = np.where(is_plain, np.cumsum(is_plain) - 1, is_plain.sum() + np.cumsum(~is_plain) - 1)
    return both.take(pa.array(place))
