"""Hashes of all words of a byte string at once, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
TURN = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


CODES = mix(np.arange(1, 257, dtype=np.uint64))
# A multiplier for each place of a run; longer runs take a strong hash of their bytes.
SHORT = 64
PLACES = mix(np.arange(1001, 1001 + SHORT, dtype=np.uint64)) | np.uint64(1)


def chunk_hashes(data: bytes, cuts: np.ndarray, codes: np.ndarray = CODES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first places and sizes of the runs of bytes that ``cuts`` (256 flags) leaves.

    Bytes of the same code count as the same byte, also in long runs.
    """
    given = np.frombuffer(data, np.uint8)
    cut = cuts[given]
    edges = np.flatnonzero(np.diff(cut, prepend=True, append=True))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts, sizes
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    long = np.flatnonzero(sizes > SHORT)
    if len(long):
        place = np.minimum(place, SHORT - 1)
    sums = np.add.reduceat(codes[given[~cut]] * PLACES[place], first)
    for i in long.tolist():
        run = codes[given[starts[i]:starts[i] + sizes[i]]]
        sums[i] = xxhash.xxh3_64_intdigest(run.tobytes())
    return mix(sums + sizes.astype(np.uint64)), starts, sizes
