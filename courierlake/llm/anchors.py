"""Content-defined segments of a byte string.

Every window of 200 bytes has one anchor: the leftmost of its 64-byte grams
with the smallest hash. Windows with the same anchor are neighbours and form a
segment. The choice depends on the window's bytes alone, so equal windows have
the same anchor at the same offset, in whatever text they stand.
"""

from __future__ import annotations

import numpy as np

from courierlake.llm.neardup import _mix, _powers

WINDOW = 200
GRAM = 64
# Positions are packed into the low bits under the hash; longer texts go in
# pieces that overlap by a window.
_POS_BITS = 24
PIECE = 1 << 22


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all ``size``-byte windows."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    power, unpower = _powers(len(data) + 1)
    total = np.concatenate(([np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1])))
    return _mix((total[size:] - total[:-size]) * unpower[:len(data) - size + 1])


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    done = 1
    while 2 * done <= size:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[:len(x) - (size - done)], x[size - done:]) if done < size else x


def segments(text: bytes, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window start, last window start, gram hash) of each segment, in
    text order. A text shorter than a window has none."""
    data = np.frombuffer(text, np.uint8)
    firsts, lasts, grams = [], [], []
    for at in range(0, max(len(data) - window + 1, 0), PIECE):
        part = data[at:at + PIECE + window - 1]
        own = window_hashes(part, gram)
        low = np.uint64((1 << _POS_BITS) - 1)
        packed = (own & ~low) | np.arange(len(own), dtype=np.uint64)
        anchor = (_sliding_min(packed, window - gram + 1) & low).astype(np.int64)
        start = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        firsts.append(start + at)
        lasts.append(np.append(start[1:] - 1, len(anchor) - 1) + at)
        grams.append(own[anchor[start]].view(np.int64))
    if not firsts:
        none = np.zeros(0, np.int64)
        return none, none, none
    return np.concatenate(firsts), np.concatenate(lasts), np.concatenate(grams)
